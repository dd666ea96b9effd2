"""The tables of the load as partitioned Parquet below one shared folder.

Writes replace whole partitions (dynamic overwrite), so a repeated step replaces what its first attempt left. The fact's are
replaced all together or not at all (see `versions`). One writer per table is assumed. Before a partitioned write the rows are rebalanced on the partition columns: AQE splits a heavy
partition over several tasks and joins light ones, so neither one huge file nor thousands of tiny ones come out."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sellthrough import schemas as S
from sellthrough.sinks.versions import Manifest, VersionedTable


def _batched(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())])


_PARSED = S.table_schema("""load_id string, source_file string, file_week date, status string, reject_reason string,
    week_date date, client_id string, retailer_id string, product_level string, product_id string, style string,
    color string, size string, sales decimal(18,2), inventory bigint, missing_columns string, layout_error string,
    raw map<string,string>""")
_SUMMARY = S.table_schema("""load_id string, source_file string, file_week date, status string, week_date date,
    missing_columns string, layout_error string, rows bigint, sales decimal(18,2), inventory bigint, latest_week date""")

PAIR = ("client_id", "retailer_id")
# Table -> schema and partition columns, which are also the scope one write replaces. Load-scoped tables are partitioned
# by batch: a load belongs to one batch, and one partition a batch stays manageable where one a load would not.
TABLES: dict[str, tuple[T.StructType, tuple[str, ...]]] = {
    "client": (S.CLIENT, ()), "retailer": (S.RETAILER, ()), "product": (S.PRODUCT, ()),
    "product_stm": (S.PRODUCT_STM, ()), "pipeline_config": (S.PIPELINE_CONFIG, ()),
    "parsed": (_batched(_PARSED), ("batch_id",)), "parse_summary": (_batched(_SUMMARY), ("batch_id",)),
    "parse_rejects": (_batched(S.REJECTS), ("batch_id",)), "load_files": (_batched(S.LOAD_FILES), ("batch_id",)),
    "unrecognised_files": (_batched(S.UNRECOGNISED_FILES), ("batch_id",)),
    "loaded_files": (_batched(S.LOADED_FILES), ("batch_id",)),
    "landing": (S.LANDING, ("product_level", *PAIR)), "prestage": (S.PRESTAGE, ("product_level", *PAIR)),
    "staging": (S.STAGING, PAIR), "etl_stats": (_batched(S.ETL_STATS), ("batch_id",)),
    "unmapped": (_batched(S.UNMAPPED), ("batch_id",)), "load_audit": (S.LOAD_AUDIT_EVENT, ()),
    "backlog": (_batched(S.BACKLOG), ("batch_id",)),
    "fact_sales": (S.FACT_STORED, ("week_date",)),
    "fact_weeks": (S.FACT_WEEKS, ("week_date",)), "fact_products": (_batched(S.FACT_PRODUCTS), ("batch_id",)),
}
VERSIONED = ("fact_sales", "fact_weeks")
# Sorting inside files lets the Parquet reader skip row groups.
SORTED_BY = {"fact_sales": ("week_date", "client_id", "retailer_id", "product_id")}


def _typed(rows: DataFrame, schema: T.StructType) -> DataFrame:
    return rows.select([F.col(f.name).cast(f.dataType) for f in schema.fields])


@dataclass(frozen=True)
class Warehouse:
    """`fact_partitions` may name client_id as well: with many large clients a load then rewrites only its own clients'
    part of a week, while small data would break into tiny files. `order_guard`: a drop does not replace what a newer drop
    reported, so drops may be loaded in any order; without it the last load wins."""
    spark: SparkSession
    folder: str
    fact_partitions: tuple[str, ...] = ("week_date",)
    order_guard: bool = False

    def partitions(self, table: str) -> tuple[str, ...]:
        return self.fact_partitions if table == "fact_sales" else TABLES[table][1]

    def path(self, table: str) -> str:
        return f"{self.folder.rstrip('/')}/{table}"

    def read(self, table: str) -> DataFrame:
        """The table's rows; none while nothing was written."""
        if table in VERSIONED:
            return self._of(table, self.versions(table).paths())
        schema = TABLES[table][0]
        try:
            return self.spark.read.schema(schema).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def versions(self, table: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(table))

    def _of(self, table: str, paths: list[str]) -> DataFrame:
        schema = TABLES[table][0]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths).select(schema.names)

    def stage(self, table: str, rows: DataFrame) -> str:
        """Write partitions of a versioned table that nobody reads before `commit` names them."""
        return self.versions(table).stage(self._laid_out(table, rows), self.partitions(table))

    def staged(self, table: str, version: str) -> DataFrame:
        schema = TABLES[table][0]
        return self.spark.read.schema(schema).parquet(f"{self.path(table)}/{version}").select(schema.names)

    def commit(self, table: str, version: str, batch_id: str = "", files: str = "", counters: dict | None = None) -> None:
        self.versions(table).commit(version, len(self.partitions(table)), batch_id, files, counters)

    def committed(self, table: str, batch_id: str, files: str) -> Manifest | None:
        return self.versions(table).committed(batch_id, files)

    def _laid_out(self, table: str, rows: DataFrame) -> DataFrame:
        rows = _typed(rows, TABLES[table][0])
        if self.partitions(table):
            rows = rows.hint("rebalance", *self.partitions(table))
        return rows.sortWithinPartitions(*SORTED_BY[table]) if table in SORTED_BY else rows

    def batch(self, table: str, batch_id: str) -> DataFrame:
        """One batch's rows; only its partition is read."""
        return self.read(table).filter(F.col("batch_id") == batch_id).drop("batch_id")

    def replace(self, table: str, rows: DataFrame) -> None:
        """Replace the partitions the rows fall into, the whole table if it has no partitions."""
        if table in VERSIONED:
            self.commit(table, self.stage(table, rows))
            return
        partitions, rows = self.partitions(table), self._laid_out(table, rows)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        (writer.partitionBy(*partitions) if partitions else writer).parquet(self.path(table))

    def replace_batch(self, table: str, rows: DataFrame, batch_id: str) -> None:
        """Replace one batch's partition, also by nothing when there are no rows."""
        schema = T.StructType([f for f in TABLES[table][0].fields if f.name != "batch_id"])
        _typed(rows, schema).write.mode("overwrite").parquet(f"{self.path(table)}/batch_id={batch_id}")

    def append(self, table: str, rows: DataFrame) -> None:
        _typed(rows, TABLES[table][0]).write.mode("append").parquet(self.path(table))

    def replace_dimensions(self, **tables: DataFrame) -> None:
        """Full replace of dimensions and metadata."""
        for table, rows in tables.items():
            self.replace(table, rows)
