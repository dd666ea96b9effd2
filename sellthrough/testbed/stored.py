"""The fact table the views read, and feed files, written below the shared folder from the given tables."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sellthrough import schemas as S
from sellthrough.operators.audit import audit_event
from sellthrough.operators.coverage import pair_products, week_sums
from sellthrough.operators.joins import BROADCAST_ROWS
from sellthrough.operators.totals import control_totals
from sellthrough.operators.mapping import map_products, source_rows
from sellthrough.operators.upsert import merge_source
from sellthrough.plans.stage import stage
from sellthrough.plans.views import Tables
from sellthrough.session import materialise, release, work_folder
from sellthrough.testbed import base

_stored: dict[tuple[str, str], str] = {}


def clean_staging(spark: SparkSession, sf: str) -> DataFrame:
    return stage(base.landing(spark, sf), base.stm(spark, sf))


def clean_fact(spark: SparkSession, sf: str) -> DataFrame:
    source = merge_source(clean_staging(spark, sf), base.open_loads(spark, sf), base.pair_count(spark, sf))
    at = F.lit(base.LOADED_AT).cast("timestamp")
    return source.withColumns({"inserted_at": at, "updated_at": at}).select(S.FACT_SALES.names)


def stored_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact as the load leaves it: Parquet by week. Written once per session, as views read a stored table."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        path = work_folder(spark, "fact")
        (clean_fact(spark, sf).hint("rebalance", "week_date").sortWithinPartitions("week_date", "client_id", "retailer_id")
         .write.partitionBy("week_date").parquet(path))
        _stored[key] = path
    return spark.read.schema(S.FACT_SALES).parquet(_stored[key])


def _kept(spark: SparkSession, sf: str, name: str, rows: DataFrame) -> DataFrame:
    """A table that the load keeps beside the fact, written once per session."""
    key = (spark.sparkContext.applicationId, f"{sf}/{name}")
    if key not in _stored:
        path = work_folder(spark, name)
        rows.write.parquet(path)
        _stored[key] = path
    return spark.read.schema(rows.schema).parquet(_stored[key])


def week_table(spark: SparkSession, sf: str) -> DataFrame:
    return _kept(spark, sf, "fact-weeks", week_sums(stored_fact(spark, sf)))


def audit(spark: SparkSession, sf: str) -> DataFrame:
    """The loads' log lines: two per feed, later ones minutes apart; every fourth brand's last load failed."""
    no = base.client_no(F.col("client_id"))
    started = F.lit(base.LOADED_AT).cast("timestamp") + F.make_interval(mins=no)
    rows = base.loads(spark, sf)
    return audit_event(
        rows, started, pipeline_id=F.col("pipeline_id"), load_type=F.col("load_type"),
        window_start=F.col("window_start"), window_end=F.col("window_end"), started_at=started,
        status=F.when(no % 4 == 0, "FAILED").otherwise("SUCCESS"), finished_at=started + F.make_interval(hours=F.lit(1)))


def tables(spark: SparkSession, sf: str) -> Tables:
    return Tables(fact=stored_fact(spark, sf), client=base.clients(spark, sf), retailer=base.retailers(spark, sf),
                  product=base.products(spark, sf), config=base.feeds(spark, sf), audit=audit(spark, sf),
                  weeks=week_table(spark, sf), products_sold=_kept(spark, sf, "fact-products", pair_products(stored_fact(spark, sf))))


def totals(spark: SparkSession, sf: str, stm: DataFrame, lose_every: int | None = None) -> DataFrame:
    """Control totals of the clean rows under a mapping; `lose_every` drops staged rows of every n-th serial."""
    source = source_rows(base.landing(spark, sf))
    staging = map_products(source, stm)
    if lose_every:
        lost = (F.col("product_level") == "serial") & (F.col("src_product_key").try_cast("long") % lose_every == 0)
        staging = staging.filter(~F.coalesce(lost, F.lit(False)))
    return control_totals(source, staging)


DOCUMENT_RECORDS = 5000

# ---- feed files -----------------------------------------------------------------------------------------------------

# Header lines of two feed layouts.
CSV_HEADERS = {
    "serial": ("Week_Date", "Client", "Retailer", "Product_ID", "Sales", "Inventory"),
    "style": (" week_date ", "retailer", "client", "store", "style", "Net Sales", "On Hand"),
}


def feed_lines(rows: DataFrame) -> DataFrame:
    """(folder columns, drop, line): one CSV line or one JSON record per row; `rows` are sell rows with file_week."""
    money = F.concat(F.lit('"$'), F.format_number("sales", 2), F.lit('"'))
    us = F.date_format("week_date", "M/d/yyyy")
    iso = F.col("week_date").cast("string")
    csv_serial = F.concat_ws(",", us, "client_id", "retailer_id", "serial", money, F.col("inventory").cast("string"))
    csv_style = F.concat_ws(",", iso, "retailer_id", "client_id", F.col("store").cast("string"), "style",
                            F.col("sales").cast("string"), F.col("inventory").cast("string"))
    record = F.to_json(F.struct(
        iso.alias("weekEnding"), F.col("client_id").alias("clientId"), F.col("retailer_id").alias("retailerId"),
        F.col("store").alias("storeNumber"), F.col("style").alias("style"), F.col("color").alias("color"),
        F.col("size").alias("size"), F.col("sales").alias("salesAmount"), F.col("inventory").alias("onHandUnits")))
    level = F.col("product_level")
    line = F.when(level == "serial", csv_serial).when(level == "style", csv_style).otherwise(record)
    name = F.concat("retailer_id", F.lit("_"), "client_id", F.lit("_"), F.date_format("file_week", "yyyyMMdd"),
                    F.when(level == "sku", ".json").otherwise(".csv"))
    return rows.select(F.col("client_id").alias("client"), F.col("retailer_id").alias("retailer"), "product_level",
                       name.alias("drop"), line.alias("line"))


def write_feed_files(rows: DataFrame, folder: str, drop_bound: int) -> str:
    """Write sell rows (with file_week) as feed files, a folder per drop:
    <folder>/client=<id>/retailer=<id>/drop=<name>/part-*. At most `drop_bound` drops."""
    # Written once, as the rows' joins would else run for each format.
    lines = materialise(feed_lines(rows), "feed-lines")
    where = ["client", "retailer", "drop"]
    for level in ("serial", "style"):
        # The text writer has no header, the CSV writer would quote the prepared line: a header of one column named
        # like the whole line, quoting off.
        header = ",".join(CSV_HEADERS[level])
        one = lines.filter(F.col("product_level") == level).select(*where, F.col("line").alias(header))
        (one.hint("rebalance", *where).write.mode("append").partitionBy(*where)
         .options(header=True, quote="\u0000", escape="\u0000", sep="\u0001", ignoreLeadingWhiteSpace=False,
                  ignoreTrailingWhiteSpace=False, emptyValue="")
         .csv(folder))
    records = lines.filter("product_level = 'sku'")
    # A document is one array and cannot be split, so each drop is cut into as many as its row count asks for. The cut
    # follows the text's hash: a repeated task cuts alike.
    drops = records.groupBy("drop").agg(F.ceil(F.count("*") / F.lit(DOCUMENT_RECORDS)).alias("documents"))
    part = F.pmod(F.xxhash64("line"), F.col("documents"))
    documents = (records.join(F.broadcast(drops), "drop") if drop_bound <= BROADCAST_ROWS else records.join(drops, "drop"))
    documents = (documents.groupBy(*where, part.alias("part"))
                 .agg(F.concat(F.lit("["), F.concat_ws(",", F.collect_list("line")), F.lit("]")).alias("value")))
    (documents.select(*where, "value").hint("rebalance", *where)
     .write.mode("append").partitionBy(*where).option("maxRecordsPerFile", 1).text(folder))
    release(lines)
    return folder


NOTED_HEADER = "Week_Date,Client,Retailer,Product_ID,Note,Sales,Inventory"
NOTE_AT = 4


def write_noted_files(rows: DataFrame, folder: str) -> str:
    """Sell rows (with file_week) as CSV files with a note in each row: some notes go on over lines, hold commas and quotes or a quote that opens nothing;
    rows with line number 6 have seven cells too many."""
    no = F.col("l_linenumber")
    note = F.when(no == 2, '"two\nlines, ""so"""').when(no == 3, '5" pipe').when(no == 4, "").otherwise("plain")
    line = F.concat_ws(",", F.col("week_date").cast("string"), "client_id", "retailer_id", "serial", note, F.col("sales").cast("string"),
                       F.concat(F.col("inventory").cast("string"), F.when(no == 6, ",,,,,,,x").otherwise("")))
    name = F.concat("retailer_id", F.lit("_"), "client_id", F.lit("_"), F.date_format("file_week", "yyyyMMdd"), F.lit(".csv"))
    where = ["client", "retailer", "drop"]
    lines = rows.select(F.col("client_id").alias("client"), F.col("retailer_id").alias("retailer"), name.alias("drop"), line.alias("line"))
    counts = lines.groupBy("drop").agg(F.ceil(F.count("*") / DOCUMENT_RECORDS).alias("documents"))
    part = F.pmod(F.xxhash64("line"), F.col("documents"))
    texts = lines.join(counts, "drop").groupBy(*where, part.alias("part")).agg(F.concat_ws("\n", F.lit(NOTED_HEADER), F.collect_list("line")).alias("value"))
    texts.select(*where, "value").hint("rebalance", *where).write.partitionBy(*where).option("maxRecordsPerFile", 1).text(folder)
    return folder
