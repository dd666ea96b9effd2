"""Session settings used by tests and the benchmark, and the shared work folder."""
from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def build_session(app: str = "sellthrough", master: str | None = None, **conf: str) -> SparkSession:
    builder = (SparkSession.builder.appName(app)
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               # Parsing makes wide projections; beyond 8000 bytecodes the JVM no longer compiles a generated method, so
               # Spark shall fall back to smaller ones.
               .config("spark.sql.codegen.hugeMethodLimit", "8000"))
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Where none is set, a session on one machine takes a folder of it; a cluster must name one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="sellthrough-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_folder(spark)}/sellthrough/{name}-{uuid.uuid4().hex}"


# Spark removes the shuffle files of an execution that is done, which else lie on the executors' disks until the driver's JVM collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialise(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to a work table in the shared folder and read them from there: computed once, lineage cut, safe when
    executors are lost. Shuffle files of the write go with it, as nothing reads them any more."""
    spark, path = rows.sparkSession, work_folder(rows.sparkSession, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        rows.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    table = spark.read.schema(rows.schema).parquet(path)
    table.work_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete work tables, as `materialise` returned them, that nothing reads any more, lazily neither."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.work_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Metadata rows of the driver as a local relation, whose size the planner knows (one made from a Python list counts
    as unboundedly large)."""
    arrow = to_arrow_schema(schema)
    columns = zip(*rows) if rows else [()] * len(arrow)
    return spark.createDataFrame(pa.Table.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow), schema)
