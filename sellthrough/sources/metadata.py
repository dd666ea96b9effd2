"""Feed metadata and dimensions."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sellthrough import schemas


def read_pipeline_config(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PIPELINE_CONFIG).option("header", True).csv(path)


def active_feeds(config: DataFrame, environment: str = "dev", only_active: bool = True) -> DataFrame:
    """Feeds of one environment: `dev` has all, `prod` only the promoted ones."""
    if environment not in ("dev", "prod"):
        raise ValueError(f"unknown environment {environment!r}")
    keep = F.lit(True) if environment == "dev" else F.col("promoted_to_prod")
    return config.filter(keep & F.col("is_active") if only_active else keep)


def feed_by_id(config: DataFrame, pipeline_id: str) -> DataFrame:
    return config.filter(F.col("pipeline_id") == pipeline_id)
