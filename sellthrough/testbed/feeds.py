"""Messy feed rows: two overlapping drops per feed, US and ISO dates, money text, and faults in every rule."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sellthrough import schemas as S
from sellthrough.session import work_folder
from sellthrough.testbed import base

_stored: dict[tuple[str, str], str] = {}
FAULTS = 97     # an order's key modulo this picks the fault of its rows


def dropped_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Each sell row once per drop that reports it: the older drop has all weeks but the newest, the newer one the last
    five weeks with restated sales."""
    rows, newest, week = base.sell_rows(spark, sf), base.newest_week(spark, sf), F.col("week_date")
    older = F.when(week <= F.date_sub(newest, 7), F.struct(F.date_sub(newest, 7).alias("file_week"), F.col("sales").alias("sales")))
    newer = F.when(week >= F.date_sub(newest, 28), F.struct(newest.alias("file_week"), base.restated(F.col("sales")).alias("sales")))
    drops = rows.withColumn("drop", F.explode(F.array(older, newer))).filter("drop IS NOT NULL")
    return drops.withColumns({"file_week": F.col("drop.file_week"), "sales": F.col("drop.sales")}).drop("drop")


def file_name(week: Column) -> Column:
    return F.concat("retailer_id", F.lit("_"), "client_id", F.lit("_"), F.date_format(week, "yyyyMMdd"),
                    F.when(F.col("product_level") == "sku", ".json").otherwise(".csv"))


def raw_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Feed text of every row, stored once per session like landed files, one for each core: parsing starts from stored text,
    as it does in a load."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _stored:
        path = work_folder(spark, "raw-feed")
        made_feed(spark, sf).repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def made_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Feed text of every row, faults included, in the readers' contract (schemas.RAW_FEED)."""
    rows = dropped_rows(spark, sf)
    fault = F.col("l_orderkey") % FAULTS
    week, level = F.col("week_date"), F.col("product_level")
    shown = F.when(fault == 3, F.date_sub(week, 1)).otherwise(week)
    blank = fault == 9

    def text(c: Column) -> Column:
        return F.when(blank, "").otherwise(c)

    def key(name: str, first: bool, *levels: str) -> Column:
        value = F.when(fault == 1, "Total") if first else F.lit(None)
        value = F.coalesce(value, F.when(fault == 4, "  "), F.when(
            fault == 12, F.concat(F.lit("\t "), F.lower(name), F.lit(" "))), F.col(name))
        return F.when(level.isin(*levels), text(value))

    money = F.format_number(F.abs("sales"), 2)
    columns = {
        "week_date": text(F.when(fault == 2, "n/a").when(F.col("l_linenumber") % 2 == 0, shown.cast("string"))
                          .otherwise(F.date_format(shown, "M/d/yyyy"))),
        # The layout of one retailer has no id columns.
        "client_id": F.when(F.col("retailer_id") != "BUIL", text(F.when(fault == 7, "XX").otherwise(F.col("client_id")))),
        "retailer_id": F.when(F.col("retailer_id") != "BUIL",
                              text(F.when(fault == 8, F.lower("retailer_id")).otherwise(F.col("retailer_id")))),
        "product_id": key("serial", True, "serial"), "style": key("style", True, "sku", "style"),
        "color": key("color", False, "sku"), "size": key("size", False, "sku"),
        "sales": text(F.when(fault == 5, "abc").when(fault == 11, F.concat(F.lit("($ "), money, F.lit(")")))
                      .otherwise(F.concat(F.lit("$"), money))),
        "inventory": text(F.when(fault == 6, "$5").when(fault == 10, F.concat(F.col("inventory").cast("string"), F.lit(".5")))
                          .otherwise(F.format_number("inventory", 0))),
    }
    made = rows.select(file_name(F.col("file_week")).alias("source_file"), *[c.alias(n) for n, c in columns.items()])
    return made.select("source_file", *S.FEED_COLUMNS, F.array(*[F.lit(c) for c in S.FEED_COLUMNS]).alias("raw_names"),
                       F.array(*S.FEED_COLUMNS).alias("raw_cells"), F.lit(None).cast("string").alias("layout_error"))


def files(spark: SparkSession, sf: str) -> DataFrame:
    """The two drops of every feed's load."""
    newest = base.newest_week(spark, sf)
    both = base.loads(spark, sf).withColumn("file_week", F.explode(F.array(F.date_sub(newest, 7), newest)))
    return both.select("load_id", file_name(F.col("file_week")).alias("source_file"), "file_week")
