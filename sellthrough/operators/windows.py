"""The weeks each load is responsible for."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sellthrough.functions import is_week_end, last_completed_week


def resolve_windows(feeds: DataFrame, files: DataFrame, run_date: Column, start_week: Column | None = None,
                    end_week: Column | None = None) -> DataFrame:
    """Window per feed. Explicit weeks win over the weeks in the file names, those over the run date.

    `feeds` has pipeline_id and lookback_weeks, `files` pipeline_id and file_week. Adds load_type, window_start,
    window_end and window_error (NULL when the window is sound)."""
    none = F.lit(None).cast("date")
    start = none if start_week is None else start_week.cast("date")
    end = none if end_week is None else end_week.cast("date")
    spans = files.groupBy("pipeline_id").agg(F.min("file_week").alias("oldest"), F.max("file_week").alias("newest"))
    back = (F.col("lookback_weeks").cast("int") - 1) * 7
    history = start.isNotNull() | end.isNotNull()
    rows = feeds.join(spans, "pipeline_id", "left").withColumn(
        "load_type", F.when(history, "history").otherwise("automation"))
    rows = rows.withColumn("window_end", F.coalesce(end, "newest", last_completed_week(run_date)))
    rows = rows.withColumn("window_start", F.coalesce(
        start, F.when(~history, F.date_sub(F.col("oldest"), back)), F.date_sub(F.col("window_end"), back)))
    error = (F.when(~is_week_end(F.col("window_start")) | ~is_week_end(F.col("window_end")),
                    F.lit("a load's first and last week have to end on Saturdays"))
             .when(F.col("window_start") > F.col("window_end"), F.lit("a load's first week comes after its last")))
    return rows.withColumn("window_error", error).drop("oldest", "newest")


def check_windows(windows: DataFrame) -> None:
    bad = windows.filter("window_error IS NOT NULL").orderBy("pipeline_id").limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0].pipeline_id}: {bad[0].window_error}, got {bad[0].window_start} .. {bad[0].window_end}")


def missing_weeks(expected: DataFrame, fact: DataFrame) -> DataFrame:
    """Weeks inside a pair's window for which the fact holds nothing. `expected` has client_id, retailer_id,
    window_start, window_end."""
    weeks = expected.select("client_id", "retailer_id", F.explode(F.sequence(
        "window_start", "window_end", F.expr("interval 7 days"))).alias("week_date"))
    loaded = fact.select("client_id", "retailer_id", "week_date").distinct()
    return weeks.join(loaded, ["client_id", "retailer_id", "week_date"], "left_anti")
