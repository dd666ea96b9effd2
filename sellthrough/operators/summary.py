"""What each file brought, week by week, and what follows from it: newest file per week, statistics, violations.

`summarise` is the only aggregate over the rows. It is small (loads x files x weeks), and everything else here works on
it, so a load with a third of all rows costs no more than partial sums on the map side."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from sellthrough import schemas as S
from sellthrough.operators.joins import join_bounded


def summarise(annotated: DataFrame) -> DataFrame:
    """Rows, sales and inventory by load, file, status and (kept rows only) week.

    Faults of a file's layout are the same on all its rows, so they are keys here: a maximum of text would turn the hash
    aggregate into a sort of all rows."""
    week = F.when(F.col("status") == "kept", F.col("week_date")).alias("week_date")
    return annotated.groupBy("load_id", "source_file", "file_week", "status", week, "missing_columns", "layout_error").agg(
        F.count("*").alias("rows"), F.sum("sales").try_cast(S.MONEY).alias("sales"), F.try_sum("inventory").alias("inventory"), F.max("week_date").alias("latest_week"))


def with_newest(summary: DataFrame) -> DataFrame:
    """Each summary line with whether its rows are used: kept, and of the newest drop that reports the week. Parts of one
    drop share their file week. The window runs over summary lines, a handful per load and week."""
    week = Window.partitionBy("load_id", "week_date")
    kept = F.col("status") == "kept"
    newest = F.max(F.when(kept, F.col("file_week"))).over(week)
    return summary.withColumn("is_used", kept & (F.col("file_week") == newest))


def keep_files(summary: DataFrame) -> DataFrame:
    """(load_id, week_date, file_week): the newest drop of each week, for loads in which no file breaks the window or its
    layout. One pass over the summary."""
    kept = F.col("status") == "kept"
    weeks = summary.groupBy("load_id", "week_date").agg(
        F.max(F.when(kept, F.col("file_week"))).alias("file_week"), F.count_if(_is_fault()).alias("faults"))
    faults = F.sum("faults").over(Window.partitionBy("load_id"))
    return (weeks.withColumn("faults", faults).filter("faults = 0 AND file_week IS NOT NULL AND week_date IS NOT NULL")
            .drop("faults"))


def _is_fault() -> Column:
    return ((F.col("status") == "newer") | F.col("missing_columns").isNotNull() | F.col("layout_error").isNotNull())


def _rows_if(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("rows"))), F.lit(0)).cast("long")


def _counts() -> list[Column]:
    status = F.col("status")
    parsed, used = _rows_if(status == "kept"), _rows_if(F.col("is_used"))
    return [F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("raw_rows"), parsed.alias("parsed_rows"),
            used.alias("rows_used"), (parsed - used).alias("superseded_rows"),
            _rows_if(status == "reject").alias("parse_rejects"), _rows_if(status == "older").alias("out_of_window")]


def file_stats(summary: DataFrame, files: DataFrame) -> DataFrame:
    """One line per file of a load, files without any row included."""
    lines = with_newest(summary).drop("file_week")
    return (files.select("load_id", "source_file", F.col("file_week").alias("file_week_end"))
            .join(lines, ["load_id", "source_file"], "left")
            .groupBy("load_id", "source_file", "file_week_end").agg(*_counts()))


def load_stats(summary: DataFrame, files: DataFrame) -> DataFrame:
    """One line per load; parsed rows, sales and inventory are those of the used rows."""
    lines = (files.select("load_id", "source_file")
             .join(with_newest(summary).drop("file_week"), ["load_id", "source_file"], "left"))
    used = F.col("is_used")
    stats = lines.groupBy("load_id").agg(
        F.count_distinct("source_file").alias("files"), *_counts(),
        F.coalesce(F.sum(F.when(used, F.col("sales"))), F.lit(0)).try_cast(S.MONEY).alias("sales"),
        F.coalesce(F.try_sum(F.when(used, F.col("inventory"))), F.lit(0)).cast("long").alias("inventory"))
    return stats.withColumn("parsed_rows", F.col("rows_used")).drop("rows_used")


def violations(summary: DataFrame, files: DataFrame, loads: DataFrame) -> DataFrame:
    """(load_id, message), one line per failing load with all its messages in order. One pass over the summary: faults per
    file, then per load (at most a load's files in one group)."""
    status = F.col("status")
    # Sums of kept rows are never NULL but where they don't fit.
    kept = summary.filter(status == "kept")
    too_large = kept.groupBy("load_id").agg(
        (F.coalesce(F.sum("sales").try_cast(S.MONEY).isNull(), F.lit(False)) | F.try_sum("inventory").isNull()
         | (F.count_if(F.col("sales").isNull() | F.col("inventory").isNull()) > 0)).alias("too_large"))
    per_file = summary.groupBy("load_id", "source_file").agg(
        _rows_if(status == "newer").alias("newer_rows"), _rows_if(status == "kept").alias("kept_rows"),
        F.max(F.when(status == "newer", F.col("latest_week"))).alias("latest_week"),
        F.max("missing_columns").alias("missing_columns"), F.max("layout_error").alias("layout_error"))
    all_files = (files.select("load_id", "source_file").join(per_file, ["load_id", "source_file"], "left")
                 .join(loads.select("load_id", "window_end"), "load_id"))
    where = F.concat(F.lit(" in "), "source_file")
    late = F.when(F.col("newer_rows") > 0, F.concat(
        F.col("newer_rows").cast("string"), F.lit(" rows are after the window end "), F.col("window_end").cast("string"),
        F.lit(" (latest week "), F.col("latest_week").cast("string"), F.lit(")"), where))
    layout = F.concat(F.coalesce("layout_error", F.concat(F.lit("missing columns "), "missing_columns")), where)
    per_load = all_files.withColumn("messages", F.array_compact(F.array(late, layout))).groupBy("load_id").agg(
        F.flatten(F.collect_list("messages")).alias("messages"), F.coalesce(F.sum("kept_rows"), F.lit(0)).alias("kept"))
    empty = F.when(F.col("kept") == 0, F.lit("no rows for the window in any file"))
    large = F.when(F.col("too_large"), F.lit("sums of sales or inventory do not fit their types"))
    text = F.array_sort(F.array_compact(F.concat("messages", F.array(empty, large))))
    return per_load.join(too_large, "load_id", "left").select("load_id", F.concat_ws("; ", text).alias("message")).filter("message <> ''")


@dataclass(frozen=True)
class Parsed:
    annotated: DataFrame    # every row, judged
    summary: DataFrame      # rows by load, file, status, week
    output: DataFrame       # schemas.LANDING: rows that go on
    rejects: DataFrame      # schemas.REJECTS
    file_stats: DataFrame
    load_stats: DataFrame
    violations: DataFrame   # loads that must not go on, with the reason


def used_rows(annotated: DataFrame, summary: DataFrame, weeks_bound: int) -> DataFrame:
    """Kept rows of the newest drop per load and week, for loads without violation.

    The lookup side has at most one line per load and week of its window, which `weeks_bound` counts, so the rows are
    neither shuffled nor sorted for it (a window over (load, week) would put a hot week into one task)."""
    rows = join_bounded(annotated.filter("status = 'kept'"), keep_files(summary), ["load_id", "week_date", "file_week"],
                        "left_semi", weeks_bound)
    return rows.select(S.LANDING.names)


def reject_rows(annotated: DataFrame) -> DataFrame:
    return annotated.filter("status = 'reject'").select(S.REJECTS.names)
