"""The load log. Every state change of a load is one appended event; fields a change does not touch stay NULL."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sellthrough import schemas as S

STATS = "files bigint, raw_rows bigint, parsed_rows bigint, parse_rejects bigint, out_of_window bigint, " \
        "superseded_rows bigint, sales double, inventory bigint"


def audit_event(rows: DataFrame, event_ts: Column, **fields: Column) -> DataFrame:
    """Events for the given loads (rows with load_id), all other columns NULL."""
    values = {"event_ts": event_ts, **fields}
    return rows.select(*[
        (F.col("load_id") if f.name == "load_id" else values.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        for f in S.LOAD_AUDIT_EVENT.fields])


def error_text(message: Column) -> Column:
    return F.substring(message, 1, S.MAX_ERROR_CHARS)


def stats_json(names: list[str]) -> Column:
    """Parse statistics as JSON text, money as a number."""
    return F.to_json(F.struct(*[
        (F.col(n).cast("double") if n == "sales" else F.col(n)).alias(n) for n in names]))


def current_audit(events: DataFrame) -> DataFrame:
    """One row per load: for each field the value of its latest event that has one."""
    fields = [f for f in S.LOAD_AUDIT_EVENT.names if f not in ("load_id", "event_ts") and f in events.columns]
    latest = [F.max_by(f, F.when(F.col(f).isNotNull(), F.col("event_ts"))).alias(f) for f in fields]
    return events.groupBy("load_id").agg(*latest)


def decode_stats(audit: DataFrame) -> DataFrame:
    """Add the decoded statistics; text that is no JSON decodes to NULL and is still there as it was."""
    return audit.withColumn("stats", F.from_json("parse_stats", STATS))


def load_health(audit: DataFrame, totals: DataFrame) -> DataFrame:
    """One row per load with its totals side by side; NULL where a source has none.

    Totals are summed per load before the join, so the audit columns never travel through the aggregate."""
    def total(column: str, source: str, kind) -> Column:
        return F.sum(F.when(F.col("source") == source, F.col(column))).cast(kind)

    sums = totals.groupBy("load_id").agg(
        *[total("sales", s, S.MONEY).alias(f"{s}_sales") for s in ("src", "stg", "rej")],
        *[total("row_count", s, "long").alias(f"{s}_rows") for s in ("src", "stg", "rej")])
    return audit.join(sums, "load_id", "left").select(
        "pipeline_id", "load_id", "load_type", "status", "window_start", "window_end", "src_sales", "stg_sales",
        "rej_sales", "src_rows", "stg_rows", "rej_rows", "fact_inserted", "fact_updated", "started_at", "finished_at")


def file_history(audit: DataFrame, load_files: DataFrame) -> DataFrame:
    """Every load with what each of its files brought; loads without files stay."""
    return audit.select("pipeline_id", "load_id", "status", "started_at", "window_start", "window_end").join(
        load_files.select("load_id", "source_file", "file_week_end", "parsed_rows", "rows_used", "superseded_rows",
                          "parse_rejects", "out_of_window"), "load_id", "left")


def latest_load_totals(audit: DataFrame, totals: DataFrame) -> DataFrame:
    """Control totals of the latest load of each feed."""
    latest = audit.groupBy("pipeline_id").agg(F.max("load_id").alias("load_id"))
    return totals.join(latest.select("load_id"), "load_id", "left_semi").select(
        "load_id", "week_date", "source", "row_count", "sales", "inventory")


def reject_histogram(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("load_id", "reject_reason").agg(F.count("*").alias("rows"))
