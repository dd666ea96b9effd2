"""What is known about a load, for whoever looks into a failure: for all loads at once, or for one if asked."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from sellthrough.operators.audit import decode_stats, file_history, reject_histogram
from sellthrough.operators.mapping import unmapped_keys
from sellthrough.operators.totals import findings, stats_by_week
from sellthrough.schemas import MAX_EVIDENCE_KEYS, MAX_EVIDENCE_ROWS

ALL_RECONCILE = "every week reconciles: src = stg + rej"


@dataclass(frozen=True)
class Evidence:
    audit: DataFrame
    stats: DataFrame
    findings: DataFrame
    unmapped: DataFrame
    reject_reasons: DataFrame
    reject_samples: DataFrame
    files: DataFrame
    feed: DataFrame


def _first_per_load(rows: DataFrame, order: list, n: int) -> DataFrame:
    """First n rows per load. The rank is limited within each task before the shuffle, so a load with very many rows
    sends n of them per task."""
    rank = F.row_number().over(Window.partitionBy("load_id").orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= n).drop("rank")


def clamp(n: int, most: int = MAX_EVIDENCE_ROWS) -> int:
    return max(1, min(int(n), most))


def reject_samples(rejects: DataFrame, n: int = 10) -> DataFrame:
    """1 to 20 rejected rows per load."""
    return _first_per_load(rejects, ["source_file", "reject_reason", F.to_json("raw")], clamp(n))


def top_unmapped(keys: DataFrame, n: int = MAX_EVIDENCE_KEYS) -> DataFrame:
    """The unmapped keys of each load with the highest sales."""
    return _first_per_load(keys, [F.desc("sales"), "src_product_key"], n)


def recent_files(audit: DataFrame, load_files: DataFrame, pipeline_id: str, n: int = 10) -> DataFrame:
    """1 to 20 lines of a feed's load history, newest first; a load still open without start time comes first."""
    rows = file_history(audit.filter(F.col("pipeline_id") == pipeline_id), load_files)
    return rows.orderBy(F.desc_nulls_first("started_at"), F.asc_nulls_last("source_file")).limit(clamp(n))


def recent_files_all(audit: DataFrame, load_files: DataFrame, n: int = 10) -> DataFrame:
    """The same for every feed at once."""
    order = Window.partitionBy("pipeline_id").orderBy(F.desc_nulls_first("started_at"), F.asc_nulls_last("source_file"))
    return (file_history(audit, load_files).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= clamp(n)).drop("rank"))


def finding_texts(totals: DataFrame) -> DataFrame:
    """One line per week that does not reconcile; one line saying so for a load whose weeks all do."""
    bad = findings(totals).select("load_id", "week_date", "finding")
    good = (totals.select("load_id").distinct().join(bad.select("load_id").distinct(), "load_id", "left_anti")
            .select("load_id", F.lit(None).cast("date").alias("week_date"), F.lit(ALL_RECONCILE).alias("finding")))
    return bad.unionByName(good)


def evidence(*, audit: DataFrame, totals: DataFrame, staging: DataFrame, rejects: DataFrame, load_files: DataFrame,
             config: DataFrame, unmapped: DataFrame | None = None, load_id: str | None = None,
             samples: int = 10, history: int = 10) -> Evidence:
    """`unmapped` is the written report; where a load has none, its keys are taken from staging."""
    def of(rows: DataFrame) -> DataFrame:
        return rows if load_id is None else rows.filter(F.col("load_id") == load_id)

    keys = unmapped_keys(of(staging))
    if unmapped is not None:
        report = of(unmapped).select(keys.columns)
        keys = report.unionByName(keys.join(report.select("load_id").distinct(), "load_id", "left_anti"))
    feeds = of(audit).select("pipeline_id").distinct()
    return Evidence(
        audit=decode_stats(of(audit)), stats=stats_by_week(of(totals)), findings=finding_texts(of(totals)),
        unmapped=top_unmapped(keys), reject_reasons=reject_histogram(of(rejects)),
        reject_samples=reject_samples(of(rejects), samples),
        files=recent_files_all(audit.join(feeds, "pipeline_id", "left_semi"), load_files, history),
        feed=config.join(feeds, "pipeline_id", "left_semi"))
