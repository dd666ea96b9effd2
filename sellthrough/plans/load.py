"""One batch from raw rows to the fact table: many loads at once, each judged on its own.

Order of writes: parsed rows, statistics, landing, staging, control totals, then the fact, and the audit's SUCCESS last.
Every step replaces its own scope and the fact's weeks change by one commit that names the batch, so running a batch again ends in the
same state wherever the first run broke off: a batch that is in the fact is not merged again. Each step reads what the one before
wrote, which also keeps lineage short when executors are lost. The driver sees file names, one line per load and week
numbers, never row data."""
from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sellthrough import schemas as S
from sellthrough.functions import file_label
from sellthrough.operators.audit import audit_event, error_text, stats_json
from sellthrough.operators.classify import annotate
from sellthrough.operators.coverage import new_products, week_sums
from sellthrough.operators.joins import join_bounded
from sellthrough.operators.mapping import map_products, rollup, unmapped_keys
from sellthrough.operators.summary import keep_files, summarise
from sellthrough.operators.totals import control_totals, verdicts
from sellthrough.operators.upsert import matched_rows, merge_source, with_file_weeks, written_counters
from sellthrough.operators.windows import resolve_windows
from sellthrough.plans.parse import check_violations, derive, window_weeks
from sellthrough.session import local_rows
from sellthrough.sinks.warehouse import Warehouse
from sellthrough.sources.files import archive_files, list_feed_files, match_feeds, next_files, pending_files, unloaded
from sellthrough.sources.metadata import active_feeds
from sellthrough.sources.reader import read_feed_files

LOAD_STATS = ["files", "raw_rows", "parsed_rows", "parse_rejects", "out_of_window", "superseded_rows", "sales", "inventory"]


@dataclass(frozen=True)
class Batch:
    """What one run takes on."""
    batch_id: str
    files: DataFrame                        # schemas.FILES
    loads: DataFrame                        # schemas.LOADS
    paths_by_format: dict[str, list[str]]
    n_files: int
    n_loads: int
    refused: dict[str, tuple[str, str]]     # load id -> its feed, and why its files can't be loaded
    identities: DataFrame                   # schemas.FILE_IDENTITY
    fingerprint: str                        # of all files, to tell a repeated batch from another one of its id


@dataclass(frozen=True)
class LoadResult:
    load_id: str
    passed: bool
    error: str | None
    fact_inserted: int
    fact_updated: int


def _now() -> Column:
    return F.lit(datetime.now(timezone.utc))


def plan_batch(spark: SparkSession, files: DataFrame, config: DataFrame, *, batch_id: str, stamp: str,
               run_date: date, start_week: date | None = None, end_week: date | None = None) -> Batch | None:
    """Fix files, load ids and windows. `files` has pipeline_id, source_file, file_week, file_format and, if known, length and modified.

    File names and one line per feed come to the driver, as Spark's readers want paths; both become small local
    relations. None when no file waits."""
    known = files.withColumns({f.name: F.lit(None).cast(f.dataType) for f in S.FILE_IDENTITY.fields if f.name not in files.columns})
    rows = known.select("pipeline_id", "source_file", "file_week", "file_format", "length", "modified").orderBy("file_week", "source_file").collect()
    if not rows:
        return None
    local = local_rows(spark, [(r.pipeline_id, r.source_file, r.file_week) for r in rows],
                       S.table_schema("pipeline_id string, source_file string, file_week date"))
    week = [F.lit(w).cast("date") if w else None for w in (start_week, end_week)]
    feeds = config.join(local.select("pipeline_id").distinct(), "pipeline_id", "left_semi")
    windows = resolve_windows(feeds, local, F.lit(run_date).cast("date"), *week)
    planned = windows.select(
        F.concat("pipeline_id", F.lit(f"_{stamp}")).alias("load_id"), "pipeline_id", "client_id", "retailer_id",
        "product_level", "load_type", "window_start", "window_end", "window_error").collect()
    # Weeks that the caller gave are his fault; weeks in the names of one feed's files are that feed's.
    bad = {p.pipeline_id: f"{p.window_error}: {p.window_start} .. {p.window_end}" for p in planned if p.window_error}
    if bad and (start_week or end_week):
        raise ValueError("{}: {}".format(*sorted(bad.items())[0]))
    good = [p for p in planned if not p.window_error]
    load_of = {p.pipeline_id: p.load_id for p in good}
    rows = [r for r in rows if r.pipeline_id in load_of]
    paths: dict[str, list[str]] = {}
    for r in rows:
        paths.setdefault(r.file_format, []).append(r.source_file)
    return Batch(batch_id, local_rows(spark, [(load_of[r.pipeline_id], r.source_file, r.file_week) for r in rows], S.FILES),
                 local_rows(spark, [tuple(p)[:-1] for p in good], S.LOADS), paths, len(rows), len(good),
                 {p.load_id: (p.pipeline_id, bad[p.pipeline_id]) for p in planned if p.window_error},
                 local_rows(spark, [(r.source_file, r.length, r.modified) for r in rows], S.FILE_IDENTITY),
                 sha256(repr([(load_of[r.pipeline_id], r.source_file, r.length, r.modified) for r in rows]).encode()).hexdigest())


def run_load(warehouse: Warehouse, raw: DataFrame, batch: Batch, *, strict: bool = False,
             run_id: str | None = None) -> list[LoadResult]:
    """Load a batch. A load whose files can't be read, that violates its window, has no rows or does not reconcile is closed
    as FAILED and leaves the fact untouched; the others go on. With `strict` the first such load raises instead."""
    loads = batch.loads
    refused = [LoadResult(load_id, False, message, 0, 0) for load_id, (_, message) in sorted(batch.refused.items())]
    if refused:
        rows = local_rows(warehouse.spark, [(k, feed, message) for k, (feed, message) in sorted(batch.refused.items())],
                          S.table_schema("load_id string, feed string, message string"))
        warehouse.append("load_audit", audit_event(
            rows, _now(), pipeline_id=F.col("feed"), run_id=F.lit(run_id), status=F.lit("FAILED"), started_at=_now(),
            finished_at=_now(), error_message=error_text(F.col("message"))))
        if strict:
            raise ValueError(f"{refused[0].load_id}: {refused[0].error}")
        if not batch.n_loads:
            return refused
    try:
        return sorted(refused + _run(warehouse, raw, batch, strict, run_id), key=lambda r: r.load_id)
    except Exception as error:
        warehouse.append("load_audit", audit_event(
            loads, _now(), status=F.lit("FAILED"), error_message=error_text(F.lit(str(error))), finished_at=_now()))
        raise


def _run(wh: Warehouse, raw: DataFrame, batch: Batch, strict: bool, run_id: str | None) -> list[LoadResult]:
    loads, files, bid = batch.loads, batch.files, batch.batch_id
    weeks_bound = window_weeks(loads)
    labels = files.groupBy("load_id").agg(
        file_label(F.struct("file_week", "source_file"), F.col("source_file")).alias("files"))
    opened = loads.join(labels, "load_id", "left")
    wh.append("load_audit", audit_event(
        opened, _now(), pipeline_id=F.col("pipeline_id"), run_id=F.lit(run_id), load_type=F.col("load_type"),
        source_file=F.col("files"), window_start=F.col("window_start"), window_end=F.col("window_end"),
        status=F.lit("RUNNING"), started_at=_now()))

    # Parse. The judged rows are written once; statistics, rejects and landing all start from there.
    wh.replace_batch("parsed", annotate(raw, files, loads, batch.n_files), bid)
    judged = wh.batch("parsed", bid)
    wh.replace_batch("parse_summary", summarise(judged), bid)
    parsed = derive(judged, wh.batch("parse_summary", bid), files, loads, weeks_bound)
    wh.replace_batch("load_files", parsed.file_stats.withColumn("loaded_at", _now()), bid)
    wh.replace_batch("parse_rejects", parsed.rejects, bid)
    wh.append("load_audit", audit_event(parsed.load_stats, _now(), parse_stats=stats_json(LOAD_STATS)))
    if strict:
        check_violations(parsed)

    # Land, roll up, map.
    wh.replace("landing", parsed.output)
    landing = _of_batch(wh.read("landing"), batch)
    wh.replace("prestage", rollup(landing))
    source = landing.filter("product_level = 'serial'").withColumn("source_rows", F.lit(1).cast("long")).select(
        S.PRESTAGE.names).unionByName(_of_batch(wh.read("prestage"), batch))
    wh.replace("staging", map_products(source, wh.read("product_stm")))
    staging = _of_batch(wh.read("staging"), batch)

    # Gate: totals of every load and week, then one verdict per load.
    wh.replace_batch("etl_stats", control_totals(source, staging).withColumn("created_at", _now()), bid)
    totals = wh.batch("etl_stats", bid)
    errors = {r.load_id: r.message for r in parsed.violations.collect()}
    judged_loads = verdicts(totals, loads).collect()
    for v in judged_loads:
        if not v.passed and v.load_id not in errors:
            errors[v.load_id] = (f"src != stg + rej in {v.bad_weeks} of {v.weeks} weeks" if v.weeks
                                 else "no stats recorded")
    if strict and errors:
        load_id, message = sorted(errors.items())[0]
        raise ValueError(f"{load_id}: {message}")
    passing = [(v.load_id,) for v in judged_loads if v.load_id not in errors]

    counters = {}
    if passing:
        good = local_rows(wh.spark, passing, S.table_schema("load_id string"))
        good_loads = loads.join(good, "load_id", "left_semi")
        mine = join_bounded(staging, good, "load_id", "left_semi", len(passing))
        wh.replace_batch("unmapped", unmapped_keys(mine), bid)
        counters = upsert_fact(wh, mine, good_loads, totals, keep_files(wh.batch("parse_summary", bid)), weeks_bound, batch)
        wh.replace_batch("loaded_files", files.join(good_loads.select("load_id", "pipeline_id"), "load_id")
                         .join(batch.identities, "source_file").withColumn("loaded_at", _now()), bid)
    closed = [(load_id, *counters.get(load_id, (0, 0))) for (load_id,) in passing]
    if closed:
        rows = local_rows(wh.spark, closed, S.table_schema("load_id string, inserted bigint, updated bigint"))
        wh.append("load_audit", audit_event(rows, _now(), status=F.lit("SUCCESS"), fact_inserted=F.col("inserted"),
                                            fact_updated=F.col("updated"), finished_at=_now()))
    if errors:
        rows = local_rows(wh.spark, sorted(errors.items()), S.table_schema("load_id string, message string"))
        wh.append("load_audit", audit_event(rows, _now(), status=F.lit("FAILED"), finished_at=_now(),
                                            error_message=error_text(F.col("message"))))
    return [LoadResult(v.load_id, v.load_id not in errors, errors.get(v.load_id), *counters.get(v.load_id, (0, 0)))
            for v in sorted(judged_loads, key=lambda v: v.load_id)]


def _of_batch(rows: DataFrame, batch: Batch) -> DataFrame:
    """A batch's rows of a table that also holds other pairs; the pair columns prune partitions."""
    keys = ["client_id", "retailer_id", "load_id"]
    return join_bounded(rows, batch.loads.select(*keys), keys, "left_semi", batch.n_loads)


def upsert_fact(wh: Warehouse, staging: DataFrame, loads: DataFrame, totals: DataFrame, file_weeks: DataFrame, weeks_bound: int,
                batch: Batch) -> dict[str, tuple[int, int]]:
    """Rewrite the fact partitions the loads touch, and count per load what was inserted and updated.

    The partitions are known from the control totals, so the fact is read and rewritten for those only; other pairs'
    rows in them pass through. The new weeks are written beside the old ones and counted there; one commit puts all of them into the
    fact, with the batch's id and counters. A batch that is in the fact already is answered from its commit."""
    done = wh.committed("fact_sales", batch.batch_id, batch.fingerprint)
    if done is not None:
        keep_coverage(wh, batch)
        return {load_id: tuple(counts) for load_id, counts in done.counters.items()}
    scope = (totals.filter("source = 'stg'").join(loads.select("load_id"), "load_id", "left_semi")
             .select(*wh.fact_partitions).distinct())
    # Distinct Saturdays: a few hundred dates, at most the calendar.
    weeks = [r.week_date for r in scope.select("week_date").distinct().collect()]
    loaded_at = _now()
    current = wh.read("fact_sales").filter(F.col("week_date").isin(weeks))
    if len(wh.fact_partitions) > 1:
        current = join_bounded(current, scope, list(wh.fact_partitions), "left_semi", weeks_bound)
    source = with_file_weeks(merge_source(staging, loads, batch.n_loads), file_weeks, loads, weeks_bound)
    version = wh.stage("fact_sales", matched_rows(current, source, loaded_at, wh.order_guard))
    counts = written_counters(wh.staged("fact_sales", version), loaded_at).collect()
    counters = {r.load_id: (r.fact_inserted, r.fact_updated) for r in counts}
    wh.commit("fact_sales", version, batch.batch_id, batch.fingerprint, {k: list(v) for k, v in counters.items()})
    keep_coverage(wh, batch)
    return counters


def keep_coverage(wh: Warehouse, batch: Batch) -> None:
    """Bring the week sums of the weeks that a batch has changed, and the products that it has added, up to the fact. Done once a batch."""
    change = wh.committed("fact_sales", batch.batch_id, batch.fingerprint)
    if wh.committed("fact_weeks", batch.batch_id, batch.fingerprint) is not None:
        return
    weeks = [date.fromisoformat(w) for w in wh.versions("fact_sales").changed(change, "week_date")]
    rows = wh.read("fact_sales").filter(F.col("week_date").isin(weeks))
    known = wh.read("fact_products").filter(F.col("batch_id") != batch.batch_id)
    wh.replace_batch("fact_products", new_products(rows, known), batch.batch_id)
    wh.commit("fact_weeks", wh.stage("fact_weeks", week_sums(rows)), batch.batch_id, batch.fingerprint)


def load_folder(warehouse: Warehouse, folder: str, *, stamp: str, run_date: date, start_week: date | None = None,
                end_week: date | None = None, environment: str = "dev", pipeline_id: str | None = None,
                strict: bool = False, again: bool = False, max_drops: int = S.MAX_DROPS_PER_LOAD,
                archive_folder: str | None = None) -> list[LoadResult]:
    """Load the drops that wait below a folder (the oldest `max_drops` of each feed), or one feed's. Explicit weeks make it a
    history load. Returns nothing when no file waits.

    Files of loads that succeeded are remembered, by path, length and time of modification, and wait no more, but for the batch of the same
    stamp, which is repeated, and with `again`, which takes all files that lie there. With `archive_folder` they move there, to the same place
    below it; a part that comes late takes the parts of its drop from there."""
    spark = warehouse.spark
    config = active_feeds(warehouse.read("pipeline_config"), environment)
    if pipeline_id:
        config = config.filter(F.col("pipeline_id") == pipeline_id)
    loaded = None if again else warehouse.read("loaded_files").filter(F.col("batch_id") != stamp)
    batch = plan_batch(spark, next_files(spark, folder, config, loaded, max_drops, archive_folder), config, batch_id=stamp, stamp=stamp,
                       run_date=run_date, start_week=start_week, end_week=end_week)
    if batch is None:
        return []
    results = run_load(warehouse, read_feed_files(spark, batch.paths_by_format), batch, strict=strict)
    if archive_folder:
        done = [r.source_file for r in warehouse.batch("loaded_files", stamp).select("source_file").collect()]
        archive_files(spark, done, folder, archive_folder)
    return results


def waiting_files(warehouse: Warehouse, folder: str) -> DataFrame:
    """Files below a folder that belong to a feed and aren't loaded yet, oldest first."""
    files = pending_files(list_feed_files(warehouse.spark, folder))
    waiting = unloaded(match_feeds(files, warehouse.read("pipeline_config"), folder), warehouse.read("loaded_files"))
    return waiting.orderBy("file_week", "source_file")
