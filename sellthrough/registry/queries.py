"""Every operator as a query over the given tables. Each takes (spark, folder of the tables) and returns a DataFrame with
dates as ISO text and decimals as doubles."""
from __future__ import annotations

import dataclasses
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from sellthrough import schemas as S
from sellthrough.functions import (
    file_label, is_week_end, last_completed_week, month_name, parse_count, parse_date, parse_money,
    round_count, round_money, week_ending, week_starting,
)
from sellthrough.operators import audit as A, quality, totals as G
from sellthrough.operators.joins import join_bounded
from sellthrough.operators.mapping import (
    build_products, build_stm, map_products, merge_levels, rejected_by_pair, rollup, source_rows, unmapped_keys,
)
from sellthrough.operators.summary import Parsed, with_newest
from sellthrough.operators.upsert import merge_source, restated_rows, upsert_weekly
from sellthrough.operators.windows import missing_weeks, resolve_windows
from sellthrough.plans import evidence, reports, views
from sellthrough.plans.load import load_folder, plan_batch, run_load
from sellthrough.plans.parse import parse_feed
from sellthrough.plans.reports import for_export
from sellthrough.plans.stage import stage
from sellthrough.plans.views import Tables
from sellthrough.session import materialise, work_folder
from sellthrough.sinks import Warehouse
from sellthrough.sources import (
    active_feeds, api_pages, flatten_pages, json_records, list_feed_files, match_feeds, page_totals, pending_files,
    read_csv_feed, read_feed_files,
)
from sellthrough.streaming import ingest
from sellthrough.testbed import base, feeds, stored
from sellthrough.testbed.workbooks import write_workbooks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query under its function's name."""
    QUERIES[run.__name__] = lambda spark, sf: for_export(run(spark, sf))
    return run


# ---- functions ------------------------------------------------------------------------------------------------------

@query
def week_functions(spark, sf):
    """Week arithmetic on every order date."""
    day = F.col("day")
    days = base.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    return days.select(
        "day", is_week_end(day).alias("is_week_end"), week_ending(day).alias("week_ending"),
        last_completed_week(day).alias("last_completed"), week_starting(week_ending(day)).alias("week_starting"),
        month_name(day).alias("month_name"), F.quarter(day).alias("quarter"))


@query
def value_functions(spark, sf):
    """Money, count and date text of every line item, read back and summed by flag."""
    line = base.table(spark, sf, "lineitem")
    price, day = F.col("l_extendedprice"), F.col("l_shipdate").cast("date")
    text = line.select(
        "l_returnflag", "l_linestatus",
        F.when(F.col("l_linenumber") == 3, F.concat(F.lit("("), F.format_number(price, 2), F.lit(")")))
        .otherwise(F.concat(F.lit("$ "), F.format_number(price, 2))).alias("money"),
        F.when(F.col("l_linenumber") == 5, F.lit("1d")).otherwise(F.format_number(F.col("l_quantity") * 1000, 0)).alias("units"),
        F.when(F.col("l_linenumber") % 2 == 0, F.date_format(day, "M/d/yyyy")).otherwise(day.cast("string")).alias("day"))
    read = text.select("l_returnflag", "l_linestatus", round_money(parse_money(F.col("money"))).alias("money"),
                       round_count(parse_count(F.col("units"))).alias("units"), parse_date(F.col("day")).alias("day"))
    return read.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("rows"), F.sum("money").cast(S.MONEY).alias("money"), F.sum("units").alias("units"),
        F.count_if(F.col("units").isNull()).alias("bad_units"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


# ---- parse ----------------------------------------------------------------------------------------------------------

def _parsed(spark: SparkSession, sf: str, keep_rows: bool = True) -> Parsed:
    pairs = base.pair_count(spark, sf)
    return parse_feed(feeds.raw_feed(spark, sf), feeds.files(spark, sf), base.loads(spark, sf), files_bound=2 * pairs,
                      weeks_bound=base.WINDOW_WEEKS * pairs, keep_rows=keep_rows)


@query
def parse_classify(spark, sf):
    """How every feed row was judged."""
    rows = _parsed(spark, sf).annotated
    return rows.groupBy("load_id", "source_file", "status", F.coalesce("reject_reason", F.lit("")).alias("reason")).agg(
        F.count("*").alias("rows"), F.sum(F.coalesce("sales", F.lit(0))).cast(S.MONEY).alias("sales"),
        F.sum(F.coalesce("inventory", F.lit(0))).alias("inventory"))


@query
def parse_output(spark, sf):
    """The rows that go on."""
    keys = [F.coalesce(k, F.lit("")).alias(k) for k in S.KEY_COLUMNS]
    return _parsed(spark, sf).output.select("load_id", "week_date", "client_id", "retailer_id", "product_level", *keys,
                                            "sales", "inventory")


@query
def parse_rejects(spark, sf):
    """Rejected rows with their text as it came."""
    def raw(name: str):
        return F.coalesce(F.col("raw")[name], F.lit("")).alias(f"raw_{name}")
    return _parsed(spark, sf).rejects.select("load_id", "source_file", "reject_reason",
                                             *[raw(c) for c in ("week_date", "client_id", "style", "inventory")])


@query
def parse_stats(spark, sf):
    return _parsed(spark, sf, keep_rows=False).load_stats


@query
def file_stats(spark, sf):
    return _parsed(spark, sf, keep_rows=False).file_stats


@query
def newest_file_wins(spark, sf):
    """Rows used and superseded per load, week and drop."""
    lines = with_newest(_parsed(spark, sf, keep_rows=False).summary).filter("status = 'kept'")
    return lines.groupBy("load_id", "week_date", "file_week").agg(
        F.sum(F.when(F.col("is_used"), F.col("rows")).otherwise(0)).alias("rows_used"),
        F.sum(F.when(F.col("is_used"), F.lit(0)).otherwise(F.col("rows"))).alias("superseded_rows"))


@query
def window_policy(spark, sf):
    """Loads refused because a file reaches beyond the window."""
    return _parsed(spark, sf, keep_rows=False).violations


@query
def reject_histogram(spark, sf):
    return A.reject_histogram(_parsed(spark, sf).rejects)


@query
def load_windows(spark, sf):
    """Windows of automation and history loads of every feed."""
    files = feeds.files(spark, sf).select(F.regexp_extract("load_id", "^([^_]+_[^_]+)", 1).alias("pipeline_id"), "file_week")
    config = base.feeds(spark, sf).select("pipeline_id", "lookback_weeks", "retailer_id")
    some = files.filter(~F.col("pipeline_id").endswith("FURN"))     # one retailer has no file waiting
    day = F.lit("2026-10-01").cast("date")
    runs = {"automation": (None, None), "history_end": (None, "2001-01-06"), "history": ("1999-01-02", "2000-01-01"),
            "backwards": ("2000-01-01", "1999-01-02"), "friday": ("1999-01-01", None)}
    parts = [resolve_windows(config, some, day, *[F.lit(w) if w else None for w in weeks]).select(
        F.lit(name).alias("run"), "pipeline_id", "load_type", "window_start", "window_end",
        F.coalesce("window_error", F.lit("")).alias("window_error")) for name, weeks in runs.items()]
    return merge_levels(parts)


@query
def file_labels(spark, sf):
    """One label per load for its files."""
    files = feeds.files(spark, sf)
    return files.groupBy("load_id").agg(file_label(F.struct("file_week", "source_file"), F.col("source_file")).alias("label"))


# ---- stage and gate -------------------------------------------------------------------------------------------------

@query
def prestage_rollup(spark, sf):
    return rollup(base.landing(spark, sf)).withColumns({k: F.coalesce(k, F.lit("")) for k in ("color", "size")}).drop("product_id")


def _staged(spark, sf, level: str) -> DataFrame:
    rows = stage(base.landing(spark, sf).filter(F.col("product_level") == level), base.stm(spark, sf))
    return rows.withColumn("product_id", F.coalesce("product_id", F.lit("")))


@query
def stage_serial(spark, sf):
    return _staged(spark, sf, "serial")


@query
def stage_sku(spark, sf):
    return _staged(spark, sf, "sku")


@query
def stage_style(spark, sf):
    return _staged(spark, sf, "style")


@query
def stage_all(spark, sf):
    """All levels in one relation, counted by pair and week."""
    rows = stored.clean_staging(spark, sf)
    return rows.groupBy("load_id", "product_level", "week_date").agg(
        F.count("*").alias("rows"), F.count("product_id").alias("mapped"), F.sum("sales").cast(S.MONEY).alias("sales"),
        F.count_distinct("src_product_key").alias("source_keys"))


@query
def control_totals(spark, sf):
    return stored.totals(spark, sf, base.stm(spark, sf))


@query
def reconcile_ok(spark, sf):
    return G.reconcile(stored.totals(spark, sf, base.stm(spark, sf)))


@query
def reconcile_duplicate_stm(spark, sf):
    return G.reconcile(stored.totals(spark, sf, base.doubled_stm(spark, sf)))


@query
def reconcile_lost_rows(spark, sf):
    return G.reconcile(stored.totals(spark, sf, base.stm(spark, sf), lose_every=31))


@query
def load_verdicts(spark, sf):
    """Which loads may reach the fact under the doubled mapping."""
    return G.verdicts(stored.totals(spark, sf, base.doubled_stm(spark, sf)), base.loads(spark, sf))


@query
def evidence_by_week(spark, sf):
    rows = G.stats_by_week(stored.totals(spark, sf, base.doubled_stm(spark, sf)))
    return rows.select("load_id", "week_date", *[
        F.coalesce(c, F.lit(-1)).cast("double").alias(c) for c in rows.columns[2:]])


@query
def reconcile_findings(spark, sf):
    return G.findings(stored.totals(spark, sf, base.doubled_stm(spark, sf)))


@query
def finding_texts(spark, sf):
    """Findings in words, with one line for each load that reconciles."""
    return evidence.finding_texts(stored.totals(spark, sf, base.doubled_stm(spark, sf))).select(
        "load_id", F.coalesce(F.col("week_date").cast("string"), F.lit("")).alias("week_date"), "finding")


@query
def unmapped_keys_report(spark, sf):
    return unmapped_keys(stored.clean_staging(spark, sf))


@query
def top_unmapped_keys(spark, sf):
    """The first keys of each load's unmapped report."""
    return evidence.top_unmapped(unmapped_keys(stored.clean_staging(spark, sf)), 3)


@query
def rejected_by_pair_report(spark, sf):
    return rejected_by_pair(stored.clean_staging(spark, sf))


# ---- upsert ---------------------------------------------------------------------------------------------------------

@query
def merge_source_rows(spark, sf):
    return merge_source(stored.clean_staging(spark, sf), base.loads(spark, sf), base.pair_count(spark, sf))


def _upserted(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The fact after a first load and the next week's restatement."""
    pairs = base.pair_count(spark, sf)
    mapping = base.stm(spark, sf)
    first = merge_source(stage(base.first_drop(spark, sf), mapping), base.open_loads(spark, sf), pairs)
    at = F.lit(base.LOADED_AT).cast("timestamp")
    fact = first.withColumns({"inserted_at": at, "updated_at": at})
    again = stage(base.second_drop(spark, sf), mapping)
    return upsert_weekly(fact, again, base.open_loads(spark, sf, base.NEXT_STAMP),
                         F.lit(base.NEXT_LOADED_AT).cast("timestamp"), pairs)


@query
def upsert_result(spark, sf):
    return _upserted(spark, sf)[0]


@query
def upsert_counts(spark, sf):
    return _upserted(spark, sf)[1]


@query
def restated_rows_by_week(spark, sf):
    return restated_rows(_upserted(spark, sf)[0])


# ---- audit ----------------------------------------------------------------------------------------------------------

def _two_loads(spark, sf) -> tuple[DataFrame, DataFrame]:
    """(audit, totals) of two loads per feed."""
    audit = stored.audit(spark, sf)
    later = audit.withColumns({"load_id": F.regexp_replace("load_id", base.STAMP, base.NEXT_STAMP),
                               "started_at": F.col("started_at") + F.make_interval(days=F.lit(7))})
    mapping = base.stm(spark, sf)
    parts = []
    for drop in (base.first_drop(spark, sf), base.second_drop(spark, sf)):
        source = source_rows(drop)
        parts.append(G.control_totals(source, map_products(source, mapping)))
    return audit.unionByName(later), parts[0].unionByName(parts[1])


@query
def load_health(spark, sf):
    audit, totals = _two_loads(spark, sf)
    rows = A.load_health(audit, totals)
    sums = [f"{s}_{m}" for s in ("src", "stg", "rej") for m in ("sales", "rows")]
    return rows.select("pipeline_id", "load_id", "load_type", "status", "window_start", "window_end",
                       *[F.coalesce(c, F.lit(-1)).cast("double").alias(c) for c in sums])


@query
def latest_load_totals(spark, sf):
    return A.latest_load_totals(*_two_loads(spark, sf))


@query
def file_history(spark, sf):
    """Every load with its files; the second loads have none yet."""
    audit = _two_loads(spark, sf)[0]
    rows = A.file_history(audit, _parsed(spark, sf).file_stats)
    counts = ["parsed_rows", "rows_used", "superseded_rows", "parse_rejects", "out_of_window"]
    return rows.select("pipeline_id", "load_id", "status", F.coalesce("source_file", F.lit("")).alias("source_file"),
                       *[F.coalesce(c, F.lit(-1)).alias(c) for c in counts])


@query
def recent_loads(spark, sf):
    """The newest three lines of each feed's history."""
    audit = _two_loads(spark, sf)[0]
    rows = evidence.recent_files_all(audit, feeds.files(spark, sf).select(
        "load_id", "source_file", F.col("file_week").alias("file_week_end"),
        *[F.lit(0).alias(c) for c in ("parsed_rows", "rows_used", "superseded_rows", "parse_rejects", "out_of_window")]), 3)
    return rows.select("pipeline_id", "load_id", F.coalesce("source_file", F.lit("")).alias("source_file"))


@query
def audit_current(spark, sf):
    """Latest state per user of the event log: for each field its last value that is not NULL."""
    log = base.table(spark, sf, "events")
    at, kind = F.col("ts"), F.col("event_type")
    events = log.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("load_id"), at.alias("event_ts"), kind.alias("status"),
        F.when(kind == "purchase", F.floor("value")).alias("fact_inserted"),
        F.when(kind == "click", F.col("props")).alias("parse_stats"),
        F.when(kind == "error", A.error_text(F.repeat("props", 300))).alias("error_message"))
    rows = A.current_audit(events)
    return rows.select("load_id", "status", F.coalesce("fact_inserted", F.lit(-1)).alias("fact_inserted"),
                       F.coalesce(F.get_json_object("parse_stats", "$.k"), F.lit("")).alias("stats_k"),
                       F.coalesce("error_message", F.lit("")).alias("error_message"))


# ---- views and reports ----------------------------------------------------------------------------------------------

@query
def weekly_sales(spark, sf):
    return views.weekly_sales(stored.tables(spark, sf)).withColumns({c: F.coalesce(c, F.lit("")) for c in ("color", "size")})


@query
def chat_weekly_sales(spark, sf):
    rows = views.chat_weekly_sales(stored.tables(spark, sf))
    return rows.withColumns({c: F.coalesce(c, F.lit("")) for c in ("color", "size")})


@query
def sales_by_week(spark, sf):
    return views.sales_by_week(stored.tables(spark, sf))


@query
def calendar(spark, sf):
    return views.calendar(stored.tables(spark, sf))


@query
def data_freshness(spark, sf):
    rows = views.data_freshness(stored.tables(spark, sf))
    return rows.withColumn("last_successful_load_at",
                           F.coalesce(F.date_format("last_successful_load_at", "yyyy-MM-dd HH:mm:ss"), F.lit("")))


@query
def fact_coverage(spark, sf):
    return views.fact_coverage(stored.tables(spark, sf))


@query
def latest_week(spark, sf):
    return views.latest_week(stored.week_table(spark, sf))


@query
def sales_by_retailer_latest(spark, sf):
    return reports.sales_by_retailer_latest(stored.tables(spark, sf))


@query
def period_compare(spark, sf):
    return reports.period_compare(stored.tables(spark, sf), "Brand#11", "FURNITURE")


@query
def period_compare_all(spark, sf):
    rows = reports.period_compare_all(stored.tables(spark, sf))
    return rows.select("brand", "retailer", *[F.coalesce(c, F.lit(-1)).cast(S.MONEY).alias(c)
                                              for c in ("last_4_weeks_usd", "prior_4_weeks_usd")])


@query
def top_products(spark, sf):
    return reports.top_products(stored.tables(spark, sf), "Brand#11", weeks=52)


@query
def out_of_stock(spark, sf):
    """Products with one unit left or none count as out here: the given tables have no zero quantities."""
    t = stored.tables(spark, sf)
    low = t.fact.withColumn("inventory", F.floor(F.col("inventory") / 2))
    return reports.out_of_stock(Tables(low, t.client, t.retailer, t.product))


@query
def sales_by_month(spark, sf):
    return reports.sales_by_month(stored.tables(spark, sf), "Brand#11")


@query
def freshness_for_retailer(spark, sf):
    rows = reports.freshness_for_retailer(stored.tables(spark, sf), "FURNITURE")
    return rows.withColumn("last_successful_load_at",
                           F.coalesce(F.date_format("last_successful_load_at", "yyyy-MM-dd HH:mm:ss"), F.lit("")))


@query
def known_values(spark, sf):
    return reports.all_known_values(stored.tables(spark, sf))


@query
def capped_result(spark, sf):
    """A listing under the result cap."""
    rows = views.sales_by_week(stored.tables(spark, sf)).select("week_ending", "brand", "retailer", "sales_usd")
    return reports.capped(rows.orderBy("week_ending", "brand", "retailer"), 10_000)


@query
def missing_weeks_by_pair(spark, sf):
    """Weeks of the load window a pair has not reported."""
    windows = base.loads(spark, sf).select("client_id", "retailer_id", "window_start", "window_end")
    return missing_weeks(windows, stored.stored_fact(spark, sf))


# ---- dimensions and metadata ----------------------------------------------------------------------------------------

@query
def stm_rows(spark, sf):
    rows = build_stm(base.catalog(spark, sf))
    return rows.withColumns({c: F.coalesce(c, F.lit("")) for c in ("src_product_id", "style", "color", "size")})


@query
def product_rows(spark, sf):
    return build_products(base.catalog(spark, sf)).withColumns({c: F.coalesce(c, F.lit("")) for c in ("color", "size")})


@query
def stm_duplicates(spark, sf):
    rows = quality.stm_duplicates(base.full_stm(spark, sf))
    return rows.withColumns({c: F.coalesce(c, F.lit("")) for c in ("src_product_id", "style", "color", "size")})


@query
def stm_orphans(spark, sf):
    """Mapping rows of the doubled mapping whose product does not exist."""
    rows = quality.stm_orphans(base.doubled_stm(spark, sf), base.products(spark, sf))
    return rows.select("client_id", "product_level", "src_product_id", "product_id")


@query
def mapping_quality(spark, sf):
    return quality.mapping_quality(base.doubled_stm(spark, sf), base.products(spark, sf), stored.clean_staging(spark, sf))


@query
def active_feeds_prod(spark, sf):
    return active_feeds(base.feeds(spark, sf), "prod").select("pipeline_id", "product_level", "source_type", "lookback_weeks")


# ---- sources --------------------------------------------------------------------------------------------------------

PAGE_RECORDS = 50


def _pages(spark, sf) -> DataFrame:
    """API pages of all feeds: at most 50 records each where hashes spread evenly, one cursor chain per feed."""
    rows = base.sell_rows(spark, sf)
    feed = F.concat_ws("_", "client_id", "retailer_id")
    record = F.to_json(F.struct(
        F.col("week_date").cast("string").alias("weekEnding"), F.col("client_id").alias("clientId"),
        F.col("retailer_id").alias("retailerId"), F.col("store").alias("storeNumber"), "style", "color", "size",
        F.col("sales").alias("salesAmount"), F.col("inventory").alias("onHandUnits")))
    lines = rows.select(feed.alias("feed"), record.alias("rec"), "l_orderkey", "l_linenumber")
    counts = lines.groupBy("feed").agg(F.count("*").alias("total"), F.ceil(F.count("*") / PAGE_RECORDS).alias("n_pages"))
    page = F.pmod(F.xxhash64("rec", "l_orderkey", "l_linenumber"), F.col("n_pages"))
    paged = join_bounded(lines, counts, "feed", "inner", base.pair_count(spark, sf)).groupBy("feed", "total", page.alias("page")).agg(
        F.concat_ws(",", F.collect_list("rec")).alias("data"))
    last = paged.groupBy("feed").agg(F.max("page").alias("last_page"))
    cursor = F.when(F.col("page") == F.col("last_page"), "null").otherwise((F.col("page") + 1).cast("string"))
    envelope = F.concat(F.lit('{"data":['), "data", F.lit('],"next_cursor":'), cursor, F.lit(',"total":'),
                        F.col("total").cast("string"), F.lit("}"))
    return join_bounded(paged, last, "feed", "inner", base.pair_count(spark, sf)).select(
        F.concat("feed", F.lit("_page"), F.col("page").cast("string"), F.lit(".json")).alias("source_file"),
        envelope.alias("value"))


def _typed_sums(raw: DataFrame) -> DataFrame:
    """Feed text of any reader, typed and summed by pair and week."""
    return raw.groupBy("client_id", "retailer_id", parse_date(F.col("week_date")).alias("week_date")).agg(
        F.count("*").alias("rows"), F.sum(round_money(parse_money(F.col("sales")))).cast(S.MONEY).alias("sales"),
        F.sum(round_count(parse_count(F.col("inventory")))).alias("inventory"))


@query
def api_pages_flatten(spark, sf):
    return _typed_sums(flatten_pages(api_pages(_pages(spark, sf))))


@query
def api_page_totals(spark, sf):
    """Whether every record of every feed arrived once."""
    feed = F.regexp_extract("source_file", "^(.*)_page", 1)
    return page_totals(api_pages(_pages(spark, sf)), feed).select("feed", "records", "total", "last_pages", "is_complete")


@query
def events_feed(spark, sf):
    """The event log as a JSON feed: one record per event, rolled up by week, type and user."""
    log = base.table(spark, sf, "events")
    record = F.to_json(F.struct(
        F.date_format(week_ending(F.col("ts").cast("date")), "M/d/yyyy").alias("week_ending"),
        F.col("event_type").alias("retailer"), F.lit("C1").alias("vendor"),
        F.col("user_id").cast("string").alias("serialNumber"), F.col("value").alias("Net Sales"),
        F.get_json_object("props", "$.k").alias("On-Hand")))
    raw = json_records(log.select(F.lit("events.json").alias("source_file"),
                                  F.concat(F.lit("["), record, F.lit("]")).alias("value")))
    landing = raw.select(
        F.lit("events").alias("load_id"), parse_date(F.col("week_date")).alias("week_date"), "client_id", "retailer_id",
        F.lit("style").alias("product_level"), F.lit(None).cast("string").alias("product_id"),
        F.col("product_id").alias("style"), F.lit(None).cast("string").alias("color"), F.lit(None).cast("string").alias("size"),
        round_money(parse_money(F.col("sales"))).alias("sales"), round_count(parse_count(F.col("inventory"))).alias("inventory"))
    return rollup(landing).select("week_date", "retailer_id", "style", "sales", "inventory", "source_rows")


def _written(spark, sf, **columns) -> str:
    """Folder with the feed files of all rows, one drop per feed. columns: what shall be different about the rows."""
    rows = base.sell_rows(spark, sf).withColumn("file_week", base.newest_week(spark, sf)).withColumns(columns)
    return stored.write_feed_files(rows, work_folder(spark, "feeds"), base.pair_count(spark, sf))


def _paths(spark, folder: str) -> list[str]:
    return [r.source_file for r in pending_files(list_feed_files(spark, folder)).select("source_file").collect()]


@query
def csv_layouts(spark, sf):
    """All rows in CSV files of two layouts, found by name, read in one scan."""
    level = F.col("product_level")
    folder = _written(spark, sf, product_level=F.when(level == "sku", "style").otherwise(level))
    return _typed_sums(read_csv_feed(spark, _paths(spark, folder)))


@query
def reader_faults(spark, sf):
    """All rows in CSV files with line breaks and quotes in their cells, some with cells far beyond the header."""
    folder = stored.write_noted_files(base.sell_rows(spark, sf).withColumn("file_week", base.newest_week(spark, sf)), work_folder(spark, "feeds"))
    raw = read_csv_feed(spark, _paths(spark, folder))
    return raw.groupBy("client_id", "retailer_id").agg(
        F.count("*").alias("rows"), F.count_if(F.size("raw_cells") > F.size("raw_names")).alias("ragged"), F.sum(F.size("raw_cells")).alias("cells"),
        F.sum(F.length(F.get("raw_cells", F.lit(stored.NOTE_AT)))).alias("note_chars"), F.sum(parse_money(F.col("sales"))).cast(S.MONEY).alias("sales"))


@query
def json_feed(spark, sf):
    """All rows as JSON documents."""
    return _typed_sums(read_feed_files(spark, {"json": _paths(spark, _written(spark, sf, product_level=F.lit("sku")))}))


@query
def workbook_feed(spark, sf):
    """All rows through workbook files of bounded size and back."""
    paths = write_workbooks(base.sell_rows(spark, sf), work_folder(spark, "books"))
    return _typed_sums(read_feed_files(spark, {"xlsx": paths}))


@query
def feed_files_matched(spark, sf):
    """Files below a folder, with their feed and week."""
    folder = _written(spark, sf)
    rows = match_feeds(pending_files(list_feed_files(spark, folder)), base.feeds(spark, sf), folder)
    return rows.select("pipeline_id", "file_week", "file_format").distinct()


# ---- whole loads ----------------------------------------------------------------------------------------------------

def _warehouse(spark, sf) -> Warehouse:
    wh = Warehouse(spark, work_folder(spark, "warehouse"))
    everything = base.feeds(spark, sf).withColumn("is_active", F.lit(True))
    wh.replace_dimensions(client=base.clients(spark, sf), retailer=base.retailers(spark, sf),
                          product=base.products(spark, sf), product_stm=base.stm(spark, sf), pipeline_config=everything)
    return wh


def _fact_of(wh: Warehouse) -> DataFrame:
    return wh.read("fact_sales").select("week_date", "client_id", "retailer_id", "product_id", "sales", "inventory",
                                        (F.col("updated_at") > F.col("inserted_at")).alias("is_restated"))


@query
def load_from_feed(spark, sf):
    """A whole load of the messy feed into an empty warehouse: parse, land, map, gate, upsert."""
    wh = _warehouse(spark, sf)
    files = feeds.files(spark, sf).select(
        F.regexp_extract("load_id", "^([^_]+_[^_]+)", 1).alias("pipeline_id"), "source_file", "file_week",
        F.lit("csv").alias("file_format"))
    batch = plan_batch(spark, files, wh.read("pipeline_config"), batch_id="b1", stamp=base.STAMP,
                       run_date=date(2026, 1, 1), start_week=date.fromisoformat(base.HISTORY_START))
    run_load(wh, feeds.raw_feed(spark, sf), batch)
    return _fact_of(wh)


@query
def stream_ingest(spark, sf):
    """Two drops arriving one after the other as files, taken by the file stream with its default settings."""
    wh = _warehouse(spark, sf)
    folder, checkpoint = work_folder(spark, "landing"), work_folder(spark, "stream")
    rows, newest = base.sell_rows(spark, sf), base.newest_week(spark, sf)
    first = rows.filter(F.col("week_date") <= F.date_sub(newest, 7)).withColumn("file_week", F.date_sub(newest, 7))
    recent = rows.filter((F.col("week_date") >= F.date_sub(newest, 28)) & (F.col("l_linenumber") != 7)).withColumns(
        {"sales": base.restated(F.col("sales")), "file_week": newest})
    for drop in (first, recent):
        stored.write_feed_files(drop, folder, base.pair_count(spark, sf))
        # All feeds of a drop in one batch; the history window takes every week.
        run = ingest(wh, folder, checkpoint, run_date=date(2026, 1, 1), start_week=date(1990, 1, 6))
        run.awaitTermination()
    return _fact_of(wh)


@query
def capped_loads(spark, sf):
    """Four drops of each feed, at most two a load, until nothing waits."""
    wh, folder, newest = _warehouse(spark, sf), work_folder(spark, "landing"), base.newest_week(spark, sf)
    turn = F.pmod(F.floor(F.date_diff(newest, "week_date") / 7), F.lit(4)).cast("int")
    rows = base.sell_rows(spark, sf).withColumn("file_week", F.date_sub(newest, turn * 7))
    stored.write_feed_files(rows, folder, 4 * base.pair_count(spark, sf))
    turns = (f"turn{n}" for n in range(100))
    while load_folder(wh, folder, stamp=next(turns), run_date=date(2026, 1, 1), start_week=date(1990, 1, 6), max_drops=2):
        pass
    return _fact_of(wh).drop("is_restated")


def _two_drops(spark, sf) -> list[DataFrame]:
    """Sell rows of all weeks but the newest, and the next week's restatement, as in `upsert_result`."""
    rows, newest = base.sell_rows(spark, sf), base.newest_week(spark, sf)
    first = rows.filter(F.col("week_date") <= F.date_sub(newest, 7))
    recent = rows.filter((F.col("week_date") >= F.date_sub(newest, 28)) & (F.col("l_linenumber") != 7))
    return [first, recent.withColumn("sales", base.restated(F.col("sales")))]


ALL_WEEKS = {"run_date": date(2026, 1, 1), "start_week": date(1990, 1, 6)}


@query
def replayed_batch(spark, sf):
    """Two drops, and the second one's batch run again: the state of one run."""
    wh, folder, newest = _warehouse(spark, sf), work_folder(spark, "landing"), base.newest_week(spark, sf)
    for n, (drop, stamps) in enumerate(zip(_two_drops(spark, sf), (["one"], ["two", "two"]))):
        stored.write_feed_files(drop.withColumn("file_week", F.date_sub(newest, 7 - 7 * n)), folder, base.pair_count(spark, sf))
        for stamp in stamps:
            load_folder(wh, folder, stamp=stamp, **ALL_WEEKS)
    return _fact_of(wh)


@query
def kept_coverage(spark, sf):
    """Coverage of all pairs after two loads, from the sums and products that the loads keep."""
    wh, folder, newest = _warehouse(spark, sf), work_folder(spark, "landing"), base.newest_week(spark, sf)
    for n, drop in enumerate(_two_drops(spark, sf)):
        stored.write_feed_files(drop.withColumn("file_week", F.date_sub(newest, 7 - 7 * n)), folder, base.pair_count(spark, sf))
        load_folder(wh, folder, stamp=f"turn{n}", **ALL_WEEKS)
    t = Tables(wh.read("fact_sales"), wh.read("client"), wh.read("retailer"), wh.read("product"), weeks=wh.read("fact_weeks"), products_sold=wh.read("fact_products"))
    return views.fact_coverage(t)


@query
def redelivered_files(spark, sf):
    """A drop that is sent again under its name, with other rows, after the first one was loaded and moved to the archive."""
    wh, folder, archive = _warehouse(spark, sf), work_folder(spark, "landing"), work_folder(spark, "archive")
    for n, drop in enumerate(_two_drops(spark, sf)):
        stored.write_feed_files(drop.withColumn("file_week", base.newest_week(spark, sf)), folder, base.pair_count(spark, sf))
        load_folder(wh, folder, stamp=f"turn{n}", archive_folder=archive, **ALL_WEEKS)
    return _fact_of(wh)


@query
def out_of_order_drops(spark, sf):
    """Three overlapping drops, the middle, the newest and the oldest one loaded in this order by a warehouse that guards the order."""
    wh, folder, newest = dataclasses.replace(_warehouse(spark, sf), order_guard=True), work_folder(spark, "landing"), base.newest_week(spark, sf)
    rows, week, line = base.sell_rows(spark, sf), F.col("week_date"), F.col("l_linenumber")
    twice = base.restated(base.restated(F.col("sales")))
    drops = [(7, rows.filter(week.between(F.date_sub(newest, 56), F.date_sub(newest, 7)) & (line != 6)).withColumn("sales", twice)),
             (0, _two_drops(spark, sf)[1]), (14, rows.filter(week <= F.date_sub(newest, 14)))]
    for age, drop in drops:
        stored.write_feed_files(drop.withColumn("file_week", F.date_sub(newest, age)), folder, base.pair_count(spark, sf))
        load_folder(wh, folder, stamp=f"age{age}", **ALL_WEEKS)
    return _fact_of(wh).drop("is_restated")


@query
def stream_capped(spark, sf):
    """Four drops of each feed that arrive at once, handed to loads of at most two by the stream's backlog."""
    wh, folder, newest = _warehouse(spark, sf), work_folder(spark, "landing"), base.newest_week(spark, sf)
    turn = F.pmod(F.floor(F.date_diff(newest, "week_date") / 7), F.lit(4)).cast("int")
    rows = base.sell_rows(spark, sf).withColumn("file_week", F.date_sub(newest, turn * 7))
    stored.write_feed_files(rows, folder, 4 * base.pair_count(spark, sf))
    ingest(wh, folder, work_folder(spark, "stream"), max_drops=2, **ALL_WEEKS).awaitTermination()
    return _fact_of(wh).drop("is_restated")


@query
def stream_window_policy(spark, sf):
    """Two drops through the stream, in the feeds' own windows: what each batch's loads did with rows before the window, and with feeds whose
    first drop holds a week after its own."""
    wh, folder, checkpoint = _warehouse(spark, sf), work_folder(spark, "landing"), work_folder(spark, "stream")
    newest, first_drop = base.newest_week(spark, sf), _two_drops(spark, sf)[0]
    early = base.client_no(F.col("client_id")) % 7 == 3
    named = (first_drop.withColumn("file_week", F.when(early, F.date_sub(newest, 14)).otherwise(F.date_sub(newest, 7))),
             _two_drops(spark, sf)[1].withColumn("file_week", newest))
    for drop in named:
        stored.write_feed_files(drop, folder, base.pair_count(spark, sf))
        ingest(wh, folder, checkpoint, run_date=date(2026, 1, 1)).awaitTermination()
    counts = wh.read("load_files").groupBy("load_id").agg(*[F.sum(c).alias(c) for c in ("raw_rows", "parsed_rows", "out_of_window")])
    return counts.join(A.current_audit(wh.read("load_audit")).select("load_id", "status"), "load_id")


@query
def load_with_bad_feeds(spark, sf):
    """One batch in which every seventh brand's drops are dated on a Thursday and the next one's have sums that don't fit: how
    each load ended."""
    wh, folder, newest = _warehouse(spark, sf), work_folder(spark, "landing"), base.newest_week(spark, sf)
    no = base.client_no(F.col("client_id")) % 7
    huge = F.lit("9000000000000000").cast(S.MONEY)
    rows = base.sell_rows(spark, sf).withColumns({
        "file_week": F.when(no == 1, F.date_sub(newest, 2)).otherwise(newest),
        "sales": F.when((no == 2) & (F.col("l_linenumber") == 1), huge).otherwise(F.col("sales"))})
    stored.write_feed_files(rows, folder, base.pair_count(spark, sf))
    feeds_of_all_weeks = base.feeds(spark, sf).withColumns({"is_active": F.lit(True), "lookback_weeks": F.lit(1000).cast("smallint")})
    wh.replace_dimensions(pipeline_config=feeds_of_all_weeks)
    load_folder(wh, folder, stamp="bad", run_date=date(2026, 1, 1))
    return A.current_audit(wh.read("load_audit")).select("pipeline_id", "status", F.coalesce("fact_inserted", F.lit(0)).alias("fact_inserted"))


def flagship_tables(spark, sf) -> Tables:
    """The messy feed, parsed, mapped, checked and merged, as the fact of the views."""
    parsed = _parsed(spark, sf)
    pairs = base.pair_count(spark, sf)
    source = materialise(source_rows(parsed.output), "source")
    staging = materialise(map_products(source, base.stm(spark, sf)), "staging")
    passed = G.verdicts(G.control_totals(source, staging), base.loads(spark, sf)).filter("passed")
    fact = merge_source(base.keep_loads(staging, passed, pairs), base.loads(spark, sf), pairs)
    return Tables(fact, base.clients(spark, sf), base.retailers(spark, sf), base.products(spark, sf))


def flagship(spark, sf):
    """From feed text to sales by retailer in the latest week."""
    return for_export(reports.sales_by_retailer_latest(flagship_tables(spark, sf)))


QUERIES["flagship_feed_to_report"] = flagship
