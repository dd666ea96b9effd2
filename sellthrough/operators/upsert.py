"""Weekly upsert of mapped rows into the fact table."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sellthrough import schemas as S
from sellthrough.operators.joins import join_bounded
from sellthrough.operators.mapping import is_mapped

FACT_KEY = ["week_date", "client_id", "retailer_id", "product_id"]


def merge_source(staging: DataFrame, loads: DataFrame, loads_bound: int) -> DataFrame:
    """Mapped rows inside their load's window, summed to the fact's grain: several source keys may mean one product.

    `loads` is metadata, at most `loads_bound` rows. A pair's rows carry its latest load of the batch; that is settled on
    `loads`, since a maximum of text would turn the hash aggregate into a sort. Sums are partial before the shuffle."""
    pair = ["client_id", "retailer_id"]
    latest = loads.groupBy(*pair).agg(F.max("load_id").alias("latest_load"))
    windows = loads.join(latest, pair).select("load_id", "latest_load", "window_start", "window_end")
    inside = (join_bounded(staging.filter(is_mapped()), windows, "load_id", "inner", loads_bound)
              .filter(F.col("week_date").between(F.col("window_start"), F.col("window_end"))))
    return inside.groupBy(*FACT_KEY, F.col("latest_load").alias("load_id")).agg(
        F.sum("sales").cast(S.MONEY).alias("sales"), F.sum("inventory").cast("long").alias("inventory")).select(
        *FACT_KEY, "sales", "inventory", "load_id")


def matched_rows(fact: DataFrame, source: DataFrame, loaded_at: Column, file_week_guard: bool = False) -> DataFrame:
    """Full outer join of fact and merge source: the new fact rows plus `outcome` (updated, inserted, kept).

    Both sides are unique on the four keys, so no key is heavy. `file_week`, the week of the drop that a row comes from, goes along where both
    sides have it. With the guard (an extension, off by default) a row from an older drop does not replace one from a newer drop; rows of
    unknown drops are replaced."""
    old, new = fact.alias("f"), source.alias("s")
    on = [F.col(f"f.{k}") == F.col(f"s.{k}") for k in FACT_KEY]
    rows = old.join(new, on, "full_outer")
    exists, arrives = F.col("f.load_id").isNotNull(), F.col("s.load_id").isNotNull()
    if file_week_guard:
        arrives = arrives & ~F.coalesce(F.col("s.file_week") < F.col("f.file_week"), F.lit(False))
    outcome = F.when(arrives & exists, "updated").when(arrives, "inserted").otherwise("kept")
    versioned = "file_week" in fact.columns and "file_week" in source.columns
    values = ["sales", "inventory", "load_id", *(["file_week"] if versioned else [])]
    return rows.select(
        *[F.coalesce(f"f.{k}", f"s.{k}").alias(k) for k in FACT_KEY],
        *[F.when(arrives, F.col(f"s.{v}")).otherwise(F.col(f"f.{v}")).alias(v) for v in values],
        F.when(exists, F.col("f.inserted_at")).otherwise(loaded_at).alias("inserted_at"),
        F.when(arrives, loaded_at).otherwise(F.col("f.updated_at")).alias("updated_at"),
        outcome.alias("outcome"))


def with_file_weeks(source: DataFrame, file_weeks: DataFrame, loads: DataFrame, weeks_bound: int) -> DataFrame:
    """Merge source with the week of the drop that reports each pair's week. `file_weeks` has a line per load and week, `weeks_bound` at most."""
    of_pair = ["client_id", "retailer_id", "week_date"]
    lines = file_weeks.join(loads.select("load_id", "client_id", "retailer_id"), "load_id").groupBy(*of_pair).agg(F.max("file_week").alias("file_week"))
    return join_bounded(source, lines, of_pair, "left", weeks_bound)


def upsert_weekly(fact: DataFrame, staging: DataFrame, loads: DataFrame, loaded_at: Column,
                  loads_bound: int) -> tuple[DataFrame, DataFrame]:
    """(fact rows after the upsert, counters per load), both lazy and from the same joined rows."""
    rows = matched_rows(fact, merge_source(staging, loads, loads_bound), loaded_at)
    counters = rows.filter("outcome <> 'kept'").groupBy("load_id").agg(
        F.count_if(F.col("outcome") == "inserted").alias("fact_inserted"),
        F.count_if(F.col("outcome") == "updated").alias("fact_updated"))
    return rows.select(S.FACT_SALES.names), counters


def written_counters(fact: DataFrame, loaded_at: Column) -> DataFrame:
    """Counters read back from the written fact: rows of this run are those stamped `loaded_at`; the ones inserted now
    carry it as insert time too. Exact however often a task was retried, and touches three columns."""
    return fact.filter(F.col("updated_at") == loaded_at).groupBy("load_id").agg(
        F.count_if(F.col("inserted_at") == loaded_at).alias("fact_inserted"),
        F.count_if(F.col("inserted_at") < loaded_at).alias("fact_updated"))


def merge_into_catalog(source: DataFrame, table: str, loaded_at: Column) -> None:
    """The same upsert on a catalog table whose format supports row-level MERGE."""
    fresh = source.alias("s")
    on = [F.col(f"{table}.{k}") == F.col(f"s.{k}") for k in FACT_KEY]
    condition = on[0] & on[1] & on[2] & on[3]
    update = {c: F.col(f"s.{c}") for c in ("sales", "inventory", "load_id")}
    insert = {c: F.col(f"s.{c}") for c in (*FACT_KEY, "sales", "inventory", "load_id")}
    (fresh.mergeInto(table, condition)
     .whenMatched().update({**update, "updated_at": loaded_at})
     .whenNotMatched().insert({**insert, "inserted_at": loaded_at, "updated_at": loaded_at})
     .merge())


def restated_rows(fact: DataFrame) -> DataFrame:
    """Per week: rows, and rows a later load changed."""
    return fact.groupBy("week_date").agg(
        F.count("*").alias("rows"), F.count_if(F.col("updated_at") > F.col("inserted_at")).alias("restated"))
