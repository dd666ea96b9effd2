"""Control totals and the gate before the fact table."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sellthrough.functions import money_text
from sellthrough.operators.mapping import is_mapped
from sellthrough.schemas import MONEY

KEYS = ("load_id", "source", "week_date", "client_id", "retailer_id")
MEASURES = {"rows": "row_count", "sales": "sales", "inventory": "inventory"}


def _totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(F.count("*").alias("row_count"), F.sum("sales").try_cast(MONEY).alias("sales"),
                                   F.try_sum("inventory").alias("inventory"))


def control_totals(source: DataFrame, staging: DataFrame) -> DataFrame:
    """Rows, sales and inventory by week: `src` before mapping, `stg` mapped, `rej` unmapped (one pass for both)."""
    staged = staging.withColumn("source", F.when(is_mapped(), "stg").otherwise("rej"))
    return _totals(source.withColumn("source", F.lit("src"))).unionByName(_totals(staged))


def _sum_of(column: str, *sources: str) -> Column:
    return F.try_sum(F.when(F.col("source").isin(*sources), F.col(column)))


def reconcile(totals: DataFrame) -> DataFrame:
    """Per load and week: source against mapped plus rejected, exactly equal in rows, sales and inventory."""
    def side(column: str, *sources: str) -> Column:
        return F.coalesce(_sum_of(column, *sources), F.lit(0)).try_cast(MONEY if column == "sales" else "long")

    weeks = totals.groupBy("load_id", "week_date").agg(
        side("row_count", "src").alias("src_rows"), side("row_count", "stg", "rej").alias("out_rows"),
        side("sales", "src").alias("src_sales"), side("sales", "stg", "rej").alias("out_sales"),
        side("inventory", "src").alias("src_inv"), side("inventory", "stg", "rej").alias("out_inv"),
        side("row_count", "rej").alias("rej_rows"),
        F.count_if(F.col("sales").isNull() | F.col("inventory").isNull()).alias("unfit"))
    same = ((F.col("src_rows") == F.col("out_rows")) & (F.col("src_sales") == F.col("out_sales"))
            & (F.col("src_inv") == F.col("out_inv")))
    # A total that is NULL did not fit its type.
    return weeks.withColumn("is_reconciled", F.coalesce(same & (F.col("unfit") == 0), F.lit(False))).drop("unfit")


def verdicts(totals: DataFrame, loads: DataFrame) -> DataFrame:
    """One line per load: weeks, weeks that do not reconcile, rejected rows, and whether it may reach the fact table.
    A load without totals does not pass."""
    by_load = reconcile(totals).groupBy("load_id").agg(
        F.count("*").alias("weeks"), F.count_if(~F.col("is_reconciled")).alias("bad_weeks"),
        F.sum("rej_rows").alias("rejected_rows"))
    zero = F.lit(0).cast("long")
    return loads.select("load_id").join(by_load, "load_id", "left").select(
        "load_id", *[F.coalesce(c, zero).alias(c) for c in ("weeks", "bad_weeks", "rejected_rows")],
        (F.coalesce("weeks", zero) > 0).__and__(F.coalesce("bad_weeks", zero) == 0).alias("passed"))


def check_reconciled(totals: DataFrame, loads: DataFrame) -> None:
    """Strict mode: raise when any load does not pass."""
    bad = verdicts(totals, loads).filter("NOT passed").orderBy("load_id").limit(1).collect()
    if bad and bad[0].weeks == 0:
        raise ValueError(f"no stats recorded for {bad[0].load_id}")
    if bad:
        raise ValueError(f"src != stg + rej for {bad[0].load_id} in {bad[0].bad_weeks} of {bad[0].weeks} weeks")


def stats_by_week(totals: DataFrame) -> DataFrame:
    """Nine sums side by side per load and week, NULL where a source has no line."""
    return totals.groupBy("load_id", "week_date").agg(*[
        _sum_of(column, source).cast(MONEY if measure == "sales" else "long").alias(f"{source}_{measure}")
        for measure, column in MEASURES.items() for source in ("src", "stg", "rej")])


def findings(totals: DataFrame) -> DataFrame:
    """Differences per load and week that does not reconcile, also in words. Negative = rows came twice, positive = rows
    got lost."""
    lines = stats_by_week(totals)
    texts = []
    for measure in MEASURES:
        kind = MONEY if measure == "sales" else "long"
        src, stg, rej = (F.coalesce(f"{s}_{measure}", F.lit(0)).cast(kind) for s in ("src", "stg", "rej"))
        out = (stg + rej).cast(kind)
        lines = lines.withColumns({f"out_{measure}": out, f"diff_{measure}": (src - out).cast(kind)})
        diff = F.col(f"diff_{measure}")

        def show(c: Column, measure=measure) -> Column:
            return money_text(c) if measure == "sales" else c.cast("string")

        texts.append(F.when(diff != 0, F.concat(
            F.lit(f"{measure} src "), show(src), F.lit(" vs stg + rej "), show(F.col(f"out_{measure}")), F.lit(" ("),
            show(F.abs(diff)), F.when(diff < 0, " duplicated)").otherwise(" lost)"))))
    text = F.concat(F.col("week_date").cast("string"), F.lit(": "), F.concat_ws("; ", *texts))
    differs = " OR ".join(f"diff_{m} <> 0" for m in MEASURES)
    return lines.filter(differs).select("load_id", "week_date", *[f"diff_{m}" for m in MEASURES], text.alias("finding"))
