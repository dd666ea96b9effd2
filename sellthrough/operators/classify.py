"""Raw feed rows to typed, judged rows."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sellthrough import schemas as S
from sellthrough.functions import is_week_end, parse_count, parse_date, parse_money, round_count, round_money, strip_text
from sellthrough.operators.joins import join_bounded
from sellthrough.sources.layout import is_ragged, raw_map

NO_WEEK = "0001-01-01"      # a file without a week in its name counts as the oldest


def has_key(key: str) -> Column:
    """Whether the row's level uses this key column."""
    return F.col("product_level").isin([level.name for level in S.LEVELS.values() if key in level.keys])


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def reject_reason(key_columns=S.KEY_COLUMNS) -> Column:
    """Text of the first rule the typed row breaks, NULL for a good row."""
    keys = [F.col(k) for k in key_columns]
    return F.coalesce(
        F.when(_any([k == "TOTAL" for k in keys]), F.lit(S.REJECT_TOTAL)),
        F.when(F.col("week_date").isNull(), F.lit(S.REJECT_WEEK)),
        F.when(~is_week_end(F.col("week_date")), F.lit(S.REJECT_SATURDAY)),
        F.when(_any([k == "" for k in keys]), F.lit(S.REJECT_KEY)),
        F.when(F.col("sales").isNull(), F.lit(S.REJECT_SALES)),
        F.when(F.col("inventory").isNull(), F.lit(S.REJECT_INVENTORY)),
        F.when(~F.col("client_id").eqNullSafe(F.col("feed_client")), F.concat(F.lit(S.REJECT_CLIENT), "feed_client")),
        F.when(~F.col("retailer_id").eqNullSafe(F.col("feed_retailer")),
               F.concat(F.lit(S.REJECT_RETAILER), "feed_retailer")))


def annotate(raw: DataFrame, files: DataFrame, loads: DataFrame, files_bound: int) -> DataFrame:
    """Every raw row that is not blank, with its load, typed values, reject reason and place in the load window.

    A narrow plan: scan, one lookup of the file's load, column expressions. `files_bound` is the number of files."""
    feed = files.join(loads.select(
        "load_id", F.col("client_id").alias("feed_client"), F.col("retailer_id").alias("feed_retailer"),
        "product_level", "window_start", "window_end"), "load_id")
    feed = feed.withColumn("file_week", F.coalesce("file_week", F.lit(NO_WEEK).cast("date")))
    rows = join_bounded(raw, feed, "source_file", "inner", files_bound)

    # Ids the layout has no column for are stamped; any other absent column is a fault of the file.
    level_needs = {"week_date": F.lit(True), **{k: has_key(k) for k in S.KEY_COLUMNS},
                   "sales": F.lit(True), "inventory": F.lit(True)}
    missing = F.concat_ws(", ", *[F.when(need & F.col(c).isNull(), F.lit(c)) for c, need in level_needs.items()])
    text = {"client_id": F.coalesce(strip_text(F.col("client_id")), F.col("feed_client")),
            "retailer_id": F.coalesce(strip_text(F.col("retailer_id")), F.col("feed_retailer"))}
    for c, need in level_needs.items():
        text[c] = strip_text(F.col(c)) if c not in S.KEY_COLUMNS else F.when(need, F.upper(strip_text(F.col(c))))
    # A row blank in all needed cells is noise. Stamped ids make a row not blank. The cells are trimmed here as one text.
    cells = [F.coalesce(F.col("client_id"), F.lit("-")), F.coalesce(F.col("retailer_id"), F.lit("-")),
             *[F.when(need, F.col(c)) for c, need in level_needs.items()]]
    filled = rows.filter((strip_text(F.concat_ws("", *cells)) != "") | F.col("layout_error").isNotNull())

    trimmed = filled.withColumn("missing_columns", missing).withColumns(text)
    typed = (trimmed.withColumns({"week_date": parse_date(F.col("week_date")), "sales": parse_money(F.col("sales")),
                                 "inventory": parse_count(F.col("inventory"))})
             .withColumn("reject_reason", F.when(is_ragged(), F.lit(S.REJECT_RAGGED)).otherwise(reject_reason())))
    week = F.col("week_date")
    status = (F.when(F.col("reject_reason").isNotNull(), "reject").when(week > F.col("window_end"), "newer")
              .when(week < F.col("window_start"), "older").otherwise("kept"))
    return typed.withColumns({"status": status, "sales": round_money(F.col("sales")),
                              "inventory": round_count(F.col("inventory"))}).select(
        "load_id", "source_file", "file_week", "status", "reject_reason", "week_date", "client_id", "retailer_id",
        "product_level", *S.KEY_COLUMNS, "sales", "inventory",
        F.when(F.col("missing_columns") != "", F.col("missing_columns")).alias("missing_columns"), "layout_error",
        F.when(F.col("reject_reason").isNotNull(), raw_map()).alias("raw"))
