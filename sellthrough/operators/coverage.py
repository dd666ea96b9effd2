"""What the fact holds, in tables that a load keeps up: sums of every pair and week, and the products of every pair.

Both merge without the fact's older rows: a week's sums are made anew from the week when it is rewritten, and products of a pair are only ever
added, as an upsert takes no rows away. Views that ask for weeks, coverage and known values read these tables, which are smaller than the fact
by the products of a pair and the weeks of a product."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sellthrough.schemas import MONEY

PAIR_PRODUCT = ["client_id", "retailer_id", "product_id"]


def week_sums(fact: DataFrame) -> DataFrame:
    """(week_date, client_id, retailer_id, rows, sales, inventory)."""
    return fact.groupBy("week_date", "client_id", "retailer_id").agg(
        F.count("*").alias("rows"), F.sum("sales").cast(MONEY).alias("sales"), F.sum("inventory").cast("long").alias("inventory"))


def pair_products(fact: DataFrame) -> DataFrame:
    return fact.select(*PAIR_PRODUCT).distinct()


def new_products(fact: DataFrame, known: DataFrame) -> DataFrame:
    """Products of pairs that are not known yet."""
    return pair_products(fact).join(known.select(*PAIR_PRODUCT), PAIR_PRODUCT, "left_anti")


def known_sums(weeks: DataFrame, products: DataFrame, dimension: DataFrame, fact: DataFrame) -> DataFrame:
    """Week sums of products that are in the dimension. Sums of others are taken off; the fact is read only if there are others, and for those."""
    orphans = products.join(dimension.select("product_id"), "product_id", "left_anti")
    if orphans.isEmpty():
        return weeks
    keys = ["week_date", "client_id", "retailer_id"]
    off = week_sums(fact.join(orphans, PAIR_PRODUCT, "left_semi"))
    left = weeks.join(off.select(*keys, *[F.col(c).alias(f"{c}_off") for c in ("rows", "sales", "inventory")]), keys, "left")
    return left.select(*keys, *[(F.col(c) - F.coalesce(f"{c}_off", F.lit(0))).cast(weeks.schema[c].dataType).alias(c) for c in ("rows", "sales", "inventory")]).filter("rows > 0")
