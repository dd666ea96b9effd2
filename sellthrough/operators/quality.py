"""Checks of the product mapping, run before staging."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def stm_duplicates(stm: DataFrame) -> DataFrame:
    """Source keys with more than one mapping row; grouping treats the unused (NULL) key columns as equal."""
    return (stm.groupBy("client_id", "product_level", "src_product_id", "style", "color", "size")
            .agg(F.count("*").alias("mappings")).filter("mappings > 1"))


def stm_orphans(stm: DataFrame, product: DataFrame) -> DataFrame:
    """Mapping rows whose product is not in the product master."""
    return stm.join(product.select("product_id"), "product_id", "left_anti")


def mapping_quality(stm: DataFrame, product: DataFrame, staging: DataFrame) -> DataFrame:
    """Per client and level: mapping rows, doubled keys, rows without product, and what staging could not map."""
    keys = ["client_id", "product_level"]
    rows = stm.groupBy(*keys).agg(F.count("*").alias("stm_rows"))
    doubled = stm_duplicates(stm).groupBy(*keys).agg(F.count("*").alias("duplicate_keys"))
    orphans = stm_orphans(stm, product).groupBy(*keys).agg(F.count("*").alias("orphan_rows"))
    unmapped = (staging.filter("product_id IS NULL").groupBy(*keys, "src_product_key")
                .agg(F.count("*").alias("n"), F.sum("sales").alias("v")).groupBy(*keys)
                .agg(F.count("*").alias("unmapped_keys"), F.sum("n").alias("unmapped_rows"),
                     F.sum("v").cast("decimal(18,2)").alias("unmapped_sales")))
    joined = rows
    for part in (doubled, orphans, unmapped):
        joined = joined.join(part, keys, "full_outer")
    counts = ["stm_rows", "duplicate_keys", "orphan_rows", "unmapped_keys", "unmapped_rows"]
    return joined.select(*keys, *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                         F.coalesce("unmapped_sales", F.lit(0)).cast("decimal(18,2)").alias("unmapped_sales"))
