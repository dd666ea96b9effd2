"""Landing rows to staging: roll-up per level, mapping of source keys to products, unmapped keys."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sellthrough import schemas as S


def rollup(landing: DataFrame) -> DataFrame:
    """Sum the rows of sku and style feeds (one per store) to their key columns. Partial sums run before the shuffle."""
    levels = [level.name for level in S.LEVELS.values() if level.rollup]
    keys = ["load_id", "week_date", "client_id", "retailer_id", "product_level", *S.KEY_COLUMNS]
    return landing.filter(F.col("product_level").isin(levels)).groupBy(*keys).agg(
        F.sum("sales").try_cast(S.MONEY).alias("sales"), F.try_sum("inventory").alias("inventory"),
        F.count("*").alias("source_rows")).select(S.PRESTAGE.names)


def source_rows(landing: DataFrame) -> DataFrame:
    """What is mapped and counted as source: serial rows as they landed, sku and style rows rolled up."""
    levels = [level.name for level in S.LEVELS.values() if not level.rollup]
    plain = landing.filter(F.col("product_level").isin(levels)).withColumn("source_rows", F.lit(1).cast("long"))
    return plain.select(S.PRESTAGE.names).unionByName(rollup(landing))


def source_key() -> Column:
    """The level's key columns as one text; NULL if any part is."""
    def text(level: S.Level) -> Column:
        return F.concat(*[p for k in level.keys for p in (F.lit("|"), F.col(k))][1:])
    return _by_level(text)


def _by_level(value) -> Column:
    return F.coalesce(*[F.when(F.col("product_level") == level.name, value(level)) for level in S.LEVELS.values()])


def _join_keys(stm: bool) -> list[Column]:
    """Three key parts that fit every level: its own columns, then '' where it has fewer. A NULL part never matches."""
    def part(level: S.Level, i: int) -> Column:
        if i >= len(level.keys):
            return F.lit("")
        return F.col("src_product_id" if stm and level.name == "serial" else level.keys[i])
    return [_by_level(lambda level, i=i: part(level, i)).alias(f"key{i}") for i in range(3)]


def map_products(source: DataFrame, stm: DataFrame) -> DataFrame:
    """Left join to the source-to-target mapping on the level's own keys, all levels in one join: an unmapped row keeps a
    NULL product, a key mapped twice doubles its row, which the control totals then show.

    No join hint: the planner broadcasts the mapping while its size allows and otherwise shuffles by key, splitting
    skewed partitions (AQE)."""
    target = stm.select("client_id", "product_level", *_join_keys(stm=True), F.col("product_id").alias("mapped_id"))
    rows = source.select("*", *_join_keys(stm=False), source_key().alias("src_product_key"))
    joined = rows.join(target, ["client_id", "product_level", "key0", "key1", "key2"], "left")
    return joined.withColumn("product_id", F.col("mapped_id")).select(S.STAGING.names)


def merge_levels(parts: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def is_mapped() -> Column:
    return F.col("product_id").isNotNull()


def unmapped_keys(staging: DataFrame) -> DataFrame:
    """Per load and source key without product: weeks, rows, sales."""
    return staging.filter(~is_mapped()).groupBy("load_id", "src_product_key").agg(
        F.min("week_date").alias("first_week"), F.max("week_date").alias("last_week"),
        F.count("*").alias("rows"), F.sum("sales").cast(S.MONEY).alias("sales"))


def rejected_by_pair(staging: DataFrame) -> DataFrame:
    return staging.filter(~is_mapped()).groupBy("client_id", "retailer_id", "product_level", "src_product_key").agg(
        F.count("*").alias("rows"), F.sum("sales").cast(S.MONEY).alias("sales"))


def build_products(catalog: DataFrame) -> DataFrame:
    """Product master from a SKU catalog (client_id, product_id, serial, style, color, size, product_name, style_name,
    category, unit_price): the SKUs, and one product per style priced as its first SKU."""
    skus = catalog.select("product_id", "client_id", F.lit("sku").alias("product_grain"), "style", "color", "size",
                          "product_name", "category", "unit_price")
    styles = (catalog.groupBy("client_id", "style")
              .agg(F.min_by("style_name", "product_id").alias("product_name"),
                   F.min_by("category", "product_id").alias("category"),
                   F.min_by("unit_price", "product_id").alias("unit_price"))
              .withColumns({"product_id": F.concat_ws("-", "client_id", "style"), "product_grain": F.lit("style"),
                            "color": F.lit(None).cast("string"), "size": F.lit(None).cast("string")}))
    return skus.unionByName(styles).select(S.PRODUCT.names)


def build_stm(catalog: DataFrame) -> DataFrame:
    """Mapping rows of a SKU catalog: each SKU by serial and by style/color/size, each style by its code."""
    none = F.lit(None).cast("string")
    by_sku = catalog.select("client_id", "product_id", F.explode(F.array(
        F.struct(F.lit("serial").alias("product_level"), F.col("serial").alias("src_product_id"), none.alias("style"),
                 none.alias("color"), none.alias("size")),
        F.struct(F.lit("sku").alias("product_level"), none.alias("src_product_id"), F.col("style").alias("style"),
                 F.col("color").alias("color"), F.col("size").alias("size")))).alias("m"))
    by_style = catalog.select("client_id", "style").distinct().select(
        "client_id", F.lit("style").alias("product_level"), none.alias("src_product_id"), "style",
        none.alias("color"), none.alias("size"), F.concat_ws("-", "client_id", "style").alias("product_id"))
    return by_sku.select("client_id", "m.*", "product_id").unionByName(by_style).select(S.PRODUCT_STM.names)
