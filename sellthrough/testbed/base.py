"""Clean sell-through rows, dimensions, mapping and loads."""
from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sellthrough import schemas as S
from sellthrough.functions import week_ending
from sellthrough.operators.joins import join_bounded
from sellthrough.operators.mapping import build_products, build_stm
from sellthrough.session import local_rows, work_folder

HISTORY_START = "1996-01-06"
STAMP, NEXT_STAMP = "20260101T000000", "20260108T000000"
LOADED_AT, NEXT_LOADED_AT = "2026-01-01 00:00:00", "2026-01-08 00:00:00"
_landed: dict[tuple[str, str], str] = {}
_known: dict[tuple[str, str], tuple[list[tuple], date]] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def client_of(brand: Column) -> Column:
    return F.concat(F.lit("B"), F.substring_index(brand, "#", -1))


def client_no(client_id: Column) -> Column:
    return F.substring(client_id, 2, 10).cast("int")


def retailer_of(segment: Column) -> Column:
    return F.substring(segment, 1, 4)


def level_of(retailer_id: Column) -> Column:
    """Each retailer reports at one level."""
    return (F.when(retailer_id.isin("AUTO", "BUIL"), "serial").when(retailer_id.isin("FURN", "HOUS"), "sku")
            .otherwise("style"))


def serial_of(partkey: Column) -> Column:
    return F.lpad(partkey.cast("string"), 12, "0")


def color_of(name: Column) -> Column:
    return F.upper(F.substring_index(name, " ", 1))


def sell_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One row per line item: who sold what, where, in which week."""
    line = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    order = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_name", "p_size")
    buyer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    rows = (line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(buyer, F.col("o_custkey") == F.col("c_custkey")).join(part, F.col("l_partkey") == F.col("p_partkey")))
    retailer = retailer_of(F.col("c_mktsegment"))
    return rows.select(
        client_of(F.col("p_brand")).alias("client_id"), retailer.alias("retailer_id"),
        level_of(retailer).alias("product_level"), F.col("l_suppkey").alias("store"),
        serial_of(F.col("l_partkey")).alias("serial"), F.col("p_type").alias("style"),
        color_of(F.col("p_name")).alias("color"), F.col("p_size").cast("string").alias("size"),
        week_ending(F.col("day")).alias("week_date"), F.col("l_extendedprice").cast(S.MONEY).alias("sales"),
        F.col("l_quantity").cast("long").alias("inventory"), "l_orderkey", "l_linenumber", "l_partkey")


def newest_week(spark: SparkSession, sf: str) -> Column:
    """The newest week of all orders."""
    return F.lit(_metadata(spark, sf)[1])


def restated(sales: Column) -> Column:
    return (sales * F.lit("1.01").cast("decimal(3,2)")).cast(S.MONEY)


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """SKU catalog: one row per part."""
    part = table(spark, sf, "part")
    client = client_of(F.col("p_brand"))
    return part.select(
        client.alias("client_id"), F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id"),
        serial_of(F.col("p_partkey")).alias("serial"), F.col("p_type").alias("style"),
        color_of(F.col("p_name")).alias("color"), F.col("p_size").cast("string").alias("size"),
        F.col("p_name").alias("product_name"), F.concat(F.lit("Style "), F.col("p_type")).alias("style_name"),
        category_of(client).alias("category"), F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        "p_partkey")


def category_of(client: Column) -> Column:
    return F.concat(F.lit("Category "), (client_no(client) % 5).cast("string"))


def full_stm(spark: SparkSession, sf: str) -> DataFrame:
    """Mapping of the whole catalog. Parts of one brand may share style, colour and size, so it maps some keys twice."""
    return build_stm(catalog(spark, sf))


def stm(spark: SparkSession, sf: str) -> DataFrame:
    """Mapping with gaps and no doubled key: parts divisible by 50 and one style of every seventh brand are missing."""
    parts = catalog(spark, sf)
    sku_key = ["client_id", "style", "color", "size"]
    first = parts.groupBy(*sku_key).agg(F.min("p_partkey").alias("p_partkey"))
    none = F.lit(None).cast("string")
    known = F.col("p_partkey") % 50 != 0
    product = F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("product_id")
    serial = parts.filter(known).select(
        "client_id", F.lit("serial").alias("product_level"), F.col("serial").alias("src_product_id"),
        none.alias("style"), none.alias("color"), none.alias("size"), product)
    sku = first.filter(known).select("client_id", F.lit("sku").alias("product_level"), none.alias("src_product_id"),
                                     "style", "color", "size", product)
    style = (build_stm(parts).filter("product_level = 'style'")
             .filter((client_no(F.col("client_id")) % 7 != 0) | (F.col("style") != "ECONOMY")))
    return serial.unionByName(sku).unionByName(style)


def doubled_stm(spark: SparkSession, sf: str) -> DataFrame:
    """As `stm`, with a second mapping for some serials."""
    clean = stm(spark, sf)
    again = (clean.filter("product_level = 'serial'").filter(F.col("src_product_id").cast("long") % 97 == 1)
             .withColumn("product_id", F.concat("product_id", F.lit("X"))))
    return clean.unionByName(again)


def clients(spark: SparkSession, sf: str) -> DataFrame:
    brands = table(spark, sf, "part").select("p_brand").distinct()
    client = client_of(F.col("p_brand"))
    return brands.select(client.alias("client_id"), F.col("p_brand").alias("client_name"),
                         category_of(client).alias("category"))


def retailers(spark: SparkSession, sf: str) -> DataFrame:
    segments = table(spark, sf, "customer").select("c_mktsegment").distinct()
    return segments.select(retailer_of(F.col("c_mktsegment")).alias("retailer_id"),
                           F.col("c_mktsegment").alias("retailer_name"))


def products(spark: SparkSession, sf: str) -> DataFrame:
    return build_products(catalog(spark, sf))


def _metadata(spark: SparkSession, sf: str) -> tuple[list[tuple], date]:
    """(client and retailer of every feed, newest week), read once per session. This is what a feed registry holds: one
    line per feed, whatever the number of rows."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _known:
        brands = [r.client_id for r in clients(spark, sf).select("client_id").collect()]
        shops = [r.retailer_id for r in retailers(spark, sf).select("retailer_id").collect()]
        newest = table(spark, sf, "orders").agg(week_ending(F.max("o_orderdate").cast("date"))).first()[0]
        _known[key] = [(c, r) for c in sorted(brands) for r in sorted(shops)], newest
    return _known[key]


def feeds(spark: SparkSession, sf: str) -> DataFrame:
    """Feed metadata: every brand reports through every retailer."""
    pairs = local_rows(spark, _metadata(spark, sf)[0], S.table_schema("client_id string, retailer_id string"))
    pair = F.concat_ws("_", "client_id", "retailer_id")
    no = client_no(F.col("client_id"))
    level = level_of(F.col("retailer_id"))
    return pairs.select(
        pair.alias("pipeline_id"), "client_id", "retailer_id", level.alias("product_level"),
        F.when(F.col("retailer_id") == "HOUS", "api").otherwise("s3").alias("source_type"),
        F.concat(F.lit("client="), "client_id", F.lit("/retailer="), "retailer_id").alias("source_location"),
        F.when(level == "sku", "json").otherwise("csv").alias("file_format"),
        F.lit("0 7 * * *").alias("schedule"), F.lit(5).cast("smallint").alias("lookback_weeks"),
        (no % 6 != 0).alias("is_active"), (no % 4 != 0).alias("promoted_to_prod"))


def pair_count(spark: SparkSession, sf: str) -> int:
    """Number of feeds: the bound of everything that has one row per feed."""
    return len(_metadata(spark, sf)[0])


# Weeks the order dates can span in one load window; bounds lookups with a row per load and week.
WINDOW_WEEKS = 1000


def loads(spark: SparkSession, sf: str, stamp: str = STAMP) -> DataFrame:
    """One load per feed over the history window. Every tenth brand's loads at one retailer end a week early."""
    early = (client_no(F.col("client_id")) % 10 == 3) & (F.col("retailer_id") == "MACH")
    newest = newest_week(spark, sf)
    return feeds(spark, sf).select(
        F.concat_ws("_", "pipeline_id", F.lit(stamp)).alias("load_id"), "pipeline_id", "client_id", "retailer_id",
        "product_level", F.lit("history").alias("load_type"), F.lit(HISTORY_START).cast("date").alias("window_start"),
        F.when(early, F.date_sub(newest, 7)).otherwise(newest).alias("window_end"))


def open_loads(spark: SparkSession, sf: str, stamp: str = STAMP) -> DataFrame:
    """As `loads`, every window reaching over all weeks."""
    return loads(spark, sf, stamp).withColumns({
        "window_start": F.lit("1990-01-06").cast("date"), "window_end": F.lit("2010-01-02").cast("date")})


def landing_of(rows: DataFrame, stamp: str = STAMP) -> DataFrame:
    """Sell rows as landing rows, without the detour over feed text."""
    level = F.col("product_level")

    def key(name: str, *levels: str) -> Column:
        return F.when(level.isin(*levels), F.col(name))

    return rows.select(
        F.concat_ws("_", "client_id", "retailer_id", F.lit(stamp)).alias("load_id"), "week_date", "client_id",
        "retailer_id", "product_level", key("serial", "serial").alias("product_id"),
        key("style", "sku", "style").alias("style"), key("color", "sku").alias("color"), key("size", "sku").alias("size"),
        "sales", "inventory")


def landing(spark: SparkSession, sf: str) -> DataFrame:
    """The landing table: every sell row, stored by level and written once per session, as staging reads it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _landed:
        path = work_folder(spark, "landing")
        landing_of(sell_rows(spark, sf)).write.partitionBy("product_level").parquet(path)
        _landed[key] = path
    return spark.read.schema(S.LANDING).parquet(_landed[key])


def first_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Landing rows of a first load: all weeks but the newest."""
    rows = sell_rows(spark, sf)
    return landing_of(rows.filter(F.col("week_date") <= F.date_sub(newest_week(spark, sf), 7)))


def second_drop(spark: SparkSession, sf: str) -> DataFrame:
    """Landing rows of the next load: the last five weeks, restated; rows with line number 7 are no longer reported."""
    rows = sell_rows(spark, sf)
    recent = rows.filter((F.col("week_date") >= F.date_sub(newest_week(spark, sf), 28)) & (F.col("l_linenumber") != 7))
    return landing_of(recent.withColumn("sales", restated(F.col("sales"))), NEXT_STAMP)


def keep_loads(rows: DataFrame, load_ids: DataFrame, bound: int) -> DataFrame:
    return join_bounded(rows, load_ids.select("load_id"), "load_id", "left_semi", bound)
