"""Curated views over the fact table: names instead of ids, metrics defined once, weeks counted from the newest week.

All are lazy DataFrames. Dimension joins carry no hint: the planner broadcasts a dimension while its size allows. The one
explicit broadcast is the newest week, one row by construction."""
from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sellthrough.functions import month_name, week_starting, weeks_ago
from sellthrough.operators.coverage import known_sums
from sellthrough.schemas import MONEY


@dataclass(frozen=True)
class Tables:
    """What the views read."""
    fact: DataFrame
    client: DataFrame
    retailer: DataFrame
    product: DataFrame
    config: DataFrame | None = None
    audit: DataFrame | None = None      # one row per load (operators.audit.current_audit)
    totals: DataFrame | None = None
    weeks: DataFrame | None = None      # operators.coverage.week_sums of the fact, kept up by the load
    products_sold: DataFrame | None = None      # operators.coverage.pair_products of it


def latest_week(weeks: DataFrame) -> DataFrame:
    """The newest week of a fact, or of its week sums."""
    return weeks.agg(F.max("week_date").alias("latest_week"))


def _weeks(t: Tables) -> DataFrame:
    """Rows with the fact's weeks and pairs, as few as there are."""
    return t.fact if t.weeks is None else t.weeks


def _star(t: Tables) -> DataFrame:
    """Fact rows with their names; a fact without a dimension row is left out."""
    product = t.product.select("product_id", "product_grain", "style", "color", "size", "product_name", "category")
    return (t.fact.join(t.client.select("client_id", "client_name"), "client_id")
            .join(t.retailer.select("retailer_id", "retailer_name"), "retailer_id")
            .join(product, "product_id"))


def _named(t: Tables, rows: DataFrame) -> DataFrame:
    """Rows of pairs with their names."""
    return rows.join(t.client.select("client_id", "client_name"), "client_id").join(t.retailer.select("retailer_id", "retailer_name"), "retailer_id")


def weekly_sales(t: Tables) -> DataFrame:
    return _star(t).select(
        "week_date", "client_id", "client_name", "retailer_id", "retailer_name", "product_id", "product_grain", "style",
        "color", "size", "product_name", "category", "sales", "inventory")


def chat_weekly_sales(t: Tables) -> DataFrame:
    """Product detail: one row per week, brand, retailer and product."""
    return _star(t).crossJoin(F.broadcast(latest_week(_weeks(t)))).select(
        F.col("week_date").alias("week_ending"), weeks_ago(F.col("week_date"), F.col("latest_week")).alias("weeks_ago"),
        F.col("client_name").alias("brand"), F.col("retailer_name").alias("retailer"), "category", "product_id",
        "product_name", "product_grain", "style", "color", "size", F.col("sales").alias("sales_usd"),
        F.col("inventory").alias("inventory_units"), (F.col("inventory") == 0).alias("is_out_of_stock"))


def sales_by_week(t: Tables) -> DataFrame:
    """Totals per week, brand, retailer and category with the change to the previous reported week.

    The window runs over the totals, at most one row per week in each of its groups."""
    totals = chat_weekly_sales(t).groupBy("week_ending", "weeks_ago", "brand", "retailer", "category").agg(
        F.sum("sales_usd").cast(MONEY).alias("sales_usd"), F.sum("inventory_units").cast("long").alias("inventory_units"),
        F.count("*").alias("products_reported"), F.count_if("is_out_of_stock").alias("products_out_of_stock"))
    before = Window.partitionBy("brand", "retailer", "category").orderBy("week_ending")
    sales, previous = F.col("sales_usd"), F.col("prev_week_sales_usd")
    change = (sales - previous).cast(MONEY)
    pct = F.round(F.lit(100.0) * change.cast("double") / previous.cast("double"), 1) + F.lit(0.0)
    return totals.withColumn("prev_week_sales_usd", F.lag("sales_usd").over(before)).withColumns({
        "wow_change_usd": change, "wow_change_pct": F.when(previous > 0, pct)})


def calendar(t: Tables) -> DataFrame:
    weeks = _weeks(t).select(F.col("week_date").alias("week_ending")).distinct()
    week = F.col("week_ending")
    # The newest week is the newest of the distinct weeks: they are read once.
    return weeks.crossJoin(F.broadcast(weeks.agg(F.max("week_ending").alias("latest_week")))).select(
        "week_ending", week_starting(week).alias("week_starting"), F.year(week).alias("year"),
        F.quarter(week).alias("quarter"), F.month(week).alias("month"), month_name(week).alias("month_name"),
        weeks_ago(week, F.col("latest_week")).alias("weeks_ago"))


def data_freshness(t: Tables) -> DataFrame:
    """Loaded weeks per brand and retailer, and when a load last succeeded. Fact and audit are each reduced to pairs
    before they meet; distinct weeks are deduplicated on the map side."""
    loaded = _weeks(t).select("client_id", "retailer_id", "week_date").distinct()
    done = t.audit.filter("status = 'SUCCESS'").groupBy("pipeline_id").agg(F.max("finished_at").alias("finished_at"))
    last = (t.config.select("client_id", "retailer_id", "pipeline_id").join(done, "pipeline_id")
            .groupBy("client_id", "retailer_id").agg(F.max("finished_at").alias("finished_at")))
    named = (loaded.join(t.client.select("client_id", "client_name"), "client_id")
             .join(t.retailer.select("retailer_id", "retailer_name"), "retailer_id")
             .join(last, ["client_id", "retailer_id"], "left"))
    return named.groupBy(F.col("client_name").alias("brand"), F.col("retailer_name").alias("retailer")).agg(
        F.min("week_date").alias("first_week_loaded"), F.max("week_date").alias("latest_week_loaded"),
        F.count_distinct("week_date").alias("weeks_loaded"), F.max("finished_at").alias("last_successful_load_at"))


def fact_coverage(t: Tables) -> DataFrame:
    """Weeks, products and sales per pair. The distinct counts run over (pair, week) and (pair, product) lines that are
    already unique, so no single task sees a pair's rows. With week sums and products of pairs the fact itself isn't read, but for
    products that have left the dimension."""
    pair = ["client_name", "retailer_name"]
    if t.weeks is not None and t.products_sold is not None:
        rows = _named(t, known_sums(t.weeks, t.products_sold, t.product, t.fact))
        products = _named(t, t.products_sold.join(t.product.select("product_id"), "product_id", "left_semi"))
    else:
        rows = products = weekly_sales(t)
    weeks = rows.groupBy(*pair, "week_date").agg(F.sum("sales").alias("sales")).groupBy(*pair).agg(
        F.min("week_date").alias("first_week"), F.max("week_date").alias("last_week"), F.count("*").alias("weeks"),
        F.sum("sales").cast(MONEY).alias("sales"))
    products = products.select(*pair, "product_id").distinct().groupBy(*pair).agg(F.count("*").alias("products"))
    return weeks.join(products, pair).select(*pair, "first_week", "last_week", "weeks", "products", "sales")


VIEWS = {"weekly_sales": weekly_sales, "chat_weekly_sales": chat_weekly_sales, "sales_by_week": sales_by_week,
         "calendar": calendar, "data_freshness": data_freshness}


def sold_combinations(t: Tables) -> DataFrame:
    """(brand, retailer, category, color, size) that the curated views show: distinct, from the products of pairs if they are kept, else from the fact."""
    rows = _star(t if t.products_sold is None else replace(t, fact=t.products_sold))
    return rows.select(F.col("client_name").alias("brand"), F.col("retailer_name").alias("retailer"), "category", "color", "size").distinct()


def register_views(spark: SparkSession, t: Tables) -> list[str]:
    """Make the views available to `spark.sql`."""
    from sellthrough.operators.audit import load_health

    views = {name: view for name, view in VIEWS.items() if name != "data_freshness" or t.audit is not None}
    for name, view in views.items():
        view(t).createOrReplaceTempView(name)
    names = list(views)
    if t.audit is not None and t.totals is not None:
        load_health(t.audit, t.totals).createOrReplaceTempView("load_reconciliation")
        names.append("load_reconciliation")
    return names
