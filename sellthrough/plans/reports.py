"""Named reports over the curated views."""
from __future__ import annotations

from dataclasses import replace
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from sellthrough.plans import views
from sellthrough.plans.views import Tables
from sellthrough.schemas import MAX_KNOWN_VALUES, MAX_RESULT_ROWS, MONEY
from sellthrough.session import materialise

KNOWN_VALUE_COLUMNS = {
    "sales_by_week": ("brand", "retailer", "category"),
    "chat_weekly_sales": ("brand", "retailer", "category", "color", "size"),
    "calendar": ("month_name",),
    "data_freshness": ("brand", "retailer"),
}


def capped(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """At most `limit` rows, never more than 500."""
    return rows.limit(min(limit or MAX_RESULT_ROWS, MAX_RESULT_ROWS))


def for_export(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as ISO text."""
    def plain(field: T.StructField):
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return c.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            # ISO text shows microseconds only where there are any.
            whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
            micros = F.date_format(c, "SSSSSS")
            return F.when(micros == "000000", whole).otherwise(F.concat_ws(".", whole, micros)).alias(field.name)
        return c
    return rows.select(*[plain(f) for f in rows.schema.fields])


def _sales(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("sales_usd").cast(MONEY).alias("sales_usd"))


def recent(t: Tables, weeks: int) -> Tables:
    """The tables with the fact cut to its newest weeks. The newest week is one value, asked for first: as plain dates the
    weeks prune the fact's partitions below the joins, which a comparison with `weeks_ago` above them cannot."""
    newest = views.latest_week(t.fact if t.weeks is None else t.weeks).first().latest_week
    wanted = [newest - timedelta(weeks=i) for i in range(weeks)] if newest else []
    return replace(t, fact=t.fact.filter(F.col("week_date").isin(wanted)))


def sales_by_retailer_latest(t: Tables) -> DataFrame:
    """Total sales by retailer in the latest week."""
    week = views.sales_by_week(recent(t, 1)).filter("weeks_ago = 0")
    return _sales(week, "retailer").orderBy(F.desc("sales_usd"), "retailer")


def period_compare(t: Tables, brand: str, retailer: str) -> DataFrame:
    """Last 4 weeks against the 4 before; NULL for a period without rows."""
    rows = views.sales_by_week(recent(t, 8)).filter(
        (F.col("brand") == brand) & (F.col("retailer") == retailer) & F.col("weeks_ago").between(0, 7))
    return rows.agg(*_period_sums())


def period_compare_all(t: Tables) -> DataFrame:
    """The same comparison for every brand and retailer."""
    rows = views.sales_by_week(recent(t, 8)).filter(F.col("weeks_ago").between(0, 7))
    return rows.groupBy("brand", "retailer").agg(*_period_sums())


def _period_sums():
    def between(first: int, last: int):
        return F.sum(F.when(F.col("weeks_ago").between(first, last), F.col("sales_usd"))).cast(MONEY)
    return [between(0, 3).alias("last_4_weeks_usd"), between(4, 7).alias("prior_4_weeks_usd")]


def top_products(t: Tables, brand: str, weeks: int = 4, n: int = 5) -> DataFrame:
    """Best sellers of a brand in the last weeks; equal sales are ordered by name and retailer."""
    rows = views.chat_weekly_sales(recent(t, weeks)).filter((F.col("brand") == brand) & F.col("weeks_ago").between(0, weeks - 1))
    return _sales(rows, "product_name", "retailer").orderBy(F.desc("sales_usd"), "product_name", "retailer").limit(n)


def out_of_stock(t: Tables) -> DataFrame:
    """Products without units on hand in the latest week."""
    rows = views.chat_weekly_sales(recent(t, 1)).filter("weeks_ago = 0 AND is_out_of_stock")
    return rows.select("brand", "retailer", "product_name").orderBy("brand", "retailer", "product_name")


def sales_by_month(t: Tables, brand: str) -> DataFrame:
    """Sales of a brand by calendar month of the week's end."""
    rows = views.sales_by_week(t).filter(F.col("brand") == brand)
    months = views.calendar(t).select("week_ending", "year", "month", "month_name")
    return (_sales(rows.join(months, "week_ending"), "year", "month", "month_name").orderBy("year", "month")
            .select("month_name", "sales_usd"))


def freshness_for_retailer(t: Tables, retailer: str) -> DataFrame:
    rows = views.data_freshness(t).filter(F.col("retailer") == retailer)
    return rows.select("brand", "latest_week_loaded", "last_successful_load_at").orderBy("brand")


def known_values(rows: DataFrame, columns: tuple[str, ...], limit: int = MAX_KNOWN_VALUES) -> DataFrame:
    """(column_name, value): distinct values of each column in order, at most `limit` a column, for any row count.

    One read: distinct combinations first (reduced on the map side), then one line per column and value. The rank is cut
    on the map side as well."""
    combinations = rows.select(*[F.col(c).cast("string").alias(c) for c in columns]).distinct()
    lines = combinations.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in columns])).alias("v")).select("v.*")
    order = Window.partitionBy("column_name").orderBy("value")
    return (lines.filter("value IS NOT NULL").distinct().withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= limit).drop("rank"))


def all_known_values(t: Tables) -> DataFrame:
    """Known values of every curated view, with the view's name. The views over sales share one read of what was sold."""
    sold = materialise(views.sold_combinations(t), "sold")
    rows = {"sales_by_week": sold, "chat_weekly_sales": sold, "calendar": views.calendar(t)}
    if t.audit is not None:
        rows["data_freshness"] = views.data_freshness(t)
    parts = [known_values(rows[name], columns).select(F.lit(name).alias("view_name"), "column_name", "value")
             for name, columns in KNOWN_VALUE_COLUMNS.items() if name in rows]
    return reduce(DataFrame.unionByName, parts)
