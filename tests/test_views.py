from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import d, money, rows
from sellthrough import schemas as S
from sellthrough.operators import coverage
from sellthrough.plans import reports, views
from sellthrough.session import local_rows, materialise


@pytest.fixture(scope="module")
def t(spark):
    facts = [("2026-09-05", "C1", "R1", "P1", 100, 4), ("2026-09-12", "C1", "R1", "P1", 150, 4), ("2026-09-26", "C1", "R1", "P1", 100, 0),
             ("2026-09-26", "C1", "R1", "P2", 20, 2), ("2026-10-03", "C2", "R1", "P3", 7, 1), ("2026-10-03", "C2", "R1", "none", 7, 1)]
    fact = local_rows(spark, [(d(w), c, r, p, money(v), i, "L", None, None) for w, c, r, p, v, i in facts], S.FACT_SALES)
    product = local_rows(spark, [(p, c, "sku", "S", "BLK", "M", f"Name {p}", c + " cat", Decimal("1.00")) for p, c in (("P1", "C1"), ("P2", "C1"), ("P3", "C2"))], S.PRODUCT)
    audit = spark.sql("SELECT 'C1_R1' pipeline_id, 'FAILED' status, TIMESTAMP '2026-10-01' finished_at UNION ALL SELECT 'C2_R1', 'SUCCESS', TIMESTAMP '2026-10-02' UNION ALL SELECT 'C2_R1', 'SUCCESS', TIMESTAMP '2026-10-03'")
    config = spark.createDataFrame([("C1_R1", "C1", "R1"), ("C2_R1", "C2", "R1")], "pipeline_id string, client_id string, retailer_id string")
    return views.Tables(fact, local_rows(spark, [("C1", "One", "c"), ("C2", "Two", "c")], S.CLIENT), local_rows(spark, [("R1", "Shop")], S.RETAILER), product, config, audit)


def test_sales_by_week(t):
    got = rows(views.sales_by_week(t).filter("brand = 'One'"), "week_ending", "weeks_ago", "sales_usd", "prev_week_sales_usd", "wow_change_pct", "products_out_of_stock")
    assert got == [(d("2026-09-05"), 4, money(100), None, None, 0), (d("2026-09-12"), 3, money(150), money(100), 50.0, 0),
                   (d("2026-09-26"), 1, money(120), money(150), -20.0, 1)]


def test_facts_without_dimension_are_left_out(t):
    assert views.weekly_sales(t).count() == 5 and views.chat_weekly_sales(t).count() == 5


def test_freshness_and_coverage(t):
    fresh = {r.brand: r for r in views.data_freshness(t).collect()}
    assert (fresh["One"].first_week_loaded, fresh["One"].latest_week_loaded, fresh["One"].weeks_loaded, fresh["One"].last_successful_load_at) == (
        d("2026-09-05"), d("2026-09-26"), 3, None)
    assert fresh["Two"].last_successful_load_at.day == 3
    assert rows(views.fact_coverage(t), "client_name", "weeks", "products", "sales") == [("One", 3, 2, money(370)), ("Two", 1, 1, money(7))]


def test_calendar(t):
    assert rows(views.calendar(t), "week_ending", "week_starting", "quarter", "month_name", "weeks_ago")[-1] == (
        d("2026-10-03"), d("2026-09-27"), 4, "Oct 2026", 0)


def test_kept_sums_and_products_answer_without_the_fact(spark, t):
    weeks, products = coverage.week_sums(t.fact), coverage.pair_products(t.fact)
    kept = replace(t, weeks=materialise(weeks, "w"), products_sold=materialise(products, "p"))
    blind = replace(kept, fact=t.fact.limit(0))
    for view in (views.calendar, views.data_freshness):
        assert rows(view(blind)) == rows(view(t))
    assert rows(views.fact_coverage(kept)) == rows(views.fact_coverage(t))                  # one product is in no dimension
    assert rows(reports.all_known_values(blind)) == rows(reports.all_known_values(t))
    whole = replace(blind, product=t.product.union(local_rows(spark, [("none", "C2", "sku", "S", None, None, "None", "C2 cat", None)], S.PRODUCT)))
    assert rows(views.fact_coverage(whole), "client_name", "products", "sales") == [("One", 2, money(370)), ("Two", 2, money(14))]
    assert views.latest_week(kept.weeks).first().latest_week == d("2026-10-03")


def test_reports(t):
    assert rows(reports.sales_by_retailer_latest(t)) == [("Shop", money(7))]
    assert rows(reports.period_compare(t, "One", "Shop")) == [(money(270), money(100))]
    assert rows(reports.period_compare(t, "Two", "Shop")) == [(money(7), None)]
    assert [tuple(r) for r in reports.top_products(t, "One").collect()] == [("Name P1", "Shop", money(250)), ("Name P2", "Shop", money(20))]
    assert rows(reports.out_of_stock(t)) == []
    assert [tuple(r) for r in reports.sales_by_month(t, "One").collect()] == [("Sep 2026", money(370))]
    assert [r.brand for r in reports.freshness_for_retailer(t, "Shop").collect()] == ["One", "Two"]
    assert rows(reports.known_values(views.sales_by_week(t), ("brand", "retailer"), 1)) == [("brand", "One"), ("retailer", "Shop")]


def test_cap_and_export(spark, t):
    assert reports.capped(spark.range(1000)).count() == 500 and reports.capped(spark.range(1000), 9999).count() == 500
    assert reports.capped(spark.range(1000), 3).count() == 3
    row = reports.for_export(t.fact.withColumn("ts", F.lit("2026-01-01 10:00:00.5").cast("timestamp")).filter("product_id = 'P3'")).first()
    assert (row.week_date, row.sales, row.ts) == ("2026-10-03", 7.0, "2026-01-01T10:00:00.500000")


def test_registered_views(spark, t):
    views.register_views(spark, t)
    assert spark.sql("SELECT sum(sales_usd) s FROM sales_by_week WHERE weeks_ago = 0").first().s == money(7)


def test_latest_week_is_the_only_forced_broadcast(t):
    plan = views.sales_by_week(t)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 1
