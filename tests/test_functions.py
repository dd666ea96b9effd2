import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import d
from sellthrough import functions as fn


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expression(F.col("v")).alias("x")).orderBy("i").collect()]


DATES = {"2026-09-26": "2026-09-26", "9/26/2026": "2026-09-26", "09/26/2026": "2026-09-26", "9/5/2026": "2026-09-05",
         "2026-9-5": "2026-09-05", "13/45/2026": None, "": None, "n/a": None, "2026-02-30": None, "26-01-01": None,
         "1500-01-01": None, "9999-12-25": None, "2026/09/26": None, "09-26-2026": None}


def test_dates(spark):
    assert column(spark, DATES, fn.parse_date) == [d(x) for x in DATES.values()]


def test_money_agrees_with_pandas(spark):
    texts = ["$1,234.50", "($5.25)", "($1,234.50)", "1e3", ".5", "5.", "+5", "-5", "", "-", "--5", "1_000", "0x10", "nan", "1d", "1f",
             "1e400", "abc", "( 7 )", "1 000", " 5 ", "$", "()", "(-5)", "12.345"]
    cleaned = pd.Series(texts).str.replace(r"[$,\s]", "", regex=True).str.replace(r"^\((.*)\)$", r"-\1", regex=True)
    expected = [None if pd.isna(x) or abs(x) == float("inf") else x for x in pd.to_numeric(cleaned, errors="coerce")]
    assert column(spark, texts, fn.parse_money) == expected


def test_infinity_and_oversize_are_unreadable(spark):
    assert column(spark, ["inf", "1e17", "-1e16"], fn.parse_money) == [None, None, None]


def test_count_takes_no_currency(spark):
    assert column(spark, ["1,200", "$5", "2.5", "", "1 0"], fn.parse_count) == [1200.0, None, 2.5, None, None]


def test_rounding_is_half_even_on_doubles(spark):
    values = [0.125, 1.005, 2.675, 1.015, -0.125, 12.34]
    expected = [str(x) for x in pd.Series(values).round(2)]
    assert [str(float(x)) for x in column(spark, values, fn.round_money, "double")] == expected
    assert column(spark, [22.5, 23.5, -0.5], fn.round_count, "double") == [22, 24, 0]


def test_strip_is_unicode_aware(spark):
    texts = ["\t a b  ", "　x\x1f", "", "  "]
    assert column(spark, texts, fn.strip_text) == [t.strip() for t in texts]


def test_headers(spark):
    names = {"Week_Date": "week_date", " week_date ": "week_date", "weekEnding": "week_date", "Sales $": "sales",
             "Inventory Units": "inventory", "vendor": "client_id", "Product_ID": "product_id", "Store #": "store", "Été": "été"}
    assert [fn.standard_header(n) for n in names] == list(names.values())
    assert column(spark, names, fn.standard_name) == list(names.values())


@pytest.mark.parametrize("day,end,last", [("2026-09-21", "2026-09-26", "2026-09-19"), ("2026-09-26", "2026-09-26", "2026-09-19"),
                                          ("2026-09-27", "2026-10-03", "2026-09-26"), ("2026-10-01", "2026-10-03", "2026-09-26")])
def test_weeks(spark, day, end, last):
    c = F.lit(day).cast("date")
    row = spark.range(1).select(fn.week_ending(c).alias("e"), fn.last_completed_week(c).alias("l"),
                                fn.is_week_end(c).alias("s"), fn.month_name(c).alias("m"),
                                fn.weeks_ago(c, F.date_add(c, 20)).alias("a")).first()
    assert (row.e, row.l, row.s, row.a) == (d(end), d(last), day == end, 2)
    assert row.m == "Sep 2026" or row.m == "Oct 2026"


def test_week_range(spark):
    def week(x):
        return F.lit(x).cast("date")
    got = spark.range(1).select(fn.week_range(week("2026-09-12"), week("2026-09-26")).alias("w"),
                                fn.week_range(week("2026-09-11"), week("2026-09-26")).alias("bad")).first()
    assert got.w == [d("2026-09-12"), d("2026-09-19"), d("2026-09-26")] and got.bad is None
    with pytest.raises(Exception, match="must be Saturdays in order"):
        spark.range(1).select(fn.checked_week_range(week("2026-10-03"), week("2026-09-26"))).collect()


def test_money_text_and_label(spark):
    assert column(spark, [32.5, 55.0, 12.34], fn.money_text, "double") == ["32.5", "55.0", "12.34"]
    files = spark.createDataFrame([("a/1.csv", 1), ("a/2.csv", 2), ("b/3.csv", 3)], "p string, o int")
    label = fn.file_label(F.col("o"), F.col("p"))
    assert files.agg(label).first()[0] == "3 files: a/1.csv .. 3.csv"
    assert files.filter("o = 2").agg(label).first()[0] == "a/2.csv"
    assert files.filter("o = 9").agg(label).first()[0] is None
