import pytest
from pyspark.sql import functions as F

from conftest import d
from sellthrough.operators.windows import check_windows, missing_weeks, resolve_windows

CASES = [
    ("2026-10-30", ["2026-09-26"], None, None, "2026-08-29", "2026-09-26", "automation"),
    ("2026-10-01", ["2026-09-26"], "2026-07-11", "2026-09-26", "2026-07-11", "2026-09-26", "history"),
    ("2026-10-12", ["2026-10-03", "2026-10-10"], None, None, "2026-09-05", "2026-10-10", "automation"),
    ("2026-10-01", [], None, None, "2026-08-29", "2026-09-26", "automation"),
    ("2026-10-01", [], None, "2026-09-19", "2026-08-22", "2026-09-19", "history"),
    ("2026-10-01", ["2026-09-26"], "2026-09-05", None, "2026-09-05", "2026-09-26", "history"),
]


def windows(spark, run, files, start, end):
    feeds = spark.createDataFrame([("p", 5)], "pipeline_id string, lookback_weeks int")
    waiting = spark.createDataFrame([("p", d(w)) for w in files], "pipeline_id string, file_week date")
    return resolve_windows(feeds, waiting, F.lit(run).cast("date"), *[F.lit(x) if x else None for x in (start, end)])


@pytest.mark.parametrize("run,files,start,end,first,last,kind", CASES)
def test_window(spark, run, files, start, end, first, last, kind):
    got = windows(spark, run, files, start, end).first()
    assert (got.window_start, got.window_end, got.load_type, got.window_error) == (d(first), d(last), kind, None)


@pytest.mark.parametrize("start,end,text", [("2026-09-25", "2026-09-26", "Saturdays"), ("2026-10-03", "2026-09-26", "after its last")])
def test_bad_bounds(spark, start, end, text):
    with pytest.raises(ValueError, match=text):
        check_windows(windows(spark, "2026-10-01", [], start, end))


def test_missing_weeks(spark):
    expected = spark.createDataFrame([("C", "R", d("2026-09-12"), d("2026-09-26"))], "client_id string, retailer_id string, window_start date, window_end date")
    fact = spark.createDataFrame([("C", "R", d("2026-09-19"))], "client_id string, retailer_id string, week_date date")
    assert sorted(r.week_date for r in missing_weeks(expected, fact).collect()) == [d("2026-09-12"), d("2026-09-26")]
