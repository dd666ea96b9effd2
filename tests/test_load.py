from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import d, money, rows
from test_sources import put
from sellthrough import schemas as S
from sellthrough.operators.audit import current_audit, decode_stats, load_health
from sellthrough.plans.load import load_folder, waiting_files
from sellthrough.session import local_rows
from sellthrough.sinks import Warehouse
from sellthrough.streaming import ingest

HEAD = "Week_Date,Product_ID,Sales,Inventory\n"


def warehouse(spark, folder, **kw):
    wh = Warehouse(spark, str(folder / "wh"), **kw)
    feeds = [(f"{c}_R201", c, "R201", "serial", "s3", f"{c}/R201/", "csv", "", 5, True, True) for c in ("C101", "C102")]
    stm = [(c, "serial", p, None, None, None, f"{c}-{p}") for c in ("C101", "C102") for p in ("A", "B")]
    wh.replace_dimensions(pipeline_config=local_rows(spark, feeds, S.PIPELINE_CONFIG), product_stm=local_rows(spark, stm, S.PRODUCT_STM))
    return wh


def drop(folder, client, week, lines):
    return put(folder / f"landing/{client}/R201", f"R201_{client}_{week.replace('-', '')}.csv", HEAD + "".join(f"{w},{p},{s},1\n" for w, p, s in lines))


def test_batch_of_feeds_with_one_bad_load_then_restatement(spark, tmp_path):
    wh = warehouse(spark, tmp_path, fact_partitions=("week_date", "client_id"))
    landing = str(tmp_path / "landing")
    drop(tmp_path, "C101", "2026-09-26", [("2026-09-19", "A", 1), ("2026-09-26", "A", 2), ("2026-09-26", "Z", 9)])
    drop(tmp_path, "C102", "2026-09-26", [("2026-10-03", "A", 1)])
    assert waiting_files(wh, landing).count() == 2
    good, bad = load_folder(wh, landing, stamp="T1", run_date=date(2026, 10, 1))
    assert (good.load_id, good.passed, good.fact_inserted, good.fact_updated) == ("C101_R201_T1", True, 2, 0)
    assert not bad.passed and "after the window end" in bad.error
    assert rows(wh.read("fact_sales"), "client_id", "week_date", "sales") == [("C101", d("2026-09-19"), money(1)), ("C101", d("2026-09-26"), money(2))]
    assert rows(wh.read("unmapped"), "src_product_key", "sales") == [("Z", money(9))]
    audit = current_audit(wh.read("load_audit"))
    assert rows(audit, "load_id", "status", "fact_inserted") == [("C101_R201_T1", "SUCCESS", 2), ("C102_R201_T1", "FAILED", None)]
    assert decode_stats(audit).filter("status = 'SUCCESS'").first().stats.raw_rows == 3
    assert load_health(audit, wh.read("etl_stats")).filter("status = 'SUCCESS'").first().rej_rows == 1
    assert wh.read("load_files").count() == 2

    again = load_folder(wh, landing, stamp="T1", run_date=date(2026, 10, 1))[0]       # replay: same load, nothing new
    assert rows(wh.read("fact_weeks"), "week_date", "rows", "sales") == [(d("2026-09-19"), 1, money(1)), (d("2026-09-26"), 1, money(2))]
    assert rows(wh.read("fact_products"), "client_id", "product_id") == [("C101", "C101-A")]
    assert (again.fact_inserted, again.fact_updated) == (2, 0) and wh.read("fact_sales").filter("updated_at > inserted_at").isEmpty()
    with pytest.raises(ValueError, match="after the window end"):
        load_folder(wh, landing, stamp="T2", run_date=date(2026, 10, 1), strict=True)
    assert load_folder(wh, landing, stamp="T3", run_date=date(2026, 10, 1), pipeline_id="none") == []
    with pytest.raises(ValueError, match="Saturdays"):
        load_folder(wh, landing, stamp="T4", run_date=date(2026, 10, 1), start_week=date(2026, 9, 25))

    # A doubled mapping fails the gate and leaves the fact alone.
    before = rows(wh.read("fact_sales"))
    stm = wh.read("product_stm")
    doubled = local_rows(spark, [("C101", "serial", "A", None, None, None, "C101-B")] + [tuple(r) for r in stm.collect()], S.PRODUCT_STM)
    wh.replace_dimensions(product_stm=doubled)
    failed = load_folder(wh, landing, stamp="T5", run_date=date(2026, 10, 1), pipeline_id="C101_R201", again=True)[0]
    assert not failed.passed and failed.error == "src != stg + rej in 2 of 2 weeks" and rows(wh.read("fact_sales")) == before


def test_stream_takes_new_files_and_archives_them(spark, tmp_path):
    wh = warehouse(spark, tmp_path)
    landing, archive, checkpoint = (str(tmp_path / x) for x in ("landing", "archive", "cp"))

    def run():
        ingest(wh, landing, checkpoint, run_date=date(2026, 10, 1), archive_folder=archive).awaitTermination()

    drop(tmp_path, "C101", "2026-09-19", [("2026-09-12", "A", 1), ("2026-09-19", "A", 2), ("2026-08-01", "A", 7)])
    run()
    assert rows(wh.read("fact_sales"), "week_date", "sales") == [(d("2026-09-12"), money(1)), (d("2026-09-19"), money(2))]
    assert wh.read("load_files").first().out_of_window == 1
    drop(tmp_path, "C101", "2026-09-26", [("2026-09-19", "A", 5), ("2026-09-26", "B", 6)])
    run()
    run()       # nothing new: no batch
    assert rows(wh.read("fact_sales"), "week_date", "sales", (F.col("updated_at") > F.col("inserted_at")).alias("r")) == [
        (d("2026-09-12"), money(1), False), (d("2026-09-19"), money(5), True), (d("2026-09-26"), money(6), False)]
    assert wh.read("load_files").count() == 2
    assert list((tmp_path / "archive").rglob("R201_C101_20260919.csv"))
