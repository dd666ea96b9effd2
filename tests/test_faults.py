"""What a load does with files that are late, many, oddly named or broken."""
import json
from datetime import date

import pytest

from conftest import d, money, rows
from test_load import HEAD, drop, warehouse
from test_sources import put
from sellthrough import schemas as S, sources
from sellthrough.operators.audit import current_audit
from sellthrough.plans.load import load_folder, waiting_files
from sellthrough.plans import reports, views
from sellthrough.session import local_rows, shared_folder
from sellthrough.sinks import Warehouse
from sellthrough.sources.files import reader_path
from sellthrough.streaming import ingest

RUN = {"run_date": date(2026, 10, 1)}


def parts(folder, n, first=0, week="2026-09-26"):
    for i in range(first, n):
        put(folder / "landing/C101/R201", f"R201_C101_{week.replace('-', '')}_part{i}.csv", HEAD + f"{week},A,10,1\n")


def test_a_drop_of_many_parts_is_one_load_and_late_parts_count(spark, tmp_path):
    wh, landing = warehouse(spark, tmp_path), str(tmp_path / "landing")
    parts(tmp_path, 23)
    assert load_folder(wh, landing, stamp="T1", **RUN)[0].passed
    assert rows(wh.read("fact_sales"), "sales") == [(money(230),)]
    assert waiting_files(wh, landing).count() == 0 and load_folder(wh, landing, stamp="T2", **RUN) == []
    parts(tmp_path, 25, 23)
    load_folder(wh, landing, stamp="T3", **RUN)
    assert rows(wh.read("fact_sales"), "sales") == [(money(250),)]


def test_stream_keeps_drops_whole_and_names_strangers(spark, tmp_path):
    wh, landing = warehouse(spark, tmp_path), str(tmp_path / "landing")
    put(tmp_path / "landing/C101/R201", "readme.txt", "x")
    parts(tmp_path, 21)
    ingest(wh, landing, str(tmp_path / "cp"), **RUN).awaitTermination()
    parts(tmp_path, 24, 21)
    ingest(wh, landing, str(tmp_path / "cp"), max_files=2, **RUN).awaitTermination()
    assert rows(wh.read("fact_sales"), "sales") == [(money(240),)]
    assert wh.read("unrecognised_files").count() == 1


def test_bad_feeds_fail_alone(spark, tmp_path):
    wh, landing = warehouse(spark, tmp_path), str(tmp_path / "landing")
    feeds = [(f"C{i}_R201", f"C{i}", "R201", "serial", "s3", f"C{i}/R201/", "csv", "", 5, True, True) for i in range(1, 7)]
    wh.replace_dimensions(pipeline_config=local_rows(spark, feeds, S.PIPELINE_CONFIG),
                          product_stm=local_rows(spark, [(f"C{i}", "serial", "A", None, None, None, f"P{i}") for i in range(1, 7)], S.PRODUCT_STM))
    drop(tmp_path, "C1", "2026-09-26", [("2026-09-26", "A", 5)])
    drop(tmp_path, "C2", "2026-09-24", [("2026-09-26", "A", 5)])                                         # a Thursday
    put(tmp_path / "landing/C3/R201", "R201_C3_20260926.xlsx", b"PK no workbook")
    drop(tmp_path, "C4", "2026-09-26", [("2026-09-26", "A", "9000000000000000")] * 2)                     # does not fit
    put(tmp_path / "landing/C5/R201", "R201_C5_20260926.json", '[{"weekEnding": "2026-09-26", "sa')
    put(tmp_path / "landing/C6/R201", "R201_C6_20260926.csv", HEAD + f'"{"x" * 10}\n')
    got = {r.load_id.split("_")[0]: r for r in load_folder(wh, landing, stamp="T", **RUN)}
    assert {k for k, r in got.items() if r.passed} == {"C1"}
    for feed, text in (("C2", "Saturdays"), ("C3", "cannot be read"), ("C4", "do not fit"), ("C5", "no JSON"), ("C6", "no rows")):
        assert text in got[feed].error, feed
    assert rows(wh.read("fact_sales"), "product_id", "sales") == [("P1", money(5))]
    assert rows(current_audit(wh.read("load_audit")), "pipeline_id", "status")[:2] == [("C1_R201", "SUCCESS"), ("C2_R201", "FAILED")]
    with pytest.raises(ValueError, match="Saturdays"):
        load_folder(wh, landing, stamp="T9", strict=True, **RUN)


def test_ragged_rows_and_quoted_line_breaks(spark, tmp_path):
    wh, landing = warehouse(spark, tmp_path), str(tmp_path / "landing")
    put(tmp_path / "landing/C101/R201", "R201_C101_20260926_part1.csv", HEAD + '2026-09-26,A,$1,234.50,5\n2026-09-26,B,2,1,\n')
    put(tmp_path / "landing/C101/R201", "R201_C101_20260926_part2.csv", 'Week_Date,Product_ID,Note,Sales,Inventory\n2026-09-26,A,"two\nlines, ""so""",3,1\n')
    assert load_folder(wh, landing, stamp="T", **RUN)[0].passed
    assert rows(wh.read("fact_sales"), "product_id", "sales") == [("C101-A", money(3)), ("C101-B", money(2))]
    reject = wh.read("parse_rejects").first()
    assert reject.reject_reason == S.REJECT_RAGGED and reject.raw == {"week_date": "2026-09-26", "product_id": "A", "sales": "$1", "inventory": "234.50", "_5": "5"}


def test_missing_api_pages_are_a_fault(spark, tmp_path):
    def page(n, cursor, total):
        return json.dumps({"data": [{"weekEnding": "2026-09-26", "style": str(i)} for i in range(n)], "next_cursor": cursor, "total": total})

    whole = [put(tmp_path, f"R_A_20260926_part{i}.json", page(2, c, 4)) for i, c in ((1, 2), (2, None))]
    torn = [put(tmp_path, "R_B_20260926_part1.json", page(1, 1, 2))]
    raw = sources.read_json_feed(spark, whole + torn)
    assert rows(raw, "layout_error") == [(None,)] * 4 + [("pages are missing: 1 records of 2",)]


def test_paths_with_blanks_and_signs(spark, tmp_path):
    assert reader_path("file:/a%20b/c+[1]") == r"file:/a b/c+\[1\]"
    wh = warehouse(spark, tmp_path)
    feeds = [("C101_R201", "C101", "R201", "serial", "s3", "my feed+1/R201", "csv", "", 5, True, True)]
    wh.replace_dimensions(pipeline_config=local_rows(spark, feeds, S.PIPELINE_CONFIG))
    put(tmp_path / "landing/my feed+1/R201", "R201_C101_20260926.csv", HEAD + "2026-09-26,A,4,1\n")
    assert load_folder(wh, str(tmp_path / "landing"), stamp="T", **RUN)[0].passed
    assert rows(wh.read("fact_sales"), "sales") == [(money(4),)]


def test_reports_read_the_weeks_they_show(spark, tmp_path):
    fact = [(d(f"2026-0{m}-0{day}"), "C1", "R1", "P1", money(m), 1, "L", None, None) for m, day in ((7, 4), (8, 1), (9, 5))]
    path = str(tmp_path / "fact")
    local_rows(spark, fact, S.FACT_SALES).write.partitionBy("week_date").parquet(path)
    names = [local_rows(spark, [("C1", "Brand", "Cat")], S.CLIENT), local_rows(spark, [("R1", "Shop")], S.RETAILER),
             local_rows(spark, [("P1", "C1", "sku", "s", None, None, "Name", "Cat", None)], S.PRODUCT)]
    t = views.Tables(spark.read.schema(S.FACT_SALES).parquet(path), *names)
    found = reports.sales_by_retailer_latest(t)
    assert rows(found) == [("Shop", money(9))]
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(week_date" in plan or "(week_date#" in plan.split("PartitionFilters")[1][:200] and "2026-09-05" in plan
    empty = views.Tables(t.fact.limit(0), *names)
    assert rows(reports.sales_by_retailer_latest(empty)) == [] == rows(reports.out_of_stock(empty))
    assert shared_folder(spark)


@pytest.mark.parametrize("method", ["stage", "commit", "replace_batch"])
def test_a_load_that_breaks_off_leaves_the_fact_whole_and_is_finished_by_its_repeat(spark, tmp_path, monkeypatch, method):
    wh, landing = warehouse(spark, tmp_path), str(tmp_path / "landing")
    drop(tmp_path, "C101", "2026-09-26", [("2026-09-26", "A", 1), ("2026-09-19", "A", 1)])
    load_folder(wh, landing, stamp="T1", **RUN)
    before = rows(wh.read("fact_sales"))
    drop(tmp_path, "C102", "2026-09-26", [("2026-09-26", "A", 2), ("2026-09-19", "B", 3)])
    whole = getattr(Warehouse, method)

    def breaks(self, table, *args):
        if table in ("fact_sales", "loaded_files"):
            if method == "stage":                             # a part of the new weeks is written
                whole(self, table, args[0].filter("week_date = '2026-09-19'"))
            raise OSError("gone")
        return whole(self, table, *args)

    monkeypatch.setattr(Warehouse, method, breaks)
    with pytest.raises(OSError):
        load_folder(wh, landing, stamp="T2", **RUN)
    monkeypatch.undo()
    assert method == "replace_batch" or rows(wh.read("fact_sales")) == before
    again = load_folder(wh, landing, stamp="T2", **RUN)
    assert [(r.load_id, r.passed, r.fact_inserted, r.fact_updated) for r in again] == [("C102_R201_T2", True, 2, 0)]
    assert rows(wh.read("fact_sales"), "client_id", "week_date", "sales", "file_week") == [
        ("C101", d("2026-09-19"), money(1), d("2026-09-26")), ("C101", d("2026-09-26"), money(1), d("2026-09-26")),
        ("C102", d("2026-09-19"), money(3), d("2026-09-26")), ("C102", d("2026-09-26"), money(2), d("2026-09-26"))]
    assert load_folder(wh, landing, stamp="T3", **RUN) == []
    table = wh.versions("fact_sales")
    assert table.current().version == 2 and table.expire(keep=1) == 1 + (method != "replace_batch") and wh.read("fact_sales").count() == 4


def test_an_index_of_versions_has_one_writer(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"), fact_partitions=("week_date", "client_id"))
    fact = local_rows(spark, [(d("2026-09-26"), c, "R 1", "P1", money(1), 1, "L", None, None, None) for c in ("C/1", "C 2")], S.FACT_STORED)
    wh.replace("fact_sales", fact)
    wh.replace("fact_sales", fact.filter("client_id = 'C/1'").withColumn("inventory", fact.inventory + 1))
    assert rows(wh.read("fact_sales"), "client_id", "inventory") == [("C 2", 1), ("C/1", 2)]
    table = wh.versions("fact_sales")
    old = table.current()
    wh.replace("fact_sales", fact)
    table.current = lambda: old
    with pytest.raises(RuntimeError, match="another writer"):
        table.commit(wh.stage("fact_sales", fact), 2)
    assert wh.committed("fact_sales", "never", "") is None


def test_files_sent_again_are_loaded_and_archived_parts_come_along(spark, tmp_path):
    wh, landing, archive = warehouse(spark, tmp_path), str(tmp_path / "landing"), str(tmp_path / "old files")
    parts(tmp_path, 2)
    load_folder(wh, landing, stamp="T1", **RUN)
    put(tmp_path / "landing/C101/R201", "R201_C101_20260926_part1.csv", HEAD + "2026-09-26,A,200,1\n")
    assert waiting_files(wh, landing).count() == 1
    load_folder(wh, landing, stamp="T2", archive_folder=archive, **RUN)
    assert rows(wh.read("fact_sales"), "sales") == [(money(210),)] and waiting_files(wh, landing).count() == 0
    assert len(list((tmp_path / "old files").rglob("*.csv"))) == 2 and not list((tmp_path / "landing").rglob("*.csv"))
    parts(tmp_path, 3, 2)                                                          # a late part
    load_folder(wh, landing, stamp="T3", archive_folder=archive, **RUN)
    assert rows(wh.read("fact_sales"), "sales") == [(money(220),)]
    parts(tmp_path, 1)                                                             # the first part again, as it was
    put(tmp_path / "landing/C101/R201", "R201_C101_20260926_part0.csv", HEAD + "2026-09-26,A,1,1\n")
    load_folder(wh, landing, stamp="T4", archive_folder=archive, **RUN)
    assert rows(wh.read("fact_sales"), "sales") == [(money(211),)]


def test_drops_in_any_order(spark, tmp_path):
    weeks = {"2026-09-12": [("2026-09-05", "A", 1), ("2026-09-12", "A", 1), ("2026-09-12", "B", 1)],
             "2026-09-19": [("2026-09-12", "A", 2), ("2026-09-19", "A", 2)], "2026-09-26": [("2026-09-19", "A", 3), ("2026-09-26", "B", 3)]}
    found = []
    for turn, order in enumerate((sorted(weeks), sorted(weeks, reverse=True), ["2026-09-19", "2026-09-26", "2026-09-12"])):
        wh = warehouse(spark, tmp_path / str(turn), order_guard=True)
        for n, week in enumerate(order):
            drop(tmp_path / str(turn), "C101", week, weeks[week])
            load_folder(wh, str(tmp_path / str(turn) / "landing"), stamp=f"T{n}", run_date=date(2026, 10, 1), start_week=date(2026, 8, 1), end_week=date(2026, 9, 26))
        found.append(rows(wh.read("fact_sales"), "week_date", "product_id", "sales", "file_week"))
    assert found[0] == found[1] == found[2] and len(found[0]) == 5


def test_stream_hands_out_its_backlog_in_turns(spark, tmp_path):
    wh, landing = warehouse(spark, tmp_path), str(tmp_path / "landing")
    for week in ("2026-09-12", "2026-09-19", "2026-09-26"):
        drop(tmp_path, "C101", week, [("2026-09-12", "A", int(week[-2:]))])
    drop(tmp_path, "C102", "2026-09-26", [("2026-09-26", "A", 1)])
    ingest(wh, landing, str(tmp_path / "cp"), max_drops=2, **RUN).awaitTermination()
    assert rows(wh.read("backlog"), "file_week", "turn") == [(d("2026-09-12"), 0), (d("2026-09-19"), 0), (d("2026-09-26"), 0), (d("2026-09-26"), 1)]
    assert rows(wh.read("fact_sales"), "client_id", "sales") == [("C101", money(26)), ("C102", money(1))]
    assert rows(wh.read("load_files"), "load_id")[-1] == ("C102_R201_stream00000000",) and wh.read("load_files").count() == 4
    put(tmp_path / "landing/C102/R201", "R201_C102_20260926.csv", HEAD + "2026-09-26,A,1000,1\n")     # again, under its name
    put(tmp_path / "landing/C101/R201", "R201_C101_20260926_part2.csv", HEAD + "2026-09-26,A,5,1\n")
    ingest(wh, landing, str(tmp_path / "cp"), max_drops=2, **RUN).awaitTermination()
    assert rows(wh.read("fact_sales"), "client_id", "week_date", "sales") == [
        ("C101", d("2026-09-12"), money(26)), ("C101", d("2026-09-26"), money(5)), ("C102", d("2026-09-26"), money(1000))]
