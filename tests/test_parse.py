import pytest

from conftest import d, money, one_load, raw_rows, rows
from sellthrough import schemas as S
from sellthrough.plans.parse import check_violations, parse_feed

SERIAL = ("week_date", "client_id", "retailer_id", "product_id", "sales", "inventory")
FX1 = [
    ("09/15/2026", "C101", "R201", "770000000042", "3.30", "0", "week_date is not a Saturday"),
    ("09/19/2026", "C101", "R201", "770000000042", "12 apples", "9", "unparseable sales"),
    ("09/19/2026", "C101", "R201", "770000000042", "$20,088.40", "31", None),
    ("2026-09-26", "C101", "R201", "770000000043", "($5.25)", "1,200", None),
    ("9/26/2026", "c101", "R201", "770000000043", "1", "1", "client is not C101"),
    ("09/26/2026", "C101", "R202", "770000000043", "1", "1", "retailer is not R201"),
    ("09/26/2026", "C101", "R201", "", "1", "1", "missing product key"),
    ("09/26/2026", "C101", "R201", "770000000043", "1", "$5", "unparseable inventory"),
    ("13/45/2026", "C101", "R201", "total", "x", "y", "summary/total row"),
    ("13/45/2026", "C101", "R201", "770000000043", "1", "1", "unparseable week_date"),
    ("", "", "", "", "", " ", None),
    ("08/22/2026", "C101", "R201", "770000000043", "1", "1", None),
]


def test_rules_in_order(spark):
    files, loads = one_load(spark, {"f": "2026-09-26"})
    parsed = parse_feed(raw_rows(spark, [("f", *line[:6]) for line in FX1], SERIAL), files, loads)
    assert rows(parsed.output, "product_id", "sales", "inventory", "week_date") == [
        ("770000000042", money(20088.4), 31, d("2026-09-19")), ("770000000043", money(-5.25), 1200, d("2026-09-26"))]
    assert sorted(r.reject_reason for r in parsed.rejects.collect()) == sorted(line[6] for line in FX1 if line[6])
    stats = parsed.load_stats.first()
    assert (stats.raw_rows, stats.parse_rejects, stats.out_of_window, stats.parsed_rows) == (11, 8, 1, 2)
    assert stats.raw_rows == stats.parse_rejects + stats.out_of_window + stats.parsed_rows
    total = parsed.rejects.filter(f"reject_reason = '{S.REJECT_TOTAL}'").first()
    assert total.raw["product_id"] == "total" and total.raw["sales"] == "x"
    assert parsed.violations.count() == 0


def test_absent_ids_are_stamped_and_blank_lines_then_are_rejects(spark):
    files, loads = one_load(spark, {"f": "2026-09-26"})
    raw = raw_rows(spark, [("f", "2026-09-26", "0101", "1", "1"), ("f", "", "", "", "")], ("week_date", "product_id", "sales", "inventory"))
    parsed = parse_feed(raw, files, loads)
    assert rows(parsed.output, "client_id", "retailer_id") == [("C101", "R201")]
    assert rows(parsed.rejects, "reject_reason") == [("unparseable week_date",)]


def test_misrouted_file_fails_the_load(spark):
    files, loads = one_load(spark, {"f": "2026-09-26"})
    parsed = parse_feed(raw_rows(spark, [("f", "2026-09-26", "C102", "R201", "1", "1", "1")], SERIAL), files, loads)
    assert parsed.output.count() == 0 and parsed.rejects.first().reject_reason == "client is not C101"
    with pytest.raises(ValueError, match="no rows for the window"):
        check_violations(parsed)


def test_missing_columns_fail_the_load(spark):
    files, loads = one_load(spark, {"f": "2026-09-26"})
    parsed = parse_feed(raw_rows(spark, [("f", "2026-09-26", "C101", "R201", "1")], ("week_date", "client_id", "retailer_id", "sales")), files, loads)
    assert parsed.output.count() == 0
    assert "missing columns product_id, inventory in f" in parsed.violations.first().message


def test_rows_after_the_window_fail_the_whole_load(spark):
    files, loads = one_load(spark, {"a": "2026-09-19", "b": "2026-09-26"}, window=("2026-08-22", "2026-09-19"))
    raw = raw_rows(spark, [("a", "2026-09-19", "C101", "R201", "1", "1", "1"), ("b", "2026-09-26", "C101", "R201", "1", "1", "1"),
                           ("b", "2026-09-27", "C101", "R201", "1", "1", "1")], SERIAL)
    parsed = parse_feed(raw, files, loads)
    assert parsed.output.count() == 0
    assert parsed.violations.first().message == "1 rows are after the window end 2026-09-19 (latest week 2026-09-26) in b"


def test_sku_and_style_levels_only_judge_their_keys(spark):
    columns = ("week_date", "client_id", "retailer_id", "style", "color", "size", "sales", "inventory")
    lines = [("f", "2026-09-26", "C101", "R201", " s01 ", "blk", "m", "1", "1"), ("f", "2026-09-26", "C101", "R201", "S01", "", "M", "1", "1"),
             ("f", "", "", "", "", "TOTAL", "", "9", "9")]
    files, loads = one_load(spark, {"f": "2026-09-26"}, level="sku")
    sku = parse_feed(raw_rows(spark, lines, columns), files, loads)
    assert rows(sku.output, "style", "color", "size", "product_id") == [("S01", "BLK", "M", None)]
    assert rows(sku.rejects, "reject_reason") == [("missing product key",), ("summary/total row",)]
    files, loads = one_load(spark, {"f": "2026-09-26"}, level="style")
    style = parse_feed(raw_rows(spark, lines, columns), files, loads)
    assert rows(style.output, "style", "color") == [("S01", None), ("S01", None)]
    assert rows(style.rejects, "reject_reason") == [("unparseable week_date",)]


WEEKS = ["2026-09-05", "2026-09-12", "2026-09-19", "2026-09-26", "2026-10-03", "2026-10-10"]


def test_newest_file_wins_each_week(spark):
    lines = [("a", w, "C101", "R201", str(p), "1", "1") for w in WEEKS[:5] for p in range(21)]
    lines += [("b", w, "C101", "R201", str(p), "2", "1") for w in WEEKS[1:] for p in range(21)]
    files, loads = one_load(spark, {"a": "2026-10-03", "b": "2026-10-10", "empty": "2026-09-05"}, window=(WEEKS[0], WEEKS[-1]))
    parsed = parse_feed(raw_rows(spark, lines, SERIAL), files, loads)
    assert rows(parsed.file_stats, "source_file", "raw_rows", "rows_used", "superseded_rows") == [
        ("a", 105, 21, 84), ("b", 105, 105, 0), ("empty", 0, 0, 0)]
    assert rows(parsed.output.groupBy("week_date").agg({"sales": "max"})) == [(d(w), money(1 if w == WEEKS[0] else 2)) for w in WEEKS]
    stats = parsed.load_stats.first()
    assert (stats.files, stats.parsed_rows, stats.superseded_rows) == (3, 126, 84)


def test_whole_week_is_replaced_and_parts_are_united(spark):
    lines = [("a", "2026-09-12", "C101", "R201", p, "1", "1") for p in "PQ"] + [("b", "2026-09-12", "C101", "R201", "P", "2", "1")]
    files, loads = one_load(spark, {"a": "2026-09-12", "b": "2026-09-19"})
    raw = raw_rows(spark, lines, SERIAL)
    assert rows(parse_feed(raw, files, loads).output, "product_id", "sales") == [("P", money(2))]
    files, loads = one_load(spark, {"a": "2026-09-12", "b": "2026-09-12"})
    parts = parse_feed(raw, files, loads)
    assert parts.output.count() == 3 and rows(parts.file_stats, "superseded_rows") == [(0,), (0,)]
    files, loads = one_load(spark, {"a": "2026-09-12", "b": None})
    assert rows(parse_feed(raw, files, loads).output, "product_id") == [("P",), ("Q",)]
