"""Records of CSV files put together from lines, and rows of any width."""
import csv
import io
import random

import pytest

from conftest import rows
from test_sources import put
from sellthrough import sources
from sellthrough.sources.csv_feed import NOT_CLOSED, csv_lines, csv_shapes, record_cells, stitched_records
from sellthrough.sources.layout import is_ragged
from pyspark.sql import functions as F

HEAD = "Week_Date,Product_ID,Note,Sales\n"


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
            if spark.conf.get(k, None)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.set(key, kept[key]) if key in kept else spark.conf.unset(key)


def messy_file(r, records):
    """Text of a file, and its records as lists of cells."""
    def cell():
        kind = r.randrange(8)
        if kind < 4:
            return "".join(r.choice("ab1. ") for _ in range(r.randrange(6))).strip()
        if kind == 4:
            return r.choice(['5" pipe', 'a"b"', "x'"])                      # quotes inside a plain cell
        return "".join(r.choice(["a", "\n", ",", '"', "\n\n", '""', "b c"]) for _ in range(r.randrange(1, 6)))

    def text(c):
        plain = not any(x in c for x in ",\n") and not c.startswith('"')
        return c if plain and r.random() < 0.9 else '"' + c.replace('"', '""') + '"'

    made = [[cell() for _ in range(r.choice([4, 4, 4, 5, 9]))] for _ in range(records)]
    made = [m for m in made if any(m)]
    return "".join(",".join(map(text, m)) + r.choice(["\n", "\n", "\r\n", "\n\n"]) for m in made), made


def test_records_over_many_splits_are_those_of_a_reader_in_order(spark, tmp_path, small_splits):
    r, want = random.Random(5), {}
    for n in range(12):
        text, made = messy_file(r, 30)
        path = put(tmp_path, f"f{n}.csv", HEAD + text)
        want[path] = made
        assert [x for x in csv.reader(io.StringIO(text)) if x] == made
    lines = csv_lines(spark, list(want))
    assert lines.select("source_file", "split").distinct().count() > 60 and lines.rdd.getNumPartitions() > 12
    found = stitched_records(lines).select("source_file", "record_no", record_cells(F.col("record")).alias("cells"), "problem").collect()
    got = {}
    for row in sorted(found, key=lambda x: x.record_no):
        assert row.problem is None
        got.setdefault("file:/" + row.source_file.removeprefix("file:").lstrip("/"), []).append(row.cells)
    for path, made in want.items():
        cells = got[path]
        assert cells[0] == HEAD.strip().split(",") and cells[1:] == made


def test_shapes_tell_files_with_breaks(spark, tmp_path):
    texts = {"plain": '1,2,3\n"a, ""b""",5" x,\n', "breaks": 'a,"b\nc",d\n', "open": 'a,b\n"x,y\nz\n', "empty": ""}
    paths = [put(tmp_path, f"{k}.csv", HEAD + v) for k, v in texts.items()]
    found = csv_shapes(csv_lines(spark, paths)).select(F.regexp_extract("source_file", "([a-z]+).csv", 1).alias("f"), "widest", "has_breaks")
    assert rows(found) == [("breaks", 4, True), ("empty", 4, False), ("open", 4, True), ("plain", 4, False)]


def test_ragged_rows_of_any_width_keep_their_cells(spark, tmp_path, small_splits):
    wide = ",".join("x" for _ in range(1500))
    files = {"a": "2026-09-26,A,n,1,,,,,9\n2026-09-26,B,n,2,,,,,\n", "b": f'2026-09-26,C,"n\n""n""",3,,,,,,7\n{wide}\n2026-09-26,D\n', "c": '2026-09-26,E,"open\n,1\n2026-09-26,F,n,1\n',
             "d": f"{wide}\n2026-09-26,G,n,4\n"}
    raw = sources.read_csv_feed(spark, [put(tmp_path, f"{k}.csv", HEAD + v) for k, v in files.items()])
    raw = raw.withColumn("f", F.regexp_extract("source_file", "([a-z]).csv", 1))
    assert rows(raw.filter("f < 'c'"), "f", "product_id", "sales", is_ragged().alias("r"), F.size("raw_cells").alias("n")) == [
        ("a", "A", "1", True, 9), ("a", "B", "2", False, 4), ("b", "C", "3", True, 10), ("b", "D", "", False, 4), ("b", "x", "x", True, 1500)]
    assert rows(raw.filter("f = 'c'"), "layout_error", "product_id") == [(NOT_CLOSED, "")]
    assert rows(raw.filter("f = 'd'"), "product_id", F.size("raw_cells").alias("n")) == [("G", 4), ("x", 1500)]
    assert rows(raw.filter("product_id = 'C'"), F.get("raw_cells", F.lit(2)).alias("c")) == [('n\n"n"',)]
