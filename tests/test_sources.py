import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import d, one_load, rows
from sellthrough import sources
from sellthrough.plans.parse import parse_feed
from sellthrough.sources.files import with_file_week
from sellthrough.testbed.workbooks import HEADER, workbook_bytes


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return f"file:{path}"


def test_pending_files_in_order(spark, tmp_path):
    names = ["R_C_20260926.csv", "R_C_20260912.CSV", "R_C_20260919_part2.csv", "R_C_20260919_part1.csv", "notes.txt", "R_C_20269999.csv"]
    for name in names:
        put(tmp_path / "landing/C/R", name, "x")
    listed = sources.list_feed_files(spark, str(tmp_path / "landing"))
    config = spark.createDataFrame([("C_R", "/C/R/"), ("C_Q", "C/Q")], "pipeline_id string, source_location string")
    matched = sources.match_feeds(sources.pending_files(listed), config, str(tmp_path / "landing"))
    found = [r.source_file.rsplit("/", 1)[-1] for r in matched.orderBy("file_week", "source_file").collect()]
    assert found == [names[1], names[3], names[2], names[0]]
    assert sources.unrecognised_files(listed).count() == 2
    assert rows(sources.cap_drops(matched, 2), "file_week") == [(d("2026-09-12"),), (d("2026-09-19"),), (d("2026-09-19"),)]
    loaded = matched.filter("file_week = '2026-09-12' or source_file like '%part1.csv'").select("source_file", "length", "modified")
    assert rows(sources.whole_drops(matched, loaded), "file_week") == [(d("2026-09-19"),), (d("2026-09-19"),), (d("2026-09-26"),)]
    longer = loaded.withColumn("length", F.col("length") + 1)       # sent again since
    assert sources.whole_drops(matched, longer).count() == 4
    spark_drop = with_file_week(spark.createDataFrame([("file:/x/R_C_20260926.json/part-0001-a.txt",)], "source_file string")).first()
    assert (spark_drop.file_week, spark_drop.file_format) == (d("2026-09-26"), "json")


def test_csv_layouts_are_read_together(spark, tmp_path):
    a = put(tmp_path, "a.csv", 'Week_Date,Client,Retailer,Product_ID,Sales,Inventory\n9/19/2026,C7,R9,770000000042,"$20,088.40",31\n')
    b = put(tmp_path, "b.csv", '﻿" week_date ",retailer,client,store,style,sales,inventory\n2026-09-26,R203,C101,1,S01,12.5,3\n\n,,,,TOTAL,12.5,3\n2026-09-26,R203\n')
    c = put(tmp_path, "c.csv", "Week_Date,weekEnding,Sales\n1,2,3\n")
    raw = sources.read_csv_feed(spark, [a, b, c]).withColumn("f", F.substring_index("source_file", "/", -1))
    assert rows(raw.filter("f = 'a.csv'"), "product_id", "sales", "style") == [("770000000042", "$20,088.40", None)]
    assert rows(raw.filter("f = 'b.csv'"), "week_date", "style", "inventory") == [("", "TOTAL", "3"), ("2026-09-26", "", ""), ("2026-09-26", "S01", "3")]
    assert rows(raw.filter("f = 'c.csv'"), "layout_error") == [("two columns mean week_date",)]
    name = raw.filter("f = 'b.csv'").first().source_file
    files, loads = one_load(spark, {name: "2026-09-26"}, retailer="R203", level="style")
    parsed = parse_feed(raw.drop("f"), files, loads)
    assert rows(parsed.output, "style") == [("S01",)]
    reject = parsed.rejects.filter("reject_reason = 'summary/total row'").first()
    assert reject.raw == {"week_date": "", "retailer_id": "", "client_id": "", "store": "", "style": "TOTAL", "sales": "12.5", "inventory": "3"}


def test_json_records_keep_number_text(spark, tmp_path):
    records = [{"weekEnding": "2026-09-26", "clientId": "C102", "style": "S01", "salesAmount": 12.5, "onHandUnits": 3, "x": {"y": 1}},
               {"weekEnding": "2026-09-26", "style": None, "salesAmount": 12345678901234567890}]
    raw = sources.read_json_feed(spark, [put(tmp_path, "a.json", json.dumps(records))])
    assert rows(raw, "client_id", "style", "sales", "inventory", "retailer_id") == [
        ("", "", "12345678901234567890", "", None), ("C102", "S01", "12.5", "3", None)]
    twice = sources.read_json_feed(spark, [put(tmp_path, "b.json", '[{"sales": 1, "netSales": 2}]')])
    assert twice.first().layout_error == "two columns mean sales"


def test_api_pages(spark, tmp_path):
    def page(i, n, total=210):
        data = [{"weekEnding": "2026-09-26", "storeNumber": f"{i}-{k}", "style": "S01"} for k in range(n)]
        return put(tmp_path, f"page{i}.json", json.dumps({"data": data, "next_cursor": i + 1 if i < 4 else None, "total": total}))
    paths = [page(i, 50 if i < 4 else 10) for i in range(5)]
    pages = sources.read_api_pages(spark, paths)
    assert sources.flatten_pages(pages).count() == 210
    assert sources.incomplete_feeds(pages, F.lit("C102_R202")).count() == 0
    assert sources.incomplete_feeds(pages.filter("next_cursor IS NOT NULL"), F.lit("C102_R202")).first().records == 200
    assert sources.read_json_feed(spark, paths).count() == 210


def test_workbook(spark, tmp_path):
    line = (date(2026, 9, 26), "R202", "C101", "1", "S01", "BLK", None, 12.5, 3)
    good = put(tmp_path, "a.xlsx", workbook_bytes([("Report & title",), (), HEADER, line]))
    bad = put(tmp_path, "b.xlsx", workbook_bytes([("no header here", "at all")] * 12))
    raw = sources.read_feed_files(spark, {"xlsx": [good, bad]})
    assert rows(raw.filter("layout_error IS NULL"), "week_date", "style", "size", "sales", "inventory") == [("2026-09-26", "S01", "", "12.5", "3")]
    assert "none of the first 10 rows" in raw.filter("layout_error IS NOT NULL").first().layout_error


def test_unsupported_format(spark):
    with pytest.raises(ValueError, match="unsupported file format 'pdf'"):
        sources.read_feed_files(spark, {"pdf": ["x"]})


def test_feed_config(spark, tmp_path):
    header = "pipeline_id,client_id,retailer_id,product_level,source_type,source_location,file_format,schedule,lookback_weeks,is_active,promoted_to_prod\n"
    path = put(tmp_path, "config.csv", header + "A,C1,R1,sku,s3,x/,csv,0 7 * * *,5,true,true\nB,C1,R2,sku,s3,y/,csv,0 7 * * *,5,true,false\nC,C1,R3,sku,s3,z/,csv,0 7 * * *,5,false,true\n")
    config = sources.read_pipeline_config(spark, path)
    assert rows(sources.active_feeds(config, "dev"), "pipeline_id") == [("A",), ("B",)]
    assert rows(sources.active_feeds(config, "prod"), "pipeline_id", "lookback_weeks") == [("A", 5)]
    assert sources.feed_by_id(config, "C").first().is_active is False
