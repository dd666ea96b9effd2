"""A sample of the registered queries against their SQL on the smallest tables; all of them are checked by the driver."""
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
SAMPLE = ["parse_output", "stage_all", "reconcile_findings", "upsert_result", "sales_by_week", "audit_current", "json_feed", "workbook_feed"]
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


def plain(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("customer", "orders", "lineitem", "part", "events"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = entry_module.queries()[name](spark, SF)
    columns = sorted(result.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({entry_module.oracle_sql()[name]})").fetchall()
    got = [tuple(r) for r in result.select(columns).collect()]
    assert plain(got) == plain(expected) and got


def test_entry_and_registry(spark):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).count() > 0
