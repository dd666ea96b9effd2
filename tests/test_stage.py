from pyspark.sql import functions as F
import pytest

from conftest import d, money, one_load, rows
from sellthrough import schemas as S
from sellthrough.operators import quality, totals as G
from sellthrough.operators.mapping import build_products, build_stm, map_products, rejected_by_pair, source_rows, unmapped_keys
from sellthrough.operators.upsert import merge_into_catalog, merge_source, restated_rows, upsert_weekly
from sellthrough.plans.evidence import clamp, evidence, finding_texts, reject_samples
from sellthrough.session import local_rows

W = d("2026-09-26")


@pytest.fixture(scope="module")
def landing(spark):
    lines = [("S01", "BLK", "M", 10, 5), ("S01", "BLK", "M", 12.5, 7), ("S03", "GRN", "M", 4, 2), ("S03", "GRN", "M", 6, 3)]
    return local_rows(spark, [("L1", W, "C101", "R202", "sku", None, s, c, z, money(v), i) for s, c, z, v, i in lines], S.LANDING)


def sku_stm(spark, *products):
    return local_rows(spark, [("C101", "sku", None, "S01", "BLK", "M", p) for p in products]
                      + [("C101", "style", None, "S03", None, None, "C101-S03")], S.PRODUCT_STM)


def test_rollup_mapping_totals_and_gate(spark, landing):
    source = source_rows(landing)
    assert rows(source, "style", "sales", "inventory", "source_rows") == [("S01", money(22.5), 12, 2), ("S03", money(10), 5, 2)]
    staging = map_products(source, sku_stm(spark, "C101-P001"))
    assert rows(staging, "src_product_key", "product_id") == [("S01|BLK|M", "C101-P001"), ("S03|GRN|M", None)]
    totals = G.control_totals(source, staging)
    assert rows(totals, "source", "row_count", "sales", "inventory") == [
        ("rej", 1, money(10), 5), ("src", 2, money(32.5), 17), ("stg", 1, money(22.5), 12)]
    _, loads = one_load(spark, {})
    assert tuple(G.verdicts(totals, loads).first()) == ("L1", 1, 0, 1, True)
    assert rows(unmapped_keys(staging), "src_product_key", "rows", "sales") == [("S03|GRN|M", 1, money(10))]
    assert rows(rejected_by_pair(staging), "retailer_id", "rows") == [("R202", 1)]
    assert rows(finding_texts(totals), "finding") == [("every week reconciles: src = stg + rej",)]


def test_doubled_mapping_is_found(spark, landing):
    source = source_rows(landing)
    stm = sku_stm(spark, "C101-P001", "C101-P002")
    totals = G.control_totals(source, map_products(source, stm))
    assert G.findings(totals).first().finding == (
        "2026-09-26: rows src 2 vs stg + rej 3 (1 duplicated); sales src 32.5 vs stg + rej 55.0 (22.5 duplicated); "
        "inventory src 17 vs stg + rej 29 (12 duplicated)")
    _, loads = one_load(spark, {})
    with pytest.raises(ValueError, match="src != stg"):
        G.check_reconciled(totals, loads)
    with pytest.raises(ValueError, match="no stats recorded"):
        G.check_reconciled(totals.filter("load_id = 'none'"), loads)
    assert rows(quality.stm_duplicates(stm), "style", "mappings") == [("S01", 2)]


def test_finding_of_one_week(spark):
    lines = [(w, s, n, v, i) for w, v2 in (("2026-10-03", (950, 480, 20)), ("2026-10-10", (1040, 520, 21)))
             for s, n, v, i in (("src", 21, 1000, 500), ("stg", v2[2], v2[0], v2[1]), ("rej", 1, 50, 20))]
    totals = local_rows(spark, [("L", s, d(w), "C", "R", n, money(v), i, None) for w, s, n, v, i in lines], S.ETL_STATS)
    found = G.findings(totals).collect()
    assert len(found) == 1 and found[0].finding.startswith("2026-10-10: rows src 21 vs stg + rej 22 (1 duplicated)")
    assert G.stats_by_week(totals.filter("source <> 'rej'")).first().rej_rows is None


def test_catalog_to_products_and_mapping(spark):
    catalog = spark.createDataFrame(
        [("C1", "C1-P1", "01", "S01", "BLK", "M", "Shell BLK M", "Shell", "Outdoor", 10.0), ("C1", "C1-P2", "02", "S01", "BLK", "L", "Shell BLK L", "Shell", "Outdoor", 12.0)],
        "client_id string, product_id string, serial string, style string, color string, size string, product_name string, style_name string, category string, unit_price double")
    assert rows(build_products(catalog), "product_id", "product_grain", "product_name", "unit_price") == [
        ("C1-P1", "sku", "Shell BLK M", 10.0), ("C1-P2", "sku", "Shell BLK L", 12.0), ("C1-S01", "style", "Shell", 10.0)]
    stm = build_stm(catalog)
    assert rows(stm.groupBy("product_level").count()) == [("serial", 2), ("sku", 2), ("style", 1)]
    assert quality.stm_duplicates(stm).count() == 0 and quality.stm_orphans(stm, build_products(catalog)).count() == 0


def at(day):
    return F.lit(f"2026-01-0{day}").cast("timestamp")


def test_upsert_replay_and_restated(spark):
    week = {"19": d("2026-09-19"), "26": W, "03": d("2026-10-03")}
    fact = local_rows(spark, [(week[w], c, "R201", p, money(v), i, "L0", None, None) for w, c, p, v, i in [
        ("19", "C101", "P1", 5, 1), ("26", "C101", "P1", 7, 2), ("26", "C101", "P9", 1, 1), ("26", "C102", "P1", 9, 9)]], S.FACT_SALES)
    fact = fact.withColumns({"inserted_at": at(1), "updated_at": at(1)})
    staging = local_rows(spark, [("L1", week[w], "C101", "R201", "serial", k, p, money(v), i) for w, k, p, v, i in [
        ("26", "a", "P1", 8, 3), ("26", "b", "P2", 2, 1), ("26", "c", "P2", 3, 1), ("03", "a", "P1", 4, 4), ("03", "x", None, 6, 6)]], S.STAGING)
    _, loads = one_load(spark, {}, window=("2026-09-26", "2026-10-03"))
    after, counters = upsert_weekly(fact, staging, loads, at(2), 1)
    assert rows(after, "week_date", "client_id", "product_id", "sales", "inventory", "load_id") == [
        (week["19"], "C101", "P1", money(5), 1, "L0"), (week["26"], "C101", "P1", money(8), 3, "L1"),
        (week["26"], "C101", "P2", money(5), 2, "L1"), (week["26"], "C101", "P9", money(1), 1, "L0"),
        (week["26"], "C102", "P1", money(9), 9, "L0"), (week["03"], "C101", "P1", money(4), 4, "L1")]
    assert rows(counters) == [("L1", 2, 1)]
    changed = after.filter("load_id = 'L1' AND product_id = 'P1'").orderBy("week_date").collect()
    assert changed[0].inserted_at < changed[0].updated_at and changed[1].inserted_at == changed[1].updated_at
    assert rows(restated_rows(after), "rows", "restated") == [(1, 0), (1, 0), (4, 1)]
    again, counters = upsert_weekly(after, staging, loads, at(3), 1)
    assert rows(counters) == [("L1", 0, 3)] and again.count() == 6
    narrow = merge_source(staging, one_load(spark, {}, window=("2026-10-03", "2026-10-03"))[1], 1)
    assert rows(narrow, "week_date") == [(week["03"],)]


def test_catalog_merge_needs_a_table_format_that_has_it(spark):
    spark.sql("DROP TABLE IF EXISTS plain_fact")
    spark.createDataFrame([], S.FACT_SALES).write.saveAsTable("plain_fact")
    source = spark.createDataFrame([], S.FACT_SALES).select("week_date", "client_id", "retailer_id", "product_id", "sales", "inventory", "load_id")
    with pytest.raises(Exception, match="(?i)unsupported|does not support"):
        merge_into_catalog(source, "plain_fact", at(2))
    spark.sql("DROP TABLE plain_fact")


def test_evidence_pack(spark, landing):
    source = source_rows(landing)
    staging = map_products(source, sku_stm(spark, "C101-P001"))
    rejects = local_rows(spark, [("L1", "f", "summary/total row", {"style": "TOTAL"}), ("L1", "f", "week_date is not a Saturday", {"style": "S01"})], S.REJECTS)
    audit = spark.createDataFrame([], S.LOAD_AUDIT_EVENT).drop("event_ts").unionByName(spark.createDataFrame(
        [("L1", "C101_R202", "FAILED", "{bad json")], "load_id string, pipeline_id string, status string, parse_stats string"), allowMissingColumns=True)
    config = spark.createDataFrame([("C101_R202",), ("other",)], "pipeline_id string")
    pack = evidence(audit=audit, totals=G.control_totals(source, staging), staging=staging, rejects=rejects, load_id="L1", samples=1,
                    load_files=spark.createDataFrame([], S.LOAD_FILES), config=config)
    assert rows(pack.reject_reasons, "reject_reason", "rows") == [("summary/total row", 1), ("week_date is not a Saturday", 1)]
    assert pack.reject_samples.count() == 1 and reject_samples(rejects, 99).count() == 2
    assert rows(pack.unmapped, "src_product_key") == [("S03|GRN|M",)] and rows(pack.feed) == [("C101_R202",)]
    assert pack.audit.first().parse_stats == "{bad json" and pack.files.count() == 1
    assert (clamp(0), clamp(99), clamp(7)) == (1, 20, 7)
