"""Time the headline queries on the tables in $BENCH_SF_DIR with $BENCH_CPUS cores; prints one JSON line."""
from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sellthrough.registry import QUERIES  # noqa: E402
from sellthrough.session import build_session  # noqa: E402
from sellthrough.testbed import feeds  # noqa: E402

HEADLINE = ["prestage_rollup", "stage_all", "control_totals", "reconcile_ok", "unmapped_keys_report", "merge_source_rows",
            "upsert_result", "upsert_counts", "file_stats", "latest_week", "sales_by_week",
            "chat_weekly_sales", "calendar", "data_freshness", "fact_coverage", "sales_by_retailer_latest", "top_products",
            "period_compare_all", "known_values", "events_feed", "value_functions", "flagship_feed_to_report"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-")})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    # What the others read is written first: `store_feed` (which also pays for the JVM's start), `store_landing`, `store_fact`.
    start = time.perf_counter()
    feeds.raw_feed(spark, sf_dir)
    times = {"store_feed": round(time.perf_counter() - start, 3)}
    times |= {"store_landing": run("prestage_rollup"), "store_fact": run("latest_week")}
    times |= {name: run(name) for name in names}
    print(json.dumps({"metric": "total time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
