"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data directory (default sf0.1) and ``BENCH_CPUS`` the
local cores. Every query runs twice and all its rows are computed and dropped;
``queries`` holds the second run, ``first_run`` the first, which also pays for
code generation. ``value`` is the sum of ``queries``.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from tidemark.session import local_session, release
from tidemark.workload import QUERIES

HEADLINE = (
    "mart_contract_performance", "mart_cve_exposure", "mart_service_performance",
    "gold_detail_sales", "cdc_current_state", "cdc_stream_apply", "reconcile_mart_sales",
    "reconcile_detail_join", "identity_diff", "preview_family_margin", "metric_sales_all",
    "top_region_margin", "metric_findings_all", "parse_pages", "classify_docs", "typed_extract",
    "pii_matches", "column_profile", "gate_gold_sales", "gate_silver", "serving_snapshot",
)


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session("tidemark-bench", cpus, int(cpus), "16g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy(F.col("id") % 7).count().collect()
    first = {name: seconds(QUERIES[name], spark, sf_dir) for name in HEADLINE}
    second = {name: seconds(QUERIES[name], spark, sf_dir) for name in HEADLINE}
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(second.values()), 3),
        "unit": "sec", "queries": second, "first_run": first,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus)}))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
