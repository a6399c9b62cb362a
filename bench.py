"""Seconds per query (median of three runs) at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from leadlake.plans.registry import QUERIES
from leadlake.session import build_session

# One query per kind of work; names on the command line replace the list.
HEADLINE = (
    "scan_leads", "bronze_parse", "silver_leads", "silver_stream", "gold_scores", "score_distribution", "intent_share",
    "top_leads", "dq_suite", "dq_lineitem", "idr_exact_email_groups", "idr_domain_pairs", "idr_company_pairs",
    "idr_match_log", "connected_components", "golden_records", "insights_fallback", "outbox", "warehouse_prepare",
    "stream_bronze", "stream_silver",
)

# Runs of a query; the median counts.
REPEATS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["score_distribution"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM
    QUERIES["idr_domain_pairs"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # and Python workers
    seconds = {}
    for name in names:
        runs = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(median(runs), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
