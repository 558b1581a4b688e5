"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3; the median counts),
BENCH_QUERIES (comma-separated names instead of the headline list), BENCH_WORK (folder for
tables and working files, default bench-work below the current folder).
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.session import release_all  # noqa: E402
from millrace.workload import REGISTRY  # noqa: E402

HEADLINE = (
    "stg_payments",
    "fct_orders",
    "dim_customers",
    "metrics_daily",
    "dedup_last",
    "cast_types",
    "validate_orders",
    "validate_payments",
    "history_merge",
    "uniqueness_key",
    "check_suite",
    "referential_integrity",
    "test_relationships",
    "run_stats",
    "run_anomalies",
    "load_overwrite",
    "load_upsert_update",
    "unwrap_pages",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",")
    names = [n for n in names if n] or list(HEADLINE)
    work = os.path.abspath(os.environ.get("BENCH_WORK", "bench-work"))
    fresh = not os.path.exists(work)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .config("spark.checkpoint.dir", f"{work}/work")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    release_all()
    spark.stop()
    if fresh:
        shutil.rmtree(work, ignore_errors=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
