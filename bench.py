"""Times the headline queries, warm, and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark.session import local_session
from workload import eventtime, grouping, inputs, shaping, streams  # noqa: F401
from workload.registry import QUERIES

HEADLINE = [
    "hot_items",
    "hot_pages",
    "page_views",
    "unique_visitors",
    "unique_visitors_bitmap",
    "channel_counts",
    "session_windows",
    "late_rows",
    "login_failures",
    "login_bursts",
    "payment_timeouts",
    "interval_pairs",
    "reconcile_payments",
    "temperature_jumps",
    "temperature_rises",
    "rolling_averages",
    "running_max_row",
    "rolling_count",
    "rank_with_ties",
    "category_sessions",
    "hot_products_by_region",
    "star_join",
    "word_count",
    "change_sync",
    "source_access_log",
    "stream_hot_items",
    "stream_running_count",
]


def measure(spark, name: str, folder: str, runs: int) -> float:
    """Median of the runs after one that warms up; rows are produced in full but not collected."""
    times = []
    for _ in range(runs + 1):
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - began)
    return round(statistics.median(times[1:]), 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, "bench", **{"spark.sql.shuffle.partitions": cores if cores.isdigit() else "8"})
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[1:] or HEADLINE
    times = {name: measure(spark, name, folder, runs) for name in names}
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
