"""Time the headline queries once warm and print one JSON line.

Each query runs once to warm up, then three times; the median is reported.
``BENCH_SF_DIR`` names the table folder and ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidewarden.plans.registry import QUERIES
from tidewarden.session import local_session

HEADLINE = [
    "raw_zscore_daily",
    "raw_zscore_two_step",
    "enriched_zscore_daily",
    "correlate_daily",
    "correlation_members_daily",
    "rule_error",
    "rule_latency",
    "anomaly_union",
    "metric_points",
    "metric_rollup_hourly",
    "metric_rollup_daily",
    "metric_rollup_orders",
    "event_search",
    "event_matches",
    "storage_summary",
    "latest_event",
    "normalize_log",
    "wire_json_roundtrip",
    "alerts_from_insights",
    "alert_status_updates",
    "alerts_by_source_top10",
    "alerts_hourly",
    "alerts_statistics",
    "dashboard_summary",
    "stream_raw_zscore",
]
REPEATS = 3


def timed(spark, name: str, folder: str) -> float:
    began = time.perf_counter()
    frame = QUERIES[name](spark, folder)
    frame.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    times = {}
    for name in wanted:
        repeats = 1 if name.startswith("stream_") else REPEATS
        timed(spark, name, folder)
        times[name] = round(statistics.median(timed(spark, name, folder) for _ in range(repeats)), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "spark": spark.version,
                "cores": cpus,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
