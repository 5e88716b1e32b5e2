"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line. Each query is forced to run to
the end with the no-op sink (full computation, nothing collected); each is run
$BENCH_RUNS times (default 2) and the fastest run is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from obsflow.plans.queries import QUERIES  # noqa: E402
from obsflow.session import get_spark  # noqa: E402

HEADLINE = [
    "clean_records", "window_aggregates", "window_aggregates_clean", "latest_by_city",
    "quality_report", "parse_messages", "normalize_payload", "feature_stats",
    "feature_deviation_by_city", "agg_table_tail", "percentile_flag", "current_conditions",
    "stream_window_sink", "detect_anomalies",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", app="obsflow-bench", shuffle_partitions=int(cpus),
                      extra_conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
                                  "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up: JVM, Python workers, Parquet footer cache (not timed)
    QUERIES["clean_records"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times = {}
    for k in keys:
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[k] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_sec_headline_queries", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus),
                      "runs": runs, "stat": "min"}))
    spark.stop()


if __name__ == "__main__":
    main()
