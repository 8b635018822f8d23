"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES
(comma-separated names, or ``all``), BENCH_RUNS (warm runs, default 1; the median
counts). Every query runs once before it is timed. Results go to Spark's noop sink,
so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "traffic_window_stats", "pipe_traffic", "hour_filter",
    "lenient_cast", "pipe_weigh_prepare", "gate_required", "outlet_prepare", "outlet_analysis",
    "asof_bin_join", "asof_measure_join", "flow_class", "flow_final", "pipe_weigh_analysis",
    "history_last_n", "rate_by_flow_volume", "weight_correct", "pipe_correction",
    "scd2_producer", "scd2_bin", "pipe_dimensions", "surrogate_key",
    "dup_key_report", "dup_key_keep_one", "distinct_rows", "frame_diff",
    "measure_melt", "history_explode", "pipe_lora", "pipe_lora_replay",
    "point_in_polygon", "nearest_polygon", "pipe_spatial",
    "partition_scan", "replace_range", "sink_partition_roundtrip",
]


def main() -> None:
    from civiframe.catalog import QUERIES
    from civiframe.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = sorted(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE

    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
