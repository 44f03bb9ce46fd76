"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores  (default 8)
BENCH_RUNS    timed runs per query after one warm-up (default 3)
BENCH_QUERIES comma-separated names, or "all"
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tvtrail.session import build
from workbench.catalog import QUERIES

HEADLINE = (
    "log_parse_vod", "log_bad_time_dropped", "json_online_users", "kv_vod_parse",
    "session_pairing", "session_inferred_end", "session_day_clamp", "live_facts", "vod_facts",
    "vod_category_resolve", "appvod_dedup", "appvod_results", "active_users", "pool_merge",
    "distinct_90d", "stb_report_rollup", "path_counts", "path_top20_start", "path_in_out",
    "order_last_page", "minute_totals_cube", "flow_in_out", "flow_zero_fill",
    "sink_partition_overwrite",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = build("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
        # The tables are small; without this, reducers would merge into one task.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        taken = []
        for run in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if run:
                taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "sum of warm median query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
