"""Time the headline queries and print one JSON line.

Each query is run once to warm up, then ``BENCH_RUNS`` times; the median counts.
The whole result is produced each time (written to the no-op sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from statledger.checks.queries import queries  # noqa: E402
from statledger.session import session  # noqa: E402

HEADLINE = [
    "job_bounds", "job_outliers", "job_outlier_summary", "routine_outlier_summary", "jobs_weekly", "routine_weekly",
    "routine_detail", "batch_volumes", "usage_share", "io_calendar", "io_per_day", "unchanged_tables",
    "indexes_with_scans", "tables_with_statistics", "fragmented_top_tables", "indexes_with_free_space",
    "unneeded_indexes", "unused_tables", "file_io", "packet_delta", "delivery_rate", "memory_snapshot", "table_usage",
    "routine_exec", "top_queries", "index_free_space", "alert_detail", "rebuild_worklist", "stats_worklist",
    "lock_hotspots", "routine_scripts", "file_io_continue", "enrich_candidates", "previous_event_hot_keys", "alert_run",
    "history_as_of", "stream_deltas",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered, times = queries(), {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "total_median_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
