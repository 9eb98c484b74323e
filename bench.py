"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default sf0.1) and ``BENCH_CPUS`` (default 8). Each query
runs once to warm up and then ``BENCH_RUNS`` times; the best time counts. Results
are computed in full and dropped (``noop`` sink), so nothing is pruned away and
nothing travels to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tarnwork.plans import catalog  # noqa: E402
from tarnwork.session import build_session  # noqa: E402

HEADLINE = [
    "order_details",
    "daily_revenue",
    "extract_all_days",
    "dedup_latest_one",
    "dedup_latest_all",
    "snapshot_merge",
    "upsert",
    "upsert_latest_version",
    "salted_join",
    "salted_join_hot_keys",
    "psi_total",
    "bucket_counts",
    "group_shares",
    "dominant_event",
    "window_totals",
    "largest_events",
    "user_event_map",
    "ancestors",
    "ancestors_by_role",
    "unpivot_charges",
    "pivot_stats",
    "zip_nested",
    "json_props",
    "form_body",
    "checks_events",
    "call_external",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        started = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        timed(name)
        seconds[name] = round(min(timed(name) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
