"""Wall-clock of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES``
(comma-separated) other queries, ``BENCH_REPEATS`` the warm runs whose median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from fleetlake.session import local_session
from fleetlake.suite import QUERIES

HEADLINE = [
    "trip_summary",
    "trip_windows",
    "trip_rows",
    "trip_avg",
    "trip_median",
    "trip_delta_sum",
    "event_edges",
    "event_table",
    "event_gps",
    "resample_grid",
    "grid_join",
    "delta_distance",
    "geofence",
    "geofence_many",
    "message_select_all_present",
    "backlog_batches",
    "decode_frames",
    "stream_edges",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    # Every column of every row is computed, none is shipped to the driver.
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeats)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total warm median wall-clock of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
