"""Time the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_REPEAT (default 2,
the best run of each query is reported; the JVM warm-up is not timed).
Each query is executed in full with the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "edits_clean",
    "hourly_activity",
    "editor_ranking",
    "page_ranking",
    "editor_profile",
    "page_profile",
    "rule_drop_report",
    "feed_capture_events",
    "landed_stream",
    "layer_table_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))

    from editflow.plans.queries import QUERIES
    from editflow.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus))
    # Warm-up (JVM start, class loading, code generation) is not timed.
    QUERIES["edits_clean"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - t0
            best = elapsed if best is None else min(best, elapsed)
        timings[name] = round(best, 3)
    spark.stop()

    match = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(match.group(1)) if match else sf_dir,
                "cpus": int(cpus),
                "repeat": repeat,
            }
        )
    )


if __name__ == "__main__":
    main()
