"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed runs per
query (the median counts, after one untimed run).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from rostersync.catalogue.queries import REGISTRY  # noqa: E402
from rostersync.session import build_session  # noqa: E402

HEADLINE = (
    "single_valued_directory",
    "worker_base",
    "inherit_department",
    "lookup_group",
    "classify_legacy_rules",
    "classify_current_rules",
    "latest_with_ties_accounts",
    "rank_latest_orders",
    "global_dense_rank_auto",
    "global_dense_rank_range",
    "reconcile_pairwise",
    "reconcile_set",
    "previous_groups",
    "current_groups",
    "mart_of_changes",
    "assignment_run",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", master=f"local[{cpus}]", shuffle_partitions=cpus, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        # Building a query may already write staged relations, so it is timed too.
        REGISTRY[name][0](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(sf_dir).name.removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
