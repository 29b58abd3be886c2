"""Benchmark: run the headline queries on local[$BENCH_CPUS] over the tables
in $BENCH_SF_DIR and print one JSON line.

Each query is executed to completion through the ``noop`` sink (all rows are
computed, none is shipped to the driver). One warm-up run of the flagship
query precedes the timed runs; each query's time is the median of
$BENCH_RUNS runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "perf_rolling",
    "product_country_status",
    "inventory_view",
    "best_sellers_view",
    "price_benchmark_summary",
    "benchmark_breakdown",
    "price_suggestion",
    "best_sellers_overview",
    "best_sellers_details",
    "incremental_inventory",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]

    from shelfwise import catalog
    from shelfwise.session import local_session

    # shuffle partitions default to the core count (AQE coalesces further)
    default_shuffle = cpus if cpus.isdigit() else "8"
    spark = local_session(cores=cpus,
                          shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", default_shuffle)),
                          app="shelfwise-bench")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("inventory_view")  # warm-up: JIT, file listing, broadcast checks
    timings = {}
    for name in names:
        timings[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
