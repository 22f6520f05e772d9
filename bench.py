"""Benchmark the headline queries.

Runs each query end to end from the driver tables in $BENCH_SF_DIR (default
/root/testdata/sf0.1) on local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed with the ``noop`` sink (full computation, nothing
collected to the driver); the reported time is the median of $BENCH_RUNS warm
runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_orders",
    "clean_products",
    "clean_customers",
    "dim_product",
    "fact_sales",
    "top_countries_by_customers",
    "revenue_by_country",
    "price_vs_volume",
    "top_price_drops",
    "dq_results_orders",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    from tillroll.plans import catalog
    from tillroll.operators.staging import release
    from tillroll.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", cpus)))
    qs = catalog.queries()
    timings: dict[str, float] = {}
    for name in names:
        def run() -> float:
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - t0
            release(spark)  # what this run staged
            return elapsed

        run()  # warm-up: JIT, file listing, broadcast of dims
        timings[name] = round(statistics.median(run() for _ in range(runs)), 3)
        print(f"# {name}: {timings[name]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_median_sec",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
