"""Benchmark the headline queries.

Runs each query over the whole tables of $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and forces full execution with the ``noop`` sink (no driver collect).
Prints one JSON line: {"metric", "value", "unit", "queries": {...}, "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["impute_linear", "nearest_valid_join", "impute_similar_series", "impute_knn",
            "score_on_holes", "fluctuation_index"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from lacuna.session import get_spark
    from lacuna.plans.catalog import QUERIES
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # warm-up: JVM, parquet footers, Python workers
    QUERIES["fluctuation_index"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
