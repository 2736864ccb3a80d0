"""Benchmark every registered query of the analytics engine at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully executed through the ``noop`` sink (the whole plan runs, nothing is
collected to the driver). One untimed warm-up pass primes the JVM; then every query runs
$BENCH_REPEATS times and its median is reported; all are in the total. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarterdeck.plans.catalog import QUERIES  # noqa: E402
from quarterdeck.session import build_session  # noqa: E402

HEADLINE = list(QUERIES)
# The streaming replay lands Bronze as files and runs three micro-batches: one run, not three.
ONCE = {"scd1_stream"}


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = build_session(f"local[{cpus}]", app_name="quarterdeck-bench", shuffle_partitions=int(cpus))
    run_once(spark, "atv", sf_dir)  # warm-up
    times = {}
    for name in names:
        runs = 1 if name in ONCE else repeats
        times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
