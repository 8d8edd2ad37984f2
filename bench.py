"""Headline-query timings; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and run to completion (``noop`` sink: every row is
produced, nothing is collected): all queries once to warm up, then each
``BENCH_REPEATS`` times; the reported time per query is the median. ``value`` is the sum of
the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = ["itineraries", "itineraries_left", "daily_itineraries", "lookup_batch", "predict_region",
            "itineraries_from_text", "daily_itineraries_from_text"]


def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")

    from tracelake.plans.catalog import QUERIES
    from tracelake.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * cpus)))
    for name in names:  # warm-up pass over every query first
        run_once(spark, QUERIES[name], sf_dir)
    timings = {}
    for name in names:
        runs = [run_once(spark, QUERIES[name], sf_dir) for _ in range(repeats)]
        timings[name] = round(statistics.median(runs), 3)
    spark.stop()
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeats": repeats,
    }))


if __name__ == "__main__":
    main()
