"""Benchmark: time the headline queries at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  Each query is run to completion with the ``noop``
sink (full execution, nothing collected to the driver).  One untimed warm-up
pass over the same data (``BENCH_WARMUP_DIR`` to change it, empty to skip)
absorbs JVM start-up, code generation and JIT compilation; each timed value
is then the best of ``BENCH_REPEAT`` runs (default 3) and includes plan
construction.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhouse.plans import bench_tables as B  # noqa: E402
from tallyhouse.session import local_session  # noqa: E402

HEADLINE = {
    "deal_metrics": B.deal_metrics,
    "listing_metrics": B.listing_metrics,
    "listing_price_house_dominant": lambda s, d: B.listing_price_house(s, d, area_bands="dominant"),
    "metrics_all": B.metrics_all,
    "word_count": B.word_count,
    "area_band_histogram": B.area_band_histogram,
}


def _run(spark, fn, sf_dir):
    t = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", sf_dir)
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="tallyhouse-bench")
    if warm_dir and os.path.isdir(warm_dir):
        for fn in HEADLINE.values():
            _run(spark, fn, warm_dir)
    times = {}
    for name, fn in HEADLINE.items():
        times[name] = round(min(_run(spark, fn, sf_dir) for _ in range(max(1, repeat))), 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
