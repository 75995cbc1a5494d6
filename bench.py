"""Benchmark: every registered analysis on the star mapping.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full with the ``noop`` sink (every row computed,
nothing collected to the driver), after one warm-up run of the flagship
query.  ``BENCH_REPEATS`` (default 3) runs per query; the median is kept.
Prints one JSON line: total seconds over all queries and per-query seconds.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from salescope.plans.session import build_session  # noqa: E402
from salescope.registry import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus * 2)))
    spark = build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=partitions,
        app_name="salescope-bench",
        extra={"spark.driver.memory": "16g"},
    )
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="salescope-bench-ckpt-", dir="/tmp"))

    QUERIES["top10_agents_value"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        runs = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 4)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "repeats": repeats,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
