"""Time every query over the sample tables and print one JSON line.

Each query is forced by a ``noop`` write: one warm-up, then the median of ``BENCH_RUNS`` runs, or of
a single one where the warm-up took over ten seconds.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

import pyspark

from dayfold.session import local_session
from registry.queries import QUERIES


def seconds(spark, query, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    names = sys.argv[1:] or list(QUERIES)

    own = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(
        cores,
        app="bench",
        spark__checkpoint__dir=f"file:{own}/shared",
        spark__sql__warehouse__dir=f"{own}/warehouse",
    )
    medians = {}
    for name in names:
        repeats = 1 if seconds(spark, QUERIES[name], folder) > 10 else runs
        timed = [seconds(spark, QUERIES[name], folder) for _ in range(repeats)]
        medians[name] = round(statistics.median(timed), 3)
        print(f"{name:32s} {medians[name]:8.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "sum of the median query times",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": folder.rsplit("sf", 1)[-1],
                "cores": cores,
                "runs": runs,
                "spark": pyspark.__version__,
                "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                "driver_memory": spark.conf.get("spark.driver.memory"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
