"""Time all queries of the reads, batch and live jobs; prints one JSON line.

Each batch query is run twice to warm up and then ``BENCH_RUNS`` times (3 by default) with all its
rows written to the no-op sink; the median counts. Live jobs are run once, start to end.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pyspark  # noqa: E402

from trolley.plans.catalog import QUERIES  # noqa: E402
from trolley.session import local  # noqa: E402


def timed(query, spark, folder: str) -> float:
    begin = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]
    spark = local(cores, partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, query in QUERIES.items():
        live = name.startswith(("stream_", "dashboard_", "compacted_", "reset_"))
        if only and name not in only:
            continue
        for _ in range(0 if live else 2):
            timed(query, spark, folder)
        taken = [timed(query, spark, folder) for _ in range(1 if live else runs)]
        seconds[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "spark": pyspark.__version__,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
