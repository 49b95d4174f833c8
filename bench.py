"""Wall time per query, one JSON line on stdout.

Every query runs once to warm up, then ``BENCH_RUNS`` times (default 2, the median counts). Results go
to the no-op sink: all rows and columns are computed, none travel to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from curbline.registry import QUERIES
from curbline.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def timed(spark, query) -> float:
    start = time.perf_counter()
    query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names or QUERIES:
        timed(spark, QUERIES[name])
        seconds[name] = round(statistics.median(timed(spark, QUERIES[name]) for _ in range(RUNS)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total query wall time", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
