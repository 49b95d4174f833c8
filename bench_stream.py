"""Throughput and state of the speed layer over the event table, one JSON line on stdout.

The event table is cut into ``BENCH_FILES`` files by time and read one file per micro-batch.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import timedelta
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent / "tests"))

import arrival  # noqa: E402
from curbline import streaming  # noqa: E402
from curbline.session import build_session, scratch_dir  # noqa: E402
from curbline.sources.star_tables import contract_events  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FILES = int(os.environ.get("BENCH_FILES", "10"))


def main() -> None:
    spark = build_session("bench_stream", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_dir(spark, "bench_stream")
    events = contract_events(spark, SF_DIR)
    low, high = events.agg(F.min("dropoff_datetime"), F.max("dropoff_datetime")).first()
    arrivals = events.withColumn("arrival_time", F.col("dropoff_datetime"))
    arrival.write_in_arrival_order(arrivals, f"{root}/in", (high - low) / FILES + timedelta(seconds=1))
    rows, result = events.count(), {}
    for name, build in (("zone_demand", streaming.zone_demand_stream), ("fare_anomalies", streaming.fare_anomaly_stream)):
        stream = streaming.read_event_files(spark, f"{root}/in", max_files=1)
        start = time.perf_counter()
        query = streaming.start_file_sink(build(stream), f"{root}/{name}", f"{root}/cp/{name}", rollover=None)
        query.awaitTermination()
        seconds = time.perf_counter() - start
        progress = query.recentProgress
        result[name] = {
            "sec": round(seconds, 2), "rows_per_sec": round(rows / seconds), "batches": len(progress),
            "state_rows_last_data_batch": sum(op.numRowsTotal for op in progress[-2].stateOperators),
            "state_rows_max": max(sum(op.numRowsTotal for op in p.stateOperators) for p in progress)}
    print(json.dumps({"metric": "speed layer", "rows": rows, "queries": result}))
    spark.stop()


if __name__ == "__main__":
    main()
