"""Exactly-once Parquet sinks."""

from __future__ import annotations

from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..fixed import FILE_ROLLOVER


@contextmanager
def _settings(spark: SparkSession, **settings: str | None):
    """A query keeps the settings it was started under. None leaves one as it is."""
    keys = {k.replace("__", "."): v for k, v in settings.items() if v is not None}
    before = {k: spark.conf.get(k) for k in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def start_file_sink(df: DataFrame, path: str, checkpoint: str, rollover: timedelta | None = FILE_ROLLOVER,
                    files: int | None = None, idle_batches: bool = True, name: str | None = None,
                    partition_by: list[str] | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Parquet sink that closes files every ``rollover``; None drains what is there.

    ``files`` is the number of files per rollover; without it each shuffle partition writes its own.
    ``idle_batches=False`` lets time move with the data alone: a window closes with the next data and
    not while the source is idle. ``state_partitions`` counts for the first start; after that the checkpoint says.
    """
    out = df.repartition(files) if files else df
    writer = out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    trigger = ({"availableNow": True} if rollover is None
               else {"processingTime": f"{rollover // timedelta(seconds=1)} seconds"})
    with _settings(df.sparkSession, spark__sql__streaming__noDataMicroBatches__enabled=str(idle_batches).lower(),
                   spark__sql__shuffle__partitions=None if state_partitions is None else str(state_partitions)):
        return writer.trigger(**trigger).start()


def drained(*queries: StreamingQuery) -> None:
    """Wait until queries that were started to drain their source have ended; raises what stopped one."""
    for query in queries:
        query.awaitTermination()
