"""The landing table: every message read, decoded and judged once, for all results that follow.

One query reads the source and appends events and dead letters to one table, a folder for each. The file sink's log
makes each message appear exactly once, also after a failure. Results read the table's events as streams of their
own, so the source is read and decoded once however many results there are, and the dead letters need no second reader.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..fixed import DEMAND_WINDOW, FILE_ROLLOVER
from ..functions import slice_start
from ..functions.clock import moment
from ..schemas import TRIP_EVENT
from ..session import make_folder
from .contract import VIOLATION, contract_violation
from .sink import start_file_sink

KIND, EVENT, DEAD_LETTER = "kind", "event", "dead_letter"
LANDED = StructType([*(StructField(f.name, f.dataType) for f in TRIP_EVENT),
                     *(StructField(name, StringType()) for name in ("value", VIOLATION, KIND))])


def landed(decoded: DataFrame) -> DataFrame:
    """Rows of the landing table: events, and dead letters with their text (if there is one) and what is wrong with them."""
    tagged = decoded.withColumn(VIOLATION, contract_violation(decoded))
    bad = F.col(VIOLATION).isNotNull()
    text = F.col("value").cast("string") if "value" in decoded.columns else F.lit(None).cast("string")
    return tagged.select(*TRIP_EVENT.names, F.when(bad, text).alias("value"), VIOLATION,
                         F.when(bad, DEAD_LETTER).otherwise(EVENT).alias(KIND))


def start_landing(decoded: DataFrame, path: str, checkpoint: str, rollover: timedelta | None = FILE_ROLLOVER,
                  files: int | None = None) -> StreamingQuery:
    """Append what a decoded stream holds to the landing table at ``path``; None drains what is there."""
    return start_file_sink(landed(decoded), path, checkpoint, rollover, files, partition_by=[KIND])


def read_landed_events(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The events of a landing table as a stream. Only finished batches are seen."""
    make_folder(spark, path)  # the landing query may not have written yet
    reader = spark.readStream.schema(LANDED)
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader
    return reader.parquet(path).where(F.col(KIND) == EVENT).select(*TRIP_EVENT.names)


def landed_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDED).parquet(path).where(F.col(KIND) == EVENT).select(*TRIP_EVENT.names)


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDED).parquet(path).where(F.col(KIND) == DEAD_LETTER).drop(KIND)


def late_counts(events: DataFrame, demand: DataFrame, closed_at: datetime | Column, size: timedelta = DEMAND_WINDOW) -> DataFrame:
    """window_start, pickup_zone_id, arrived, counted, late: windows closed by ``closed_at`` that miss events of the landing table.

    The engine drops late rows inside its operators and counts them only. What arrived is in the landing table, what was
    counted in the result; both are batches here, so this says exactly how many came too late, and for which window.
    """
    start = slice_start(F.col("dropoff_datetime"), size)
    arrived = (events.where(F.col("pickup_zone_id").isNotNull()).groupBy(start.alias("window_start"), "pickup_zone_id")
               .agg(F.count("*").alias("arrived")).where(F.col("window_start") + F.lit(size) <= moment(closed_at)))
    counted = demand.select("window_start", "pickup_zone_id", F.col("trip_count").alias("counted"))
    both = arrived.join(counted, ["window_start", "pickup_zone_id"], "left").na.fill(0, ["counted"])
    return both.withColumn("late", F.col("arrived") - F.col("counted")).where("late > 0")
