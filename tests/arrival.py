"""Controlled disorder: events that arrive later than they happened."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from curbline.fixed import LATE_FRACTION, LONGEST_DELAY, SHORTEST_DELAY
from curbline.functions import interval_us

_STEPS = 1_000_000


def _uniform(seed: int) -> Column:
    """Number in [0, 1) that is a function of the trip, so every run draws the same."""
    return F.pmod(F.xxhash64("trip_id", F.lit(seed)), F.lit(_STEPS)) / F.lit(float(_STEPS))


def disorder(events: DataFrame, fraction: float = LATE_FRACTION, longest: timedelta = LONGEST_DELAY,
             shortest: timedelta = SHORTEST_DELAY, seed: int = 0) -> DataFrame:
    """Add ``arrival_time``: ``fraction`` of the events is held back between the two delays of event time."""
    low, high = interval_us(shortest), interval_us(longest)
    held = (F.lit(low) + _uniform(seed + 1) * (high - low)).cast("bigint")
    delay = F.when(_uniform(seed) < fraction, held).otherwise(0)
    return events.withColumn("arrival_time", F.timestamp_micros(F.unix_micros("dropoff_datetime") + delay))


def write_in_arrival_order(events: DataFrame, path: str, span: timedelta, files: int = 1) -> int:
    """Append the events slice by slice of their arrival time; returns the number of slices.

    A file stream reads files by age, so one slice is written after the other, each by ``files``
    tasks. Choose the span for the volume: a slice is one job.
    """
    slice_no = F.expr(f"unix_micros(arrival_time) div {interval_us(span)}")
    numbered = events.withColumn("_slice", slice_no)
    first, last = numbered.agg(F.min("_slice"), F.max("_slice")).first()
    if first is None:
        return 0
    for n in range(first, last + 1):
        part = numbered.where(F.col("_slice") == n).drop("_slice", "arrival_time")
        part.repartition(files).write.mode("append").parquet(path)
    return last - first + 1
