"""Trips as an event stream, prepared as a batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import trip_key
from ..schemas import TRIP_EVENT
from .normalize import RAW_COLUMNS
from .rules import split_valid
from .staging import trip_gate


def _without_nan(df: DataFrame) -> DataFrame:
    amounts = [name for name, dtype in df.dtypes if dtype == "double"]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in amounts})


def to_events(raw: DataFrame, produced_at: Column | None = None) -> DataFrame:
    """Raw trips to contract events: known times, positive duration, NaN as NULL.

    The id is a hash of the trip's natural key, so a second replay can be told from new trips.
    """
    trips = _without_nan(raw.select(*(F.col(src) for src, _, _ in RAW_COLUMNS)))
    typed = trips.select(*(F.col(src).try_cast(dtype).alias(name) for src, name, dtype in RAW_COLUMNS))
    sane = typed.where(F.col("dropoff_datetime") > F.col("pickup_datetime"))
    stamp = F.current_timestamp() if produced_at is None else produced_at
    return (sane.withColumn("trip_id", trip_key())
            .withColumn("event_produced_at", stamp)
            .select(*TRIP_EVENT.names))


def batch_grade(events: DataFrame) -> DataFrame:
    """Events that the batch would accept as trips too; what is left to differ are copies and late rows."""
    clean, _ = split_valid(events)
    return trip_gate(clean)


def event_key() -> Column:
    """Routing key: the pickup zone as text, "0" where there is none."""
    return F.coalesce(F.col("pickup_zone_id"), F.lit(0)).cast("string")


def to_wire(events: DataFrame) -> DataFrame:
    """Events with their routing key and times as epoch milliseconds."""
    times = [name for name, dtype in events.dtypes if dtype == "timestamp"]
    return events.withColumn("event_key", event_key()).withColumns(
        {c: F.unix_millis(c) for c in times})


def in_event_order(events: DataFrame) -> DataFrame:
    """Globally ordered by dropoff time.

    The id and a row number only let the range partitioner cut inside one hot time stamp, or inside
    one group of copies.
    """
    return (events.withColumn("_row", F.monotonically_increasing_id())
            .orderBy("dropoff_datetime", "trip_id", "_row").drop("_row"))
