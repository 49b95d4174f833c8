"""Staging model: trip-grain contract, one row per trip, surrogate key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed import PAYMENT_TYPES
from ..functions import minute_boundaries, trip_key
from ..schemas import FCT_TRIPS, TRIP_KEY
from .dedup import first_per_key

GATE_REASON = "_gate_reason"


def gate_conditions() -> list[tuple[str, Column]]:
    """What a row must meet to be a trip; a NULL operand fails its condition."""
    return [
        ("duration_not_positive", F.col("pickup_datetime") < F.col("dropoff_datetime")),
        ("fare_missing_or_negative", F.col("fare_amount") >= 0),
        ("total_missing_or_negative", F.col("total_amount") >= 0),
        ("payment_type_unknown", F.col("payment_type").isin(PAYMENT_TYPES)),
        ("pickup_zone_missing", F.col("pickup_zone_id").isNotNull()),
        ("dropoff_zone_missing", F.col("dropoff_zone_id").isNotNull()),
    ]


def trip_gate(df: DataFrame) -> DataFrame:
    for _, holds in gate_conditions():
        df = df.where(holds)
    return df


def gate_rejects(df: DataFrame) -> DataFrame:
    """The rows the gate drops, each with the first condition it fails."""
    failed = (F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in gate_conditions())
    return df.withColumn(GATE_REASON, F.coalesce(*failed)).where(F.col(GATE_REASON).isNotNull())


def staging_loss(df: DataFrame) -> DataFrame:
    """Rows lost between gold and staging, by reason; "duplicate" counts surplus copies."""
    gated = gate_rejects(df).groupBy(F.col(GATE_REASON).alias("reason")).agg(F.count("*").alias("rows"))
    copies = (trip_gate(df).groupBy(*TRIP_KEY).agg((F.count("*") - 1).alias("surplus"))
              .where("surplus > 0")
              .groupBy(F.lit("duplicate").alias("reason")).agg(F.sum("surplus").alias("rows")))
    return gated.unionByName(copies)


def stage_trips(gold: DataFrame) -> DataFrame:
    """Gold trips to the fact grain."""
    needed = [f.name for f in FCT_TRIPS if f.name in gold.columns]
    trips = first_per_key(trip_gate(gold.select(*needed)), TRIP_KEY)
    minutes = minute_boundaries(F.col("pickup_datetime"), F.col("dropoff_datetime"))
    return (trips.withColumns({"trip_sk": trip_key(), "trip_duration_minutes": minutes})
            .select(*FCT_TRIPS.names))


def month_of(df: DataFrame, run_month: date) -> DataFrame:
    """Rows of the month a run reprocesses."""
    return df.where((F.col("year") == run_month.year) & (F.col("month") == run_month.month))


def stage_month(gold: DataFrame, run_month: date) -> DataFrame:
    """Staged trips of one month.

    The month filter comes before the deduplication, so one partition is read, not the table. A
    trip found in the files of two months ends in the fact table once either way: the merge on
    trip_sk lets the later run replace it.
    """
    return stage_trips(month_of(gold, run_month))
