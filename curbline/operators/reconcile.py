"""Batch against speed layer."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..fixed import DEMAND_WINDOW, DRIFT_LOOKBACK, DRIFT_ROWS, DRIFT_SAMPLE, DRIFT_TOLERANCE
from ..functions.clock import moment, slice_start
from ..schemas import FCT_TRIPS
from .check_states import month_rows, months_where
from .demand import recount


class DriftError(ValueError):
    """The two layers differ by more than the tolerance."""


def since(df: DataFrame, ts: str, as_of: datetime | Column, lookback: timedelta, size: timedelta = DEMAND_WINDOW) -> DataFrame:
    """Rows from the window on that holds the moment ``lookback`` before ``as_of``.

    The bound is the start of a window for either layer: a first window cut in two would look like drift.
    """
    return df.where(F.col(ts) >= slice_start(moment(as_of) - F.lit(lookback), size))


def recent_trips(spark: SparkSession, table: str, months: DataFrame, as_of: datetime | Column, lookback: timedelta = DRIFT_LOOKBACK,
                 size: timedelta = DEMAND_WINDOW) -> DataFrame:
    """``since`` of a month-partitioned fact table, opening only folders that hold such trips.

    ``months`` has the span of dropoffs in each folder (``check_states.spans``): a folder holds what its file brought, so the
    calendar does not say where the trips of the last day are.
    """
    bound = slice_start(moment(as_of) - F.lit(lookback), size)
    found = months_where(months, F.col("last_dropoff") >= bound)
    rows = month_rows(spark, table, found) if found else spark.createDataFrame([], FCT_TRIPS)
    return since(rows, "dropoff_datetime", as_of, lookback, size)


def compare_layers(batch_counts: DataFrame, speed: DataFrame) -> DataFrame:
    """Counts of both layers and their relative difference, for every window either layer knows."""
    counted = speed.select("window_start", "pickup_zone_id", F.col("trip_count").alias("speed_count"))
    # A zone the fact table lacks is NULL on the speed side only; NULL keys never pair, as intended.
    both = batch_counts.join(counted, ["window_start", "pickup_zone_id"], "full_outer")
    batch = F.coalesce("batch_count", F.lit(0))
    fast = F.coalesce("speed_count", F.lit(0))
    return both.select(
        "window_start",
        F.col("pickup_zone_id").alias("zone_id"),
        batch.alias("batch_count"),
        fast.alias("speed_count"),
        (F.abs(batch - fast) / F.nullif(F.greatest(batch, fast), F.lit(0))).alias("rel_diff"))


def reconcile(trips: DataFrame, speed: DataFrame, as_of: datetime | Column,
              lookback: timedelta = DRIFT_LOOKBACK, tolerance: float = DRIFT_TOLERANCE,
              size: timedelta = DEMAND_WINDOW) -> DataFrame:
    """Windows of the last ``lookback`` whose counts differ by more than ``tolerance``."""
    batch_counts = recount(since(trips, "dropoff_datetime", as_of, lookback, size), size)
    recent = since(speed, "window_start", as_of, lookback, size)
    return compare_layers(batch_counts, recent).where(F.col("rel_diff") > tolerance)


def worst_drifts(drifts: DataFrame, n: int = DRIFT_ROWS) -> DataFrame:
    return drifts.orderBy(F.desc("rel_diff"), "window_start", "zone_id").limit(n)


def verdict(drifts: DataFrame) -> DataFrame:
    """One row: how many windows drift, the largest difference, and whether the layers agree."""
    return drifts.agg(F.count("*").alias("drifts"), F.max("rel_diff").alias("largest"), (F.count("*") == 0).alias("agree"))


def assert_reconciled(drifts: DataFrame, sample: int = DRIFT_SAMPLE) -> None:
    """Raise with a sample of the worst drifts if there is any."""
    worst = worst_drifts(drifts, sample).collect()
    if worst:
        lines = (f"window {r.window_start} zone {r.zone_id}: batch {r.batch_count},"
                 f" speed {r.speed_count}, difference {r.rel_diff:.2%}" for r in worst)
        raise DriftError("batch and speed layer differ\n" + "\n".join(lines))
