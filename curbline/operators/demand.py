"""Windowed demand per zone. ``zone_demand`` and ``hop_average`` serve batches and streams alike."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from ..fixed import DEMAND_WINDOW, HOP_SIZE, HOP_SLIDE
from ..functions import exact_avg, exact_rest, exact_sum, exact_total, exact_units, interval_us, ratio, slice_start
from ..functions.clock import interval_text


def zone_demand(events: DataFrame, size: timedelta = DEMAND_WINDOW) -> DataFrame:
    """Trips, average fare and revenue per zone and tumbling window of the dropoff time."""
    return (events.where(F.col("pickup_zone_id").isNotNull())
            .groupBy(F.window("dropoff_datetime", interval_text(size)).alias("w"), "pickup_zone_id")
            .agg(F.count("*").alias("trip_count"),
                 exact_avg("fare_amount").alias("avg_fare"),
                 exact_sum("total_amount").alias("total_revenue"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "pickup_zone_id", "trip_count", "avg_fare", "total_revenue"))


def _panes(events: DataFrame, slide: timedelta) -> DataFrame:
    units = exact_units("fare_amount")
    return (events.where(F.col("dropoff_datetime").isNotNull())
            .groupBy("pickup_zone_id", slice_start(F.col("dropoff_datetime"), slide).alias("pane"))
            .agg(F.sum(units).alias("units"), F.sum(exact_rest("fare_amount")).alias("rest"), F.count(units).alias("fares"),
                 F.max("fare_amount").alias("max_fare")))


def hop_windows(events: DataFrame, size: timedelta = HOP_SIZE, slide: timedelta = HOP_SLIDE) -> DataFrame:
    """Average fare per zone and hopping window, with the non-empty panes of each window.

    A row lies in size/slide windows. Rows are first summed per slide-wide pane, and only the panes
    are copied to their windows: the copies grow with zones x time and not with the rows.
    """
    size_us, slide_us = interval_us(size), interval_us(slide)
    if size_us % slide_us:
        raise ValueError("the window size must be a multiple of the slide")
    pane_us = F.unix_micros("pane")
    starts = F.sequence(pane_us - (size_us - slide_us), pane_us, F.lit(slide_us))
    return (_panes(events, slide)
            .withColumn("start_us", F.explode(starts))
            .groupBy("pickup_zone_id", "start_us")
            .agg(ratio(exact_total(F.sum("units"), F.sum("rest")), F.sum("fares")).alias("zone_avg_fare"),
                 F.collect_list(F.struct("pane", "max_fare")).alias("panes"))
            .select("pickup_zone_id",
                    F.timestamp_micros("start_us").alias("window_start"),
                    F.timestamp_micros(F.col("start_us") + size_us).alias("window_end"),
                    "zone_avg_fare", "panes"))


def hop_average(events: DataFrame, size: timedelta = HOP_SIZE, slide: timedelta = HOP_SLIDE) -> DataFrame:
    """Average fare per zone (the unknown zone included) and hopping window."""
    return hop_windows(events, size, slide).drop("panes")


def recount(trips: DataFrame, size: timedelta = DEMAND_WINDOW) -> DataFrame:
    """Trips per dropoff slice and zone, counted from the fact table."""
    return (trips.groupBy(slice_start(F.col("dropoff_datetime"), size).alias("window_start"), "pickup_zone_id")
            .agg(F.count("*").alias("batch_count")))


def live_demand(demand: DataFrame, span: timedelta = timedelta(hours=1)) -> DataFrame:
    """Demand windows of the last ``span`` before the newest window end."""
    newest = demand.agg(F.max("window_end")).scalar()
    return demand.where(F.col("window_end") > newest - F.lit(span))
