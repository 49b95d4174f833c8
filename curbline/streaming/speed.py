"""The speed layer: zone demand and fare anomalies on an event stream."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..fixed import (ALLOWED_LATENESS, ANOMALY_FACTOR, DEMAND_WINDOW, FILE_ROLLOVER, HOP_SIZE, HOP_SLIDE,
                     WATERMARK)
from ..functions import exact_rest, exact_total, exact_units, interval_us, ratio
from ..functions.clock import interval_text
from ..operators.demand import zone_demand
from ..schemas import FARE_ANOMALIES
from .landing import read_landed_events, start_landing
from .sink import drained, start_file_sink

# Spark has one delay: the out-of-orderness bound plus the allowed lateness.
DELAY = WATERMARK + ALLOWED_LATENESS


def once_per_trip(events: DataFrame, delay: timedelta = DELAY) -> DataFrame:
    """Drop replayed events; their ids are hashes of the trip and so repeat.

    The result carries its watermark: group it directly, with ``operators.demand.zone_demand``.
    """
    return (events.withWatermark("dropoff_datetime", interval_text(delay))
            .dropDuplicatesWithinWatermark(["trip_id"]))


def zone_demand_stream(events: DataFrame, size: timedelta = DEMAND_WINDOW, delay: timedelta = DELAY) -> DataFrame:
    return zone_demand(events.withWatermark("dropoff_datetime", interval_text(delay)), size)


def hop_average_stream(events: DataFrame, size: timedelta = HOP_SIZE, slide: timedelta = HOP_SLIDE, delay: timedelta = DELAY) -> DataFrame:
    """hop (window), pickup_zone_id, zone_avg_fare for every hopping window, each when it has closed.

    Two aggregates in a row: an event enters the state of one pane, the slide-wide window it lies in; a closed
    pane, one row, enters the size/slide hopping windows around it. An event that comes after its pane has closed is late for all
    of them, as it is for the demand of that window.
    """
    units = exact_units("fare_amount")
    panes = (events.where(F.col("pickup_zone_id").isNotNull()).withWatermark("dropoff_datetime", interval_text(delay))
             .groupBy(F.window("dropoff_datetime", interval_text(slide)).alias("slice"), "pickup_zone_id")
             .agg(F.sum(units).alias("units"), F.sum(exact_rest("fare_amount")).alias("rest"), F.count(units).alias("fares")))
    return (panes.groupBy(F.window(F.window_time("slice"), interval_text(size), interval_text(slide)).alias("hop"), "pickup_zone_id")
            .agg(ratio(exact_total(F.sum("units"), F.sum("rest")), F.sum("fares")).alias("zone_avg_fare")))


def fare_anomaly_stream(events: DataFrame, size: timedelta = HOP_SIZE, slide: timedelta = HOP_SLIDE,
                        factor: float = ANOMALY_FACTOR, delay: timedelta = DELAY, salts: int = 16) -> DataFrame:
    """Events above ``factor`` times the average of a hopping window around them.

    Stream-stream join on (zone, pane). An event waits in the state once, not once per window: its key
    is the slide-wide pane that ends when the last window around the event ends, so the watermark
    removes it exactly then. A range condition on the event time would keep all events for ever.
    Averages, one row per zone and window, are copied to the panes of the window and to ``salts``
    state partitions, over which the events of one busy zone are spread.
    """
    fare, known_zone = F.col("fare_amount"), F.col("pickup_zone_id").isNotNull()
    shift, step = interval_us(size - slide), interval_us(slide)
    pane_start = F.unix_micros("hop.start") + shift
    pane = F.struct(F.timestamp_micros("pane_us").alias("start"),
                    F.timestamp_micros(F.col("pane_us") + step).alias("end")).alias("pane")
    averages = (hop_average_stream(events, size, slide, delay)
                .select("pickup_zone_id", "zone_avg_fare",
                        F.explode(F.sequence(pane_start, pane_start + shift, F.lit(step))).alias("pane_us"))
                .select("pickup_zone_id", "zone_avg_fare", pane,
                        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")))
    # The event time of this side is shifted; the dropoff time stays a plain column.
    closes_at = F.timestamp_micros(F.unix_micros("dropoff_datetime") + shift)
    priced = (events.where(known_zone & fare.isNotNull() & ~F.isnan(fare))
              .withColumn("closes_at", closes_at).withWatermark("closes_at", interval_text(delay))
              .select(F.window("closes_at", interval_text(slide)).alias("pane"), "pickup_zone_id", "trip_id", "fare_amount",
                      "dropoff_datetime", F.pmod(F.xxhash64("trip_id"), F.lit(salts)).cast("int").alias("salt")))
    return (priced.join(averages, ["pane", "pickup_zone_id", "salt"])
            .where(fare > factor * F.col("zone_avg_fare"))
            .withColumn("deviation_ratio", ratio(fare, F.col("zone_avg_fare")))
            .select(*FARE_ANOMALIES.names))


def start_speed_layer(decoded: DataFrame, out: str, checkpoints: str, rollover: timedelta | None = FILE_ROLLOVER,
                      delay: timedelta = DELAY, hop: tuple[timedelta, timedelta] = (HOP_SIZE, HOP_SLIDE),
                      idle_batches: bool = True, demand_files: int | None = None, anomaly_files: int | None = None,
                      salts: int = 16, max_files: int | None = None, state_partitions: int | None = None) -> list[StreamingQuery]:
    """The landing table of a decoded source, and both results of its events, each with a checkpoint of its own.

    With ``rollover=None`` the source is drained first, then the results are. Demand is a few rows per zone and window and
    anomalies grow with the trips; ``demand_files`` and ``anomaly_files`` bound the files per rollover, without them
    each shuffle partition writes its own. ``max_files`` bounds the landed files of a result's batch.
    """
    landing = start_landing(decoded, f"{out}/landing", f"{checkpoints}/landing", rollover)
    if rollover is None:
        drained(landing)
    events = read_landed_events(decoded.sparkSession, f"{out}/landing", max_files)
    results = {"zone_demand_5min": (zone_demand_stream(events, delay=delay), demand_files),
               "fare_anomalies": (fare_anomaly_stream(events, *hop, delay=delay, salts=salts), anomaly_files)}
    return [landing, *(start_file_sink(df, f"{out}/{name}", f"{checkpoints}/{name}", rollover, files, idle_batches, state_partitions=state_partitions)
                       for name, (df, files) in results.items())]
