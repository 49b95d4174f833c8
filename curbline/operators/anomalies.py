"""Fares far above their zone's window average."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from ..fixed import ANOMALY_FACTOR, HOP_SIZE, HOP_SLIDE
from ..functions import ratio, slice_start
from ..schemas import FARE_ANOMALIES
from ..session import scratch_dir
from .dedup import first_per_key
from .demand import hop_windows


def fare_anomalies(events: DataFrame, size: timedelta = HOP_SIZE, slide: timedelta = HOP_SLIDE,
                   factor: float = ANOMALY_FACTOR, one_per_trip: bool = False) -> DataFrame:
    """Events whose fare is above ``factor`` times the average of a hopping window around them.

    Every window that holds the event is judged on its own, so one trip may appear up to size/slide
    times; ``one_per_trip`` keeps its largest ratio.

    The range condition "event time inside window" is an equality on the pane, so this is a hash
    join on (zone, pane). Events are not copied. The window side is aggregated, holds at most
    size/slide rows per key and only panes whose largest fare is an anomaly. It is written to the
    working folder first, so its size is known when the join is planned: a few hits are broadcast and the
    events stay where they are; many are shuffled, where a pane with very many events is skewed on the
    event side only, which adaptive execution splits.
    """
    hot = (hop_windows(events, size, slide)
           .where(F.col("pickup_zone_id").isNotNull())
           .select("pickup_zone_id", "zone_avg_fare", F.explode("panes").alias("p"))
           .where(F.col("p.max_fare") > factor * F.col("zone_avg_fare"))
           .select("pickup_zone_id", F.col("p.pane").alias("pane"), "zone_avg_fare"))
    fare = F.col("fare_amount")
    priced = (events.where(fare.isNotNull() & ~F.isnan(fare) & F.col("pickup_zone_id").isNotNull())
              .select("trip_id", "dropoff_datetime", "pickup_zone_id", "fare_amount",
                      slice_start(F.col("dropoff_datetime"), slide).alias("pane")))
    found = (priced.join(_written(hot), ["pickup_zone_id", "pane"])
             .where(F.col("fare_amount") > factor * F.col("zone_avg_fare"))
             .withColumn("deviation_ratio", ratio(F.col("fare_amount"), F.col("zone_avg_fare")))
             .select(*FARE_ANOMALIES.names))
    return _largest_ratio(found) if one_per_trip else found


def _written(hot: DataFrame) -> DataFrame:
    path = scratch_dir(hot.sparkSession, "hot-panes")
    hot.write.parquet(path)
    return hot.sparkSession.read.schema(hot.schema).parquet(path)


def _largest_ratio(found: DataFrame) -> DataFrame:
    trip = ["trip_id", "dropoff_datetime", "pickup_zone_id", "fare_amount"]
    ranked = found.select(*trip, (-F.col("deviation_ratio")).alias("_neg_ratio"), "zone_avg_fare")
    return (first_per_key(ranked, trip)
            .withColumn("deviation_ratio", -F.col("_neg_ratio")).select(*FARE_ANOMALIES.names))


def anomaly_feed(anomalies: DataFrame, n: int = 50) -> DataFrame:
    """The newest anomalies."""
    return anomalies.orderBy(F.desc("dropoff_datetime"), "trip_id", F.desc("deviation_ratio")).limit(n)
