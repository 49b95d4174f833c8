"""Aggregates and dashboard measures.

Facts are aggregated before they meet a dimension wherever the dimension's key allows it, so the
join sees one row per zone or month and not one per trip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import exact_avg, exact_rest, exact_sum, exact_total, exact_units, ratio

PICKUP_MONTH = "month_start"


def _month_start() -> Column:
    return F.trunc(F.to_date("pickup_datetime"), "month").alias(PICKUP_MONTH)


def daily_zone_agg(trips: DataFrame) -> DataFrame:
    return (trips.groupBy(F.to_date("pickup_datetime").alias("trip_date"), "pickup_zone_id", "year", "month")
            .agg(F.count("*").alias("trip_count"),
                 exact_sum("total_amount").alias("total_revenue"),
                 exact_avg("fare_amount").alias("avg_fare"),
                 exact_avg("tip_amount").alias("avg_tip"))
            .select("trip_date", "pickup_zone_id", "trip_count", "total_revenue", "avg_fare", "avg_tip",
                    "year", "month"))


def measures(trips: DataFrame, *by: Column | str) -> DataFrame:
    """Trips, total revenue, average fare and tip rate, overall or per group."""
    return trips.groupBy(*by).agg(
        F.count("*").alias("trips"),
        exact_sum("total_amount").alias("total_revenue"),
        exact_avg("fare_amount").alias("avg_fare"),
        ratio(exact_sum("tip_amount"), exact_sum("fare_amount")).alias("tip_rate"))


def monthly_measures(trips: DataFrame) -> DataFrame:
    return measures(trips, _month_start())


def revenue_trend(trips: DataFrame) -> DataFrame:
    return trips.groupBy(_month_start()).agg(exact_sum("total_amount").alias("total_revenue"))


def trips_yoy(trips: DataFrame) -> DataFrame:
    """Trips per month against the same month a year before; NULL where that month has none.

    The frame is a range of years and not a row offset, so a missing year gives NULL. A self-join
    would read the trips twice.
    """
    year_before = (Window.partitionBy(F.month(PICKUP_MONTH)).orderBy(F.year(PICKUP_MONTH))
                   .rangeBetween(-1, -1))
    monthly = trips.groupBy(_month_start()).agg(F.count("*").alias("trips"))
    return (monthly.withColumn("prev_trips", F.max("trips").over(year_before))
            .withColumn("yoy", ratio(F.col("trips") - F.col("prev_trips"), F.col("prev_trips"))))


def star_join(trips: DataFrame, zones: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact rows with their pickup zone and pickup day.

    No broadcast hint: the optimizer broadcasts a dimension while its size is below the threshold
    and shuffles beyond it, where adaptive execution splits a hot zone or day.
    """
    days = dates.select("date_day", "quarter", "week_of_year", "day_of_week", "day_name", "is_weekend")
    keyed = trips.withColumns({"zone_id": F.col("pickup_zone_id"), "date_day": F.to_date("pickup_datetime")})
    return keyed.join(zones, "zone_id", "left").join(days, "date_day", "left")


def _by_zone(trips: DataFrame) -> DataFrame:
    fare = exact_units("fare_amount")
    return (trips.groupBy(F.col("pickup_zone_id").alias("zone_id"))
            .agg(F.count("*").alias("trips"),
                 F.sum(exact_units("total_amount")).alias("total_units"), F.sum(exact_rest("total_amount")).alias("total_rest"),
                 F.sum(fare).alias("fare_units"), F.sum(exact_rest("fare_amount")).alias("fare_rest"),
                 F.count(fare).alias("fares")))


def service_mix(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips and revenue per service zone and their shares of the whole."""
    per_service = (_by_zone(trips).join(zones, "zone_id", "left").groupBy("service_zone")
                   .agg(F.sum("trips").alias("trips"), F.sum("total_units").alias("units"), F.sum("total_rest").alias("rest"))
                   .withColumn("total_revenue", exact_total("units", "rest")))
    # One row per service zone reaches this window.
    whole = Window.partitionBy(F.lit(1))
    return per_service.select(
        "service_zone", "trips", "total_revenue",
        ratio(F.col("trips"), F.sum("trips").over(whole)).alias("trip_share"),
        ratio(F.col("total_revenue"), exact_total(F.sum("units").over(whole), F.sum("rest").over(whole))).alias("revenue_share"))


def zone_heatmap(trips: DataFrame) -> DataFrame:
    return trips.groupBy("pickup_zone_id", "dropoff_zone_id").agg(F.count("*").alias("trips"))


def top_zones(trips: DataFrame, n: int = 10) -> DataFrame:
    """The busiest pickup and the busiest dropoff zones, from one aggregation of the trips."""
    pairs = zone_heatmap(trips)
    side = lambda name: F.struct(F.lit(name).alias("direction"),
                                 F.col(f"{name}_zone_id").alias("zone_id"))
    sides = F.array(side("pickup"), side("dropoff"))
    totals = (pairs.select("trips", F.inline(sides))
              .groupBy("direction", "zone_id").agg(F.sum("trips").alias("trips")))
    busiest = Window.partitionBy("direction").orderBy(F.desc("trips"), "zone_id")
    return totals.withColumn("rank", F.row_number().over(busiest)).where(F.col("rank") <= n)


def borough_drilldown(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips, revenue and average fare per zone under its borough."""
    return _by_zone(trips).join(zones, "zone_id", "left").select(
        "borough", "zone_name", "zone_id", "trips",
        exact_total("total_units", "total_rest").alias("total_revenue"),
        ratio(exact_total("fare_units", "fare_rest"), F.col("fares")).alias("avg_fare"))
