"""Zone and date dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F


def dim_zones(lookup: DataFrame) -> DataFrame:
    return lookup.select(
        F.col("LocationID").cast("int").alias("zone_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone"))


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every day from ``start`` to the day before ``end``."""
    bounds = spark.range(1).select(F.lit(start).alias("first_day"), F.lit(end).alias("end_day"))
    return spine_between(bounds)


def spine_between(bounds: DataFrame) -> DataFrame:
    """Days of one row's ``first_day`` up to but without its ``end_day``."""
    days = F.sequence(F.col("first_day"), F.date_sub("end_day", 1))
    return bounds.where("first_day < end_day").select(F.explode(days).alias("date_day"))


def trip_day_bounds(trips: DataFrame) -> DataFrame:
    """Bounds of a spine that covers every pickup day."""
    day = F.to_date("pickup_datetime")
    return trips.agg(F.min(day).alias("first_day"), F.date_add(F.max(day), 1).alias("end_day"))


def dim_date(spine: DataFrame) -> DataFrame:
    day = F.col("date_day")
    weekday = F.weekday(day) + 1
    return spine.select(
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.day(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.dayname(day).alias("day_name"),
        F.monthname(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.weekofyear(day).alias("week_of_year"),
        (weekday >= 6).alias("is_weekend"))
