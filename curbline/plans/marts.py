"""Marts: warehouse load, dimensions, the fact merge and the checks on them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..fixed import PAYMENT_TYPES, VOLUME_CHANGE_PERCENT
from ..operators import check_states as states, checks
from ..operators.dimensions import date_spine, dim_date, dim_zones
from ..operators.sinks import Month, clustered, delete_then_append_month, merge_upsert
from ..operators.staging import month_of, stage_month, stage_trips
from ..sources.files import read_gold_for_load, read_table, read_zone_lookup
from .lake import Lake


def load_warehouse_month(spark: SparkSession, lake: Lake, year: int, month: int) -> None:
    rows = read_gold_for_load(spark, lake.gold_trips, year, month)
    delete_then_append_month(rows, lake.warehouse_trips, year, month)


def build_dimensions(spark: SparkSession, lake: Lake, zone_csv: str, start: date, end: date) -> None:
    """Small dimensions, rebuilt in full."""
    dim_zones(read_zone_lookup(spark, zone_csv)).write.mode("overwrite").parquet(lake.dim_zones)
    dim_date(date_spine(spark, start, end)).write.mode("overwrite").parquet(lake.dim_date)


def build_fct_trips(spark: SparkSession, lake: Lake, run_month: date) -> list[Month]:
    """Merge the run's month into the fact table; the first build takes all months. Returns the months written.

    The states of the table's months say which of them can hold a trip of the updates; the others are not opened.
    """
    gold = spark.read.parquet(lake.warehouse_trips)
    first = read_table(spark, lake.fct_trips) is None
    updates = stage_trips(gold) if first else stage_month(gold, run_month)

    def overlapping(staged: DataFrame) -> list[Month]:
        span = staged.agg(F.min("pickup_datetime").alias("first"), F.max("pickup_datetime").alias("last")).first()
        if span["first"] is None:
            return []
        met = (F.col("first_pickup") <= F.lit(span["last"])) & (F.col("last_pickup") >= F.lit(span["first"]))
        return states.months_where(states.spans(spark, lake.states), met)

    indexed = read_table(spark, f"{lake.states}/{states.METRICS}") is not None
    return merge_upsert(spark, updates, lake.fct_trips, layout=clustered, overlapping=overlapping if indexed else None)


def fct_contract() -> list[checks.Check]:
    """Checks of the fact table that one aggregation answers."""
    return [*(checks.not_null(c, "fct_trips") for c in ("trip_sk", "pickup_zone_id", "trip_duration_minutes")),
            checks.accepted_values("payment_type", PAYMENT_TYPES, "fct_trips"),
            checks.zero_duration()]


def build_checks(fct: DataFrame, zones: DataFrame, dates: DataFrame) -> DataFrame:
    """Checks of the models, run before anything reads them."""
    return checks.all_checks(
        checks.run_checks(fct, fct_contract()),
        checks.run_checks(zones, [checks.not_null("zone_id", "dim_zones")]),
        checks.run_checks(dates, [checks.not_null("date_day", "dim_date")]),
        unique_checks(fct, zones, dates),
        checks.relationships(fct, "pickup_zone_id", zones, "zone_id", "fct_trips"))


def not_null_checks(fct: DataFrame, zones: DataFrame, dates: DataFrame) -> DataFrame:
    return checks.all_checks(
        checks.run_checks(fct, [c for c in fct_contract() if c.name.startswith("not_null")]),
        checks.run_checks(zones, [checks.not_null("zone_id", "dim_zones")]),
        checks.run_checks(dates, [checks.not_null("date_day", "dim_date")]))


def unique_checks(fct: DataFrame, zones: DataFrame, dates: DataFrame) -> DataFrame:
    return checks.all_checks(
        checks.unique(fct, "trip_sk", "fct_trips"),
        checks.unique(zones, "zone_id", "dim_zones"),
        checks.unique(dates, "date_day", "dim_date"))


def month_checks(spark: SparkSession, lake: Lake, zones: DataFrame, dates: DataFrame) -> DataFrame:
    """``build_checks`` from the stored states of the fact table's months."""
    return checks.all_checks(
        states.judged(spark, lake.states, [*fct_contract(), states.key_checks()[0]]),
        checks.run_checks(zones, [checks.not_null("zone_id", "dim_zones")]),
        checks.run_checks(dates, [checks.not_null("date_day", "dim_date")]),
        checks.unique(zones, "zone_id", "dim_zones"), checks.unique(dates, "date_day", "dim_date"),
        states.known_zones(spark, lake.states, zones))


def runtime_checks(fct: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Checks of the loaded table, from its rows."""
    return checks.all_checks(
        checks.run_checks(fct, checks.fact_checks(as_of)),
        checks.duplicate_count(fct, "trip_sk"))


def loaded_checks(spark: SparkSession, lake: Lake, as_of: datetime | Column) -> DataFrame:
    """``runtime_checks`` from the stored states of the table's months."""
    return states.judged(spark, lake.states, [*checks.fact_checks(as_of), states.key_checks()[1]], as_of)


def run_history(spark: SparkSession, lake: Lake, run_month: date) -> DataFrame:
    """table_name, run_at, row_count: runs that passed, and this one from its state."""
    own = spark.read.parquet(f"{lake.states}/{states.METRICS}")
    own = month_of(own, run_month).select(F.lit("fct_trips").alias("table_name"), F.lit(run_month).cast("timestamp").alias("run_at"), "row_count")
    before = read_table(spark, lake.run_history)
    if before is None:
        return own
    return own.unionByName(before.where(F.col("run_at") != F.lit(run_month).cast("timestamp")).select(own.columns))


def record_run(spark: SparkSession, lake: Lake, run_month: date) -> None:
    """Store how many trips the run's month has, a row per month: a repeated run replaces its own."""
    own = run_history(spark, lake, run_month).where(F.col("run_at") == F.lit(run_month).cast("timestamp"))
    own.coalesce(1).write.mode("overwrite").parquet(f"{lake.run_history}/run={run_month:%Y-%m}")


def volume_check(history: DataFrame, run_month: date) -> DataFrame:
    """The month's row count against those of the months before it, as a check."""
    own = checks.volume_change(history).where(F.col("run_at") == F.lit(run_month).cast("timestamp"))
    return own.select(F.lit("row_count_change(fct_trips)").alias("check"), "status", F.col("change_pct").alias("observed"),
                      F.lit(f"< {VOLUME_CHANGE_PERCENT} %").alias("threshold"))
