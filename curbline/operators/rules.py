"""Ordered quality rules: every row is either clean or quarantined with one reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed import MAX_DISTANCE

REASON = "_reject_reason"


def trip_rules(max_distance: float = MAX_DISTANCE) -> list[tuple[str, Column]]:
    """Rules of the silver layer, first match wins. A NULL operand never matches."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return [
        ("null_pickup", pickup.isNull()),
        ("null_dropoff", dropoff.isNull()),
        ("zero_or_negative_duration", dropoff <= pickup),
        ("negative_fare", F.col("fare_amount") < 0),
        ("absurd_distance", F.col("trip_distance") > max_distance),
    ]


def reject_reason(rules: list[tuple[str, Column]]) -> Column:
    """Name of the first rule that matches, NULL if none does."""
    return F.coalesce(*(F.when(matches, F.lit(name)) for name, matches in rules))


def tag_rejects(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> DataFrame:
    return df.withColumn(REASON, reject_reason(rules or trip_rules()))


def split_valid(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined). Together they hold every row once."""
    tagged = tag_rejects(df, rules)
    clean = tagged.where(F.col(REASON).isNull()).drop(REASON)
    return clean, tagged.where(F.col(REASON).isNotNull())


def run_metrics(bronze: DataFrame) -> DataFrame:
    """Rows seen, rows quarantined and their share per month, in one pass.

    Counted from the data and not by accumulators: those count a task again when its executor is
    lost and the task reruns.
    """
    reason = reject_reason(trip_rules())
    total, bad = F.count("*"), F.count(reason)
    return bronze.groupBy("year", "month").agg(
        total.alias("silver_total"),
        bad.alias("silver_quarantined"),
        (bad / F.greatest(total, F.lit(1))).alias("quarantine_pct"))
