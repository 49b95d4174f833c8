"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..fixed import PAYMENT_TYPES


def _refused(columns: list[str]) -> list[Column]:
    """What the staging gate would refuse a row for, of the columns in which copies of a trip may differ."""
    holds = {"fare_amount": F.col("fare_amount") >= 0, "payment_type": F.col("payment_type").isin(PAYMENT_TYPES)}
    return [(~F.coalesce(h, F.lit(False))).alias(f"_refused_{c}") for c, h in holds.items() if c in columns]


def first_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep one row per key: one the staging gate accepts if there is one, of those the most complete, then the smallest
    by the remaining columns in order, NULLs last.

    Validity and completeness come before any value, so a valid copy is never given up for one that is dropped later.

    The rule makes reruns and retried tasks keep the same row. It is an aggregate and not a
    row_number window, because an aggregate drops copies inside each task before the shuffle: a key
    with a third of all rows arrives as one row per task, where a window would sort it in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    lacking = sum((F.col(c).isNull().cast("int") for c in rest), F.lit(0)).alias("_lacking")
    ordered = [part for c in rest for part in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*_refused(rest), lacking, *ordered)).alias("_kept"))
    return kept.select(*(F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns))


def repeated_hashes(df: DataFrame, key: str) -> DataFrame:
    """_hash: hashes of ``key`` that more than one row has. Rows without such a hash repeat no key, so that keys are compared among the
    others only; 8 bytes a row are shuffled instead of the key."""
    return df.select(F.xxhash64(key).alias("_hash")).groupBy("_hash").agg(F.count("*").alias("rows")).where("rows > 1").select("_hash")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")
