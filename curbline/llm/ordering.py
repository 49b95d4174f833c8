"""A global order over all rows without one task that sees them all.

Rows are range-partitioned and sorted, each task numbers its own, and what comes before a task's first
row is a prefix sum over one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .runtime import stored

_ROWS_BITS = 33


def numbered(df: DataFrame, *order: str, label: str = "ordered") -> DataFrame:
    """``df`` stored in the order of ``order``, with ``chunk`` (range, ascending) and ``nth`` (row in it, from 0).

    The numbers are made once, as the rows are written, so a repeated task reads the same. Rows equal in ``order`` are
    told apart by their place in the input: however many they are, they are cut into ranges like any others.
    """
    at = F.monotonically_increasing_id()
    placed = df.withColumn("_row", at)
    ordered = placed.repartitionByRange(*order, "_row").sortWithinPartitions(*order, "_row").drop("_row").withColumn("_at", at)
    return (stored(ordered, label).withColumn("chunk", F.shiftright("_at", _ROWS_BITS))
            .withColumn("nth", F.col("_at").bitwiseAND((1 << _ROWS_BITS) - 1)).drop("_at"))


def before_chunk(df: DataFrame, **amounts: Column) -> DataFrame:
    """Per chunk, the total of each amount over all chunks before it. One row per chunk is summed."""
    totals = df.groupBy("chunk").agg(*[F.sum(v).alias(k) for k, v in amounts.items()])
    earlier = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("chunk", *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"{k}_before") for k in amounts])
