"""Table writers on month-partitioned Parquet.

Every writer leaves the same table when it runs twice. Spark stages the new files next to the table
and moves them in when all tasks have finished, so a writer may read the table it replaces and a
lost executor costs a retry, not data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..schemas import MONTH_KEYS
from ..session import remove_folder, scratch_dir
from ..sources.files import read_table
from .dedup import repeated_hashes

Month = tuple[int, int]


def in_months(months: list[Month]) -> Column:
    """Predicate on the partition columns, answered by partition pruning."""
    cond = F.lit(False)
    for year in sorted({y for y, _ in months}):
        cond = cond | ((F.col("year") == year) & F.col("month").isin(sorted(m for y, m in months if y == year)))
    return cond


def months_of(df: DataFrame) -> list[Month]:
    """The months present: one row per calendar month comes to the driver. Rows without one raise."""
    found = [(r.year, r.month) for r in df.select(*MONTH_KEYS).distinct().collect()]
    if any(y is None or m is None for y, m in found):
        raise ValueError("rows without a year or month")
    return sorted(found)


def replace_partition(df: DataFrame, path: str, file_rows: int | None = None) -> None:
    """Replace every month that ``df`` holds rows of, all other months stay.

    For frames of one or few months: each task writes one file per month it sees, or several of at most ``file_rows``.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer = writer.option("maxRecordsPerFile", file_rows) if file_rows else writer
    writer.partitionBy(*MONTH_KEYS).parquet(path)


def by_month(df: DataFrame) -> DataFrame:
    """Rows gathered by month before a write of many months, so tasks do not write a file each per
    month. A rebalance also cuts a month that is larger than one task should write."""
    return df.hint("rebalance", *MONTH_KEYS)


def replace_months(df: DataFrame, path: str, months: list[Month]) -> None:
    """Replace exactly ``months``; a month without rows ends up empty. A row of another month, or of none,
    fails the write before it is committed.

    A dynamic overwrite leaves a partition alone if no new row falls into it, so a month whose last
    bad row was repaired would keep its old rejects. The row counts come out of the write itself.
    They may count a retried task twice, but zero stays zero.
    """
    seen = Observation()
    counts = [F.count_if((F.col("year") == y) & (F.col("month") == m)).alias(f"y{y}m{m}") for y, m in months]
    stray = F.raise_error(F.concat(F.lit("row of another month: "), F.coalesce(F.col("year").cast("string"), F.lit("none")),
                                   F.lit("-"), F.coalesce(F.col("month").cast("string"), F.lit("none"))))
    own = df.where(F.when(in_months(months), F.lit(True)).otherwise(stray.cast("boolean")))
    replace_partition(own.observe(seen, *counts), path)
    # A plan that the optimizer finds empty runs no observation: every month is empty then.
    empty = [(y, m) for y, m in months if not seen.get.get(f"y{y}m{m}")]
    for year, month in empty:
        (df.drop(*MONTH_KEYS).limit(0).write.mode("overwrite")
         .option("partitionOverwriteMode", "static")
         .parquet(f"{path}/year={year}/month={month}"))


def delete_then_append_month(df: DataFrame, path: str, year: int, month: int) -> None:
    """Load one month into a table: its old rows go, the new ones come, a missing table is created.

    Column names are matched in any case, as the table may store them in upper case.
    """
    lowered = df.toDF(*(c.lower() for c in df.columns))
    replace_months(lowered, path, [(year, month)])


def replaced_rows(target: DataFrame, updates: DataFrame, key: str, same_time: str | None) -> DataFrame:
    """Key and month of the target rows that ``updates`` replaces."""
    if same_time:
        # The span of the updates' times, one row, lets the scan skip files and row groups outside it.
        span = updates.agg(F.min(same_time).alias("first"), F.max(same_time).alias("last"),
                           F.count_if(F.col(same_time).isNull()).alias("without")).first()
        ts = F.col(same_time)
        inside = (ts >= F.lit(span["first"])) & (ts <= F.lit(span["last"])) if span["first"] is not None else F.lit(False)
        target = target.where(inside | ts.isNull() if span["without"] else inside)
    return target.select(key, *MONTH_KEYS).join(updates.select(key), key, "left_semi")


def _checked_updates(staged: DataFrame, key: str) -> None:
    """Raise before anything is written where a MERGE would, and where a row has no month to go to."""
    if not staged.where(F.col("year").isNull() | F.col("month").isNull()).isEmpty():
        raise ValueError("updates hold rows without a year or month")
    suspects = repeated_hashes(staged, key)
    if suspects.isEmpty():
        return
    alike = staged.select(key).join(suspects, F.xxhash64(key) == F.col("_hash"), "left_semi")
    twice = alike.groupBy(key).count().where("count > 1").first()
    if twice:
        raise ValueError(f"updates hold the key {twice[key]} {twice['count']} times")


def merge_upsert(spark: SparkSession, updates: DataFrame, path: str, key: str = "trip_sk",
                 same_time: str | None = "pickup_datetime",
                 layout: Callable[[DataFrame], DataFrame] = by_month,
                 overlapping: Callable[[DataFrame], list[Month]] | None = None) -> list[Month]:
    """Insert new keys, replace known ones; the first call builds the table. Returns months rewritten.

    Only months that gain rows or lose a replaced row are rewritten. To find them, keys are compared
    in the time span of the updates only: ``same_time`` is a time that rows of one key share, as a trip's
    key is made from it; None if the key has no such column. ``overlapping`` may name, for the updates, the months of the table
    that can hold such a time, from an index; only their folders are opened then. Rows that vanished upstream stay in the
    table; ``replace_months`` is the writer that removes them. Updates that repeat a key, or have no
    month, raise before anything is written.
    """
    # Updates are read several times below; written once, they are not computed again.
    staged_at = scratch_dir(spark, "merge")
    try:
        updates.write.parquet(staged_at)
        staged = spark.read.schema(updates.schema).parquet(staged_at)
        _checked_updates(staged, key)
        months = months_of(staged)
        target = read_table(spark, path)
        if target is None:
            replace_partition(layout(staged), path)
            return months
        probed = target.where(in_months(overlapping(staged))) if overlapping else target
        months = sorted(set(months) | set(months_of(replaced_rows(probed, staged, key, same_time))))
        if months:
            kept = target.where(in_months(months)).join(staged.select(key), key, "left_anti")
            replace_months(layout(kept.unionByName(staged)), path, months)
        return months
    finally:
        remove_folder(spark, staged_at)


def clustered(trips: DataFrame) -> DataFrame:
    """Order fact rows by pickup time, so that a file covers a short span and a predicate on time opens few files.

    Rows are cut into ranges, which adaptive execution merges with their neighbours only: a shuffle by the hash of the day would
    put days far apart into one file, whose footer then excludes nothing. Trips of one moment are cut by key.
    """
    order = [*MONTH_KEYS, "pickup_datetime", *(["trip_sk"] if "trip_sk" in trips.columns else [])]
    return trips.repartitionByRange(*order).sortWithinPartitions(*order)


def full_refresh(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def drop_schema(spark: SparkSession, name: str) -> None:
    """Drop a schema of its own, for example one made for a test run, with all its tables."""
    quoted = name.replace("`", "``")
    spark.sql(f"DROP DATABASE IF EXISTS `{quoted}` CASCADE")
