"""Data-quality checks: rows of (check, status, observed, threshold).

All plain metrics of a table come from one aggregation over it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import fixed
from ..functions import exact_avg, ratio
from ..functions.clock import age_hours, moment
from .dedup import duplicate_keys


class CheckFailed(RuntimeError):
    """A gate found failing checks."""


@dataclass(frozen=True)
class Check:
    """A metric of a table and what it must meet.

    ``metric`` is an aggregate giving a number; ``passes`` and ``warns`` judge it. A metric of
    nothing (NULL) is not evaluated.
    """

    name: str
    metric: Callable[[], Column]
    passes: Callable[[Column], Column]
    threshold: str
    warns: Callable[[Column], Column] | None = None


def verdict(check: Check, observed: Column) -> Column:
    """The row of a check, as a struct."""
    status = F.when(observed.isNull(), "not_evaluated").when(check.passes(observed), "pass")
    if check.warns:
        status = status.when(check.warns(observed), "warn")
    return F.struct(F.lit(check.name).alias("check"), status.otherwise("fail").alias("status"),
                    observed.alias("observed"), F.lit(check.threshold).alias("threshold"))


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    metrics = df.agg(*(c.metric().cast("double").alias(f"m{i}") for i, c in enumerate(checks)))
    verdicts = [verdict(c, F.col(f"m{i}")) for i, c in enumerate(checks)]
    return metrics.select(F.inline(F.array(*verdicts)))


def all_checks(*results: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def gate(results: DataFrame) -> None:
    """Stop a run on failing checks. Collects one row per failing check."""
    failed = results.where(F.col("status") == "fail").collect()
    if failed:
        raise CheckFailed("; ".join(f"{r.check}: {r.observed} (wanted {r.threshold})" for r in failed))


def _zero(c: Column) -> Column:
    return c == 0


def not_null(column: str, table: str) -> Check:
    return Check(f"not_null({table}.{column})", lambda: F.count_if(F.col(column).isNull()), _zero, "= 0")


def accepted_values(column: str, values: list, table: str) -> Check:
    """Rows outside the list; NULL passes."""
    return Check(f"accepted_values({table}.{column})",
                 lambda: F.count_if(~F.col(column).isin(values)), _zero, "= 0")


def row_count(table: str) -> Check:
    return Check(f"row_count({table})", lambda: F.count("*"), lambda c: c > 0, "> 0")


def missing_count(column: str) -> Check:
    return Check(f"missing_count({column})", lambda: F.count_if(F.col(column).isNull()), _zero, "= 0")


def min_at_least(column: str, floor: float) -> Check:
    return Check(f"min({column})", lambda: F.min(column), lambda c: c >= floor, f">= {floor:g}")


def max_below(column: str, limit: float) -> Check:
    return Check(f"max({column})", lambda: F.max(column), lambda c: c < limit, f"< {limit:g}")


def avg_between(column: str, low: float, high: float) -> Check:
    return Check(f"avg({column})", lambda: exact_avg(column), lambda c: c.between(low, high),
                 f"between {low:g} and {high:g}")


def invalid_percent(column: str, values: list, limit: float) -> Check:
    """Percent of rows outside the list; NULL is missing, not invalid."""
    share = lambda: ratio(F.count_if(~F.col(column).isin(values)) * F.lit(100.0), F.count("*"))
    return Check(f"invalid_percent({column})", share, lambda c: c < limit, f"< {limit:g}%")


def freshness(column: str, as_of: datetime | Column, limit: timedelta,
              warn_after: timedelta | None = None) -> Check:
    """Age of the newest row in hours, seen from ``as_of``.

    Fails from ``limit`` on. With ``warn_after`` ages above it and up to ``limit`` warn.
    """
    now = moment(as_of)
    hours = limit / timedelta(hours=1)
    metric = lambda: age_hours(F.max(column), now)
    if warn_after is None:
        return Check(f"freshness({column})", metric, lambda c: c < hours, f"< {hours:g}h")
    warn_hours = warn_after / timedelta(hours=1)
    return Check(f"freshness({column})", metric, lambda c: c <= warn_hours,
                 f"warn > {warn_hours:g}h, error > {hours:g}h", warns=lambda c: c <= hours)


def source_freshness(as_of: datetime | Column, column: str = "_ingested_at") -> Check:
    return freshness(column, as_of, fixed.SOURCE_ERROR_AFTER, warn_after=fixed.SOURCE_WARN_AFTER)


# Checks with a shuffle of their own: each yields the same four columns.

def unique(df: DataFrame, column: str, table: str) -> DataFrame:
    """Values that occur more than once; NULL counts as no value."""
    repeated = duplicate_keys(df.where(F.col(column).isNotNull()), [column])
    return run_checks(repeated, [Check(f"unique({table}.{column})", lambda: F.count("*"), _zero, "= 0")])


def duplicate_count(df: DataFrame, column: str) -> DataFrame:
    repeated = duplicate_keys(df.where(F.col(column).isNotNull()), [column])
    return run_checks(repeated, [Check(f"duplicate_count({column})", lambda: F.count("*"), _zero, "= 0")])


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent, with their row counts. Children are counted before the join."""
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("child_rows"))
    known = parent.select(F.col(parent_column).alias(column))
    return keys.join(known, column, "left_anti")


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                  table: str) -> DataFrame:
    check = Check(f"relationships({table}.{column})",
                  lambda: F.coalesce(F.sum("child_rows"), F.lit(0)), _zero, "= 0")
    return run_checks(orphans(child, column, parent, parent_column), [check])


def assert_empty(rows: DataFrame, name: str) -> DataFrame:
    """A query that must give no rows."""
    return run_checks(rows, [Check(name, lambda: F.count("*"), _zero, "= 0")])


def _stopped() -> Column:
    return F.col("pickup_datetime") >= F.col("dropoff_datetime")


def zero_duration_trips(trips: DataFrame) -> DataFrame:
    """The trips that ``zero_duration`` counts."""
    return trips.where(_stopped())


def zero_duration() -> Check:
    return Check("zero_duration_trips", lambda: F.count_if(_stopped()), _zero, "= 0")


def volume_change(history: DataFrame, runs: int = fixed.VOLUME_RUNS,
                  limit: float = fixed.VOLUME_CHANGE_PERCENT) -> DataFrame:
    """Row count of each run against the average of up to ``runs`` runs before it, in percent.

    ``history`` has one row per table and run: (table_name, run_at, row_count). The first run of a
    table has nothing to compare with and is not evaluated.
    """
    before = Window.partitionBy("table_name").orderBy("run_at").rowsBetween(-runs, -1)
    total, seen = F.sum("row_count").over(before), F.count("row_count").over(before)
    change = F.abs(F.col("row_count") * seen - total) * F.lit(100.0) / F.nullif(total, F.lit(0))
    status = (F.when(F.col("change_pct").isNull(), "not_evaluated")
              .when(F.col("change_pct") < limit, "pass").otherwise("fail"))
    return history.withColumn("change_pct", change).withColumn("status", status)


def fact_checks(as_of: datetime | Column) -> list[Check]:
    """Runtime checks of the fact table."""
    return [
        freshness("pickup_datetime", as_of, fixed.FACT_FRESHNESS),
        row_count("fct_trips"),
        missing_count("fare_amount"),
        min_at_least("fare_amount", 0),
        max_below("trip_duration_minutes", fixed.MAX_TRIP_MINUTES),
        invalid_percent("payment_type", fixed.PAYMENT_TYPES, fixed.MAX_INVALID_PERCENT),
        avg_between("fare_amount", *fixed.AVERAGE_FARE),
    ]


def demand_checks(as_of: datetime | Column) -> list[Check]:
    """Runtime checks of the live demand table."""
    return [freshness("window_end", as_of, fixed.LIVE_FRESHNESS), row_count("rt_zone_demand")]
