"""Checks of the fact table from what is stored about each of its months.

A month's state is small: one row of partial aggregates, and rows by zone and by pickup day. Partials of months
merge (sums, least, greatest), so a check of the whole table reads the states, and a run brings only the states of the
months it wrote up to date: it reads those months and no others, however many there are.

Uniqueness needs keys. Keys that repeat inside a month are found in that month. A key is made from the pickup
time, so two months can share keys only on days that both hold: the rows by day are the sketch, and for the days of a
hit, usually the edges of a month, the keys themselves are compared. A hit counts as long as neither month was written since.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..fixed import PAYMENT_TYPES
from ..functions import exact_rest, exact_total, exact_units, ratio
from ..functions.clock import age_hours, moment
from ..schemas import FCT_TRIPS, MONTH_KEYS
from ..session import remove_folder, scratch_dir
from ..sources.files import read_month, read_table
from . import checks
from .dedup import duplicate_keys, repeated_hashes
from .sinks import Month, by_month, in_months, replace_months

NOT_NULL = ["trip_sk", "pickup_zone_id", "trip_duration_minutes", "fare_amount"]
#: Months that are read folder by folder.
FEW_MONTHS = 4
METRICS, DAYS, ZONES, REPEATED, SPANS = "metrics", "days", "zones", "repeated", "spans"
#: The partials that say where the trips of a time lie.
_SPAN = ["first_pickup", "newest", "first_dropoff", "last_dropoff"]


def _partials() -> dict[str, tuple[Column, str]]:
    """Aggregate over rows, and the function that merges it over months."""
    units = exact_units("fare_amount")
    return {
        "row_count": (F.count("*"), "sum"),
        **{f"no_{c}": (F.count_if(F.col(c).isNull()), "sum") for c in NOT_NULL},
        "odd_payment": (F.count_if(~F.col("payment_type").isin(PAYMENT_TYPES)), "sum"),
        "stopped": (F.count_if(F.col("pickup_datetime") >= F.col("dropoff_datetime")), "sum"),
        "least_fare": (F.min("fare_amount"), "min"),
        "longest": (F.max("trip_duration_minutes"), "max"),
        "fare_units": (F.sum(units), "sum"), "fare_rest": (F.sum(exact_rest("fare_amount")), "sum"), "fares": (F.count(units), "sum"),
        "newest": (F.max("pickup_datetime"), "max"),
        "first_pickup": (F.min("pickup_datetime"), "min"),
        "first_dropoff": (F.min("dropoff_datetime"), "min"), "last_dropoff": (F.max("dropoff_datetime"), "max"),
    }


def month_rows(spark: SparkSession, table: str, months: list[Month]) -> DataFrame:
    """The rows of ``months``: of a few, no other folder is listed; of many, one scan of the table whose folders are pruned."""
    if len(months) > FEW_MONTHS:
        return spark.read.schema(FCT_TRIPS).parquet(table).where(in_months(months))
    parts = [read_month(spark, table, y, m, FCT_TRIPS) for y, m in months]
    return reduce(DataFrame.unionByName, parts)


def _shared_days(days: DataFrame, months: list[Month]) -> list:
    """Other months that hold a day of ``months``, with the days they share: rows by calendar days, few."""
    own = F.array(*[F.lit(12 * y + m) for y, m in months])
    at = days.select((F.col("year") * 12 + F.col("month")).alias("at"), "day").where("day is not null")
    mine = at.where(F.array_contains(own, F.col("at"))).select("day").distinct()
    shared = at.where(~F.array_contains(own, F.col("at"))).join(mine, "day")
    return shared.groupBy("at").agg(F.min("day").alias("first"), F.max("day").alias("last"), F.collect_set("day").alias("days")).collect()


def _parts(trips: DataFrame) -> DataFrame:
    """Partials by month, pickup day and zone: rows by the calendar and the zones, from which the three states are merged."""
    return trips.groupBy(*MONTH_KEYS, F.to_date("pickup_datetime").alias("day"), "pickup_zone_id").agg(
        *(agg.alias(name) for name, (agg, _) in _partials().items()))


def _merges() -> list[Column]:
    merges = {"sum": F.sum, "min": F.min, "max": F.max}
    return [merges[how](name).alias(name) for name, (_, how) in _partials().items()]


def _repeats_of(known: DataFrame, version: str) -> DataFrame:
    """Keys that repeat inside a month, and those that several of the months written hold (a list by calendar months)."""
    at = (F.col("year") * 12 + F.col("month")).alias("at")
    inside = duplicate_keys(known, [*MONTH_KEYS, "trip_sk"]).select(
        *MONTH_KEYS, "trip_sk", F.lit(None).cast("int").alias("other"), F.lit(None).cast("string").alias("other_version"))
    across = known.select(at, "trip_sk").groupBy("trip_sk").agg(F.collect_set("at").alias("ats")).where(F.size("ats") > 1)
    across = across.select("trip_sk", "ats", F.explode("ats").alias("at")).select("trip_sk", "at", F.explode("ats").alias("other")).where("at <> other")
    return inside.unionByName(across.select(
        F.expr("cast((at - 1) div 12 as int)").alias("year"), F.expr("cast((at - 1) % 12 + 1 as int)").alias("month"), "trip_sk", "other",
        F.lit(version).alias("other_version")))


def update_spans(spark: SparkSession, table: str, states: str, months: list[Month]) -> None:
    """Bring the spans of ``months`` up to date, for a reader that opens folders and judges nothing: one pass over two times, no keys."""
    if not months:
        return
    aggregates = _partials()
    spans_of = month_rows(spark, table, months).groupBy(*MONTH_KEYS).agg(*(aggregates[name][0].alias(name) for name in _SPAN))
    replace_months(spans_of, f"{states}/{SPANS}", months)


def update_states(spark: SparkSession, table: str, states: str, months: list[Month]) -> None:
    """Bring the states of ``months`` up to date, from their rows and the days they share with other months."""
    if not months:
        return
    working = scratch_dir(spark, "states")
    try:
        _update_states(spark, table, states, months, working)
    finally:
        remove_folder(spark, working)


def _update_states(spark: SparkSession, table: str, states: str, months: list[Month], working: str) -> None:
    rows, version = month_rows(spark, table, months), uuid.uuid4().hex
    # The rows are read twice, for the partials and for the keys; both results are written once.
    _parts(rows).write.parquet(f"{working}/parts")
    parts = spark.read.parquet(f"{working}/parts")
    replace_months(parts.groupBy(*MONTH_KEYS).agg(*_merges()).withColumn("version", F.lit(version)), f"{states}/{METRICS}", months)
    for by, state in (("day", DAYS), ("pickup_zone_id", ZONES)):
        replace_months(by_month(parts.groupBy(*MONTH_KEYS, by).agg(F.sum("row_count").alias("row_count"))), f"{states}/{state}", months)
    known = rows.where(F.col("trip_sk").isNotNull())
    repeated_hashes(known, "trip_sk").write.parquet(f"{working}/suspects")
    suspects = spark.read.schema("_hash bigint").parquet(f"{working}/suspects")
    found = []
    if not suspects.isEmpty():
        found.append(_repeats_of(known.join(suspects, F.xxhash64("trip_sk") == F.col("_hash"), "left_semi"), version))
    versions = spark.read.parquet(f"{states}/{METRICS}").select((F.col("year") * 12 + F.col("month")).alias("other"), F.col("version").alias("other_version"))
    for hit in _shared_days(spark.read.parquet(f"{states}/{DAYS}"), months):
        year, month = (hit["at"] - 1) // 12, (hit["at"] - 1) % 12 + 1
        day = F.to_date("pickup_datetime")
        # The span of the days reaches the file scan; the days themselves are a short list.
        span = (F.col("pickup_datetime") >= F.lit(hit["first"]).cast("timestamp")) & (F.col("pickup_datetime") < F.date_add(F.lit(hit["last"]), 1).cast("timestamp"))
        theirs = read_month(spark, table, year, month, FCT_TRIPS).where(span & day.isin(hit["days"])).select("trip_sk")
        mine = known.where(day.isin(hit["days"])).select(*MONTH_KEYS, "trip_sk").join(theirs, "trip_sk", "left_semi")
        found.append(mine.withColumn("other", F.lit(hit["at"])).join(versions, "other", "left").select(*MONTH_KEYS, "trip_sk", "other", "other_version"))
    # Hits name the versions of both months, so those of months since written again count for nothing and may stay.
    repeats = reduce(DataFrame.unionByName, found) if found else None
    if repeats is not None and not repeats.isEmpty():
        repeats.distinct().withColumn("version", F.lit(version)).write.mode("append").parquet(f"{states}/{REPEATED}")


def merged(spark: SparkSession, states: str) -> DataFrame:
    """One row: the partials of all months together, and how many keys repeat."""
    metrics = spark.read.parquet(f"{states}/{METRICS}")
    own = metrics.select((F.col("year") * 12 + F.col("month")).alias("at"), F.col("version").alias("current"))
    repeated = read_table(spark, f"{states}/{REPEATED}")
    keys = F.lit(0).cast("bigint").alias("repeated")
    if repeated is None:
        counted = spark.range(1).select(keys)
    else:
        # A hit holds while both months are as they were; written again, a month has looked for itself.
        repeated = repeated.withColumn("at", F.col("year") * 12 + F.col("month")).join(own, "at").where(F.col("version") == F.col("current")).drop("at", "current")
        live = repeated.join(own.select(F.col("at").alias("other"), "current"), "other", "left").where(
            F.col("other").isNull() | (F.col("other_version") == F.col("current")))
        counted = live.agg(F.count_distinct("trip_sk").alias("repeated"))
    whole = metrics.agg(*_merges())
    return whole.withColumn("_one", F.lit(1)).join(counted.withColumn("_one", F.lit(1)), "_one").drop("_one")


def _observed(as_of: datetime | Column | None) -> dict[str, Column]:
    """What each check of the fact table observes, from merged partials."""
    found = {f"not_null(fct_trips.{c})": F.col(f"no_{c}") for c in NOT_NULL}
    rows = F.coalesce("row_count", F.lit(0))
    return found | {
        "accepted_values(fct_trips.payment_type)": F.col("odd_payment"), "zero_duration_trips": F.col("stopped"),
        "row_count(fct_trips)": rows, "missing_count(fare_amount)": F.col("no_fare_amount"), "min(fare_amount)": F.col("least_fare"),
        "max(trip_duration_minutes)": F.col("longest"),
        "invalid_percent(payment_type)": ratio(F.col("odd_payment") * F.lit(100.0), rows),
        "avg(fare_amount)": ratio(exact_total("fare_units", "fare_rest"), F.col("fares")),
        "unique(fct_trips.trip_sk)": F.col("repeated"), "duplicate_count(trip_sk)": F.col("repeated"),
    } | ({} if as_of is None else {"freshness(pickup_datetime)": age_hours(F.col("newest"), moment(as_of))})


def key_checks() -> list[checks.Check]:
    """The two checks of keys; their metrics are in the merged states."""
    return [checks.Check(name, lambda: F.lit(None), lambda c: c == 0, "= 0") for name in ("unique(fct_trips.trip_sk)", "duplicate_count(trip_sk)")]


def judged(spark: SparkSession, states: str, wanted: list[checks.Check], as_of: datetime | Column | None = None) -> DataFrame:
    """Verdicts of ``wanted`` on the whole table, from the states alone."""
    observed = _observed(as_of)
    rows = merged(spark, states)
    return rows.select(F.inline(F.array(*[checks.verdict(c, observed[c.name].cast("double")) for c in wanted])))


def known_zones(spark: SparkSession, states: str, zones: DataFrame) -> DataFrame:
    """The relationship of the fact table's zones to the dimension, from the rows by zone."""
    rows = spark.read.parquet(f"{states}/{ZONES}").where(F.col("pickup_zone_id").isNotNull())
    orphans = rows.join(zones.select(F.col("zone_id").alias("pickup_zone_id")), "pickup_zone_id", "left_anti")
    check = checks.Check("relationships(fct_trips.pickup_zone_id)", lambda: F.coalesce(F.sum("row_count"), F.lit(0)), lambda c: c == 0, "= 0")
    return checks.run_checks(orphans, [check])


def spans(spark: SparkSession, states: str, state: str = METRICS) -> DataFrame:
    """year, month and the first and last pickup and dropoff in each month's folder, whatever month the trips are of.

    From the metrics of ``update_states``, or with ``state`` SPANS from what ``update_spans`` keeps.
    """
    return spark.read.parquet(f"{states}/{state}").select(
        *MONTH_KEYS, "first_pickup", F.col("newest").alias("last_pickup"), "first_dropoff", "last_dropoff")


def months_where(months: DataFrame, condition: Column) -> list[Month]:
    """Months of ``spans`` for which ``condition`` holds, or may hold where a span is unknown. A row per calendar month."""
    return sorted((r.year, r.month) for r in months.where(F.coalesce(condition, F.lit(True))).select(*MONTH_KEYS).collect())

