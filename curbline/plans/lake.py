"""The batch chain: raw file, bronze, silver with quarantine, gold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..operators.dedup import first_per_key
from ..operators.measures import daily_zone_agg
from ..operators.normalize import normalize_trips
from ..operators.rules import split_valid
from ..operators.sinks import by_month, replace_months, replace_partition
from ..sources.files import read_month, read_raw

Month = tuple[int, int]


@dataclass(frozen=True)
class Lake:
    """Table paths under one root."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    bronze = property(lambda self: self.path("bronze/trips"))
    quarantine = property(lambda self: self.path("quarantine/trips"))
    silver = property(lambda self: self.path("silver/trips"))
    gold_trips = property(lambda self: self.path("gold/fct_trips"))
    gold_daily = property(lambda self: self.path("gold/daily_zone_agg"))
    warehouse_trips = property(lambda self: self.path("warehouse/fct_trips_gold"))
    fct_trips = property(lambda self: self.path("marts/fct_trips"))
    dim_zones = property(lambda self: self.path("marts/dim_zones"))
    dim_date = property(lambda self: self.path("marts/dim_date"))
    states = property(lambda self: self.path("checks/states"))
    journal = property(lambda self: self.path("checks/journal"))
    run_history = property(lambda self: self.path("checks/run_history"))


def clean_trips(bronze: DataFrame) -> DataFrame:
    """Valid trips, one row each. Months never see each other's rows, as if each ran alone."""
    clean, _ = split_valid(bronze)
    return first_per_key(clean, schemas.TRIP_KEY + schemas.MONTH_KEYS)


def ingest_bronze(spark: SparkSession, lake: Lake, raw_path: str, year: int, month: int) -> None:
    trips = normalize_trips(read_raw(spark, raw_path), year, month)
    replace_months(trips, lake.bronze, [(year, month)])


def build_silver(spark: SparkSession, lake: Lake, year: int, month: int) -> dict[str, float]:
    """Write clean trips and rejects of a month; returns the run metrics.

    The counts come from the Parquet footers of the two tables, after the writes.
    """
    bronze = read_month(spark, lake.bronze, year, month, schemas.BRONZE)
    _, rejects = split_valid(bronze)
    replace_months(rejects, lake.quarantine, [(year, month)])
    replace_months(clean_trips(bronze), lake.silver, [(year, month)])
    total = bronze.count()
    bad = read_month(spark, lake.quarantine, year, month).count()
    return {"silver_total": total, "silver_quarantined": bad, "quarantine_pct": bad / max(total, 1)}


def build_gold(spark: SparkSession, lake: Lake, year: int, month: int) -> None:
    trips = read_month(spark, lake.silver, year, month, schemas.BRONZE)
    replace_months(trips, lake.gold_trips, [(year, month)])
    replace_months(daily_zone_agg(trips), lake.gold_daily, [(year, month)])


def ingest_many(trips: DataFrame, path: str) -> None:
    """Bronze trips of many months in one job."""
    replace_partition(by_month(trips), path)


def bad_months(spark: SparkSession, lake: Lake, limit: float) -> DataFrame:
    """Months whose share of rejects is above ``limit``, from the stored tables."""
    rejects = (spark.read.parquet(lake.quarantine).groupBy(*schemas.MONTH_KEYS)
               .agg(F.count("*").alias("silver_quarantined")))
    totals = (spark.read.parquet(lake.bronze).groupBy(*schemas.MONTH_KEYS)
              .agg(F.count("*").alias("silver_total")))
    return (totals.join(rejects, schemas.MONTH_KEYS, "left").na.fill(0, ["silver_quarantined"])
            .where(F.col("silver_quarantined") > limit * F.col("silver_total")))
