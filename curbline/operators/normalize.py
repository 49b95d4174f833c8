"""Raw trip files to the bronze schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, TimestampType

# Source column, bronze column, bronze type.
RAW_COLUMNS = [
    ("tpep_pickup_datetime", "pickup_datetime", TimestampType()),
    ("tpep_dropoff_datetime", "dropoff_datetime", TimestampType()),
    ("PULocationID", "pickup_zone_id", IntegerType()),
    ("DOLocationID", "dropoff_zone_id", IntegerType()),
    ("passenger_count", "passenger_count", IntegerType()),
    ("trip_distance", "trip_distance", DoubleType()),
    ("fare_amount", "fare_amount", DoubleType()),
    ("tip_amount", "tip_amount", DoubleType()),
    ("total_amount", "total_amount", DoubleType()),
    ("payment_type", "payment_type", IntegerType()),
]


def optional_col(df: DataFrame, name: str, dtype: DataType) -> Column:
    """Column in whatever case the file spells it, or a typed NULL where the file lacks it."""
    found = next((c for c in df.columns if c.lower() == name.lower()), None)
    value = F.lit(None) if found is None else F.col(found)
    return value.try_cast(dtype).alias(name)


def normalize_trips(df: DataFrame, year: int | Column, month: int | Column,
                    ingested_at: Column | None = None) -> DataFrame:
    """Rename and cast the raw columns and stamp the month of the file.

    Year and month belong to the file, not to the trip, so a rerun replaces what the file wrote.
    A value that does not fit its type becomes NULL, for the quality rules to judge.
    """
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.select(
        *(F.col(src).try_cast(dtype).alias(name) for src, name, dtype in RAW_COLUMNS),
        optional_col(df, "airport_fee", DoubleType()),
        as_col(year).cast("int").alias("year"),
        as_col(month).cast("int").alias("month"),
        stamp.alias("_ingested_at"))


def out_of_month(trips: DataFrame) -> DataFrame:
    """Trips per file month whose pickup lies in another month."""
    pickup = F.col("pickup_datetime")
    other = (F.year(pickup) != F.col("year")) | (F.month(pickup) != F.col("month"))
    return trips.groupBy("year", "month").agg(F.count_if(other).alias("out_of_month"))
