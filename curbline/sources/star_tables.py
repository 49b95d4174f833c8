"""Trips, zones and events read from the order-line star schema.

The benchmark data holds no trips, so a line of an order stands for one trip. The mapping is
a projection of one scan, without joins: what a query costs is the cost of its own operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import TRIP_EVENT
from ..session import pin_utc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _add_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts.cast("timestamp")) + minutes.cast("bigint") * 60_000_000)


def _cents(amount: Column) -> Column:
    return F.rint(amount * 100) / 100


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip rows in the source's column names, with the file's year and month.

    NULL times, NULL zones, NULL fares, stopped clocks, negative amounts, long distances, an unknown payment code, a
    zone outside the dimension and exact copies all occur; and copies without a fare, or with an unknown payment code,
    that count a passenger less, so that by values alone they would come first.
    """
    line = _table(spark, sf_dir, "lineitem")
    order, number, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    start = (order * 37 + number * 11) % 1440
    tip = F.rint(F.col("l_discount") * 100)
    fare = _cents(F.col("l_extendedprice") - 3000)
    exact, poor, odd = order % 211 == 0, order % 223 == 0, order % 227 == 0
    copies = F.sequence(F.lit(1), F.when(exact | poor | odd, 2).otherwise(1))
    second = (F.col("_copy") == 2) & ~F.col("_exact")
    return line.select(
        F.when(order % 101 != 0, _add_minutes(F.col("l_shipdate"), start)).alias("tpep_pickup_datetime"),
        F.when(order % 103 != 0, _add_minutes(F.col("l_shipdate"), start + F.col("l_quantity") - 3))
        .alias("tpep_dropoff_datetime"),
        F.when(part % 97 != 0, F.col("l_suppkey") % 26).alias("PULocationID"),
        F.when(part % 89 != 0, part % 25).alias("DOLocationID"),
        F.when(number != 6, number).alias("passenger_count"),
        (F.col("l_quantity") * 4.5).alias("trip_distance"),
        F.when(order % 107 != 0, fare).alias("fare_amount"),
        tip.alias("tip_amount"),
        _cents(F.col("l_extendedprice") - 3100 + tip).alias("total_amount"),
        number.alias("payment_type"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        exact.alias("_exact"), poor.alias("_poor"),
        F.explode(copies).alias("_copy"),
    ).withColumns({
        "fare_amount": F.when(~(second & F.col("_poor")), F.col("fare_amount")),
        "payment_type": F.when(second & ~F.col("_poor"), 9).otherwise(F.col("payment_type")),
        "passenger_count": F.col("passenger_count") - F.when(second, 1).otherwise(0),
    }).drop("_copy", "_exact", "_poor")


def raw_trips_with_fee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips of a newer file layout: a fee column, spelled with a capital."""
    return raw_trips(spark, sf_dir).withColumn("Airport_fee", F.col("tip_amount") / 4)


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = (_table(spark, sf_dir, t) for t in ("nation", "region"))
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("n_nationkey") % 5 == 0, "Yellow Zone").otherwise("Boro Zone").alias("service_zone"))


def trip_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trip events from the event table; some carry no zone."""
    events = _table(spark, sf_dir, "events")
    return events.select(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("trip_id"),
        F.col("ts").cast("timestamp").alias("dropoff_datetime"),
        F.when(F.col("event_id") % 97 != 0, F.col("user_id") % 25).cast("int").alias("pickup_zone_id"),
        F.col("value").alias("fare_amount"),
        F.col("value").alias("total_amount"))


def contract_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events in the full contract, with pickup and production at the dropoff time; what the table lacks is NULL."""
    events = trip_events(spark, sf_dir)
    timed = events.withColumns({c: F.col("dropoff_datetime") for c in ("pickup_datetime", "event_produced_at")})
    return timed.select(*(F.col(f.name) if f.name in timed.columns else F.lit(None).cast(f.dataType).alias(f.name)
                          for f in TRIP_EVENT))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value and dropoff_datetime: the events as JSON messages, some of them damaged, by their number.

    Messages cut short, an id left out, a time that no clock shows, a fare that is a word, and empty ones.
    """
    number = F.substring("trip_id", 2, 20).cast("bigint")
    millis = {f.name: F.unix_millis(f.name) for f in TRIP_EVENT if f.dataType.typeName() == "timestamp"}
    wire = contract_events(spark, sf_dir).withColumn("_at", F.col("dropoff_datetime")).withColumn("_n", number).withColumns(millis)
    text = F.to_json(F.struct(*TRIP_EVENT.names))
    fault = F.col("_n") % 40
    value = (F.when(fault == 7, F.substring(text, 1, 40))
             .when(fault == 11, F.to_json(F.struct(*(c for c in TRIP_EVENT.names if c != "trip_id"))))
             .when(fault == 13, F.regexp_replace(text, '"dropoff_datetime":[0-9]+', '"dropoff_datetime":9200000000000000000'))
             .when(fault == 17, F.regexp_replace(text, '"fare_amount":[-0-9.E]+', '"fare_amount":"much"'))
             .when(fault == 19, F.lit("")).otherwise(text))
    return wire.select(value.alias("value"), F.col("_at").alias("dropoff_datetime"))
