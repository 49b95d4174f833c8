"""Skew: one key with most rows must not end in one task, and no row may be lost for it."""

from contextlib import contextmanager
from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, ts
from curbline.operators import measures, sinks
from curbline.operators.dimensions import date_spine, dim_date
from curbline.session import scratch_dir, shuffle_settings


@contextmanager
def settings(spark, **conf):
    conf = {f"spark.sql.{k.replace('__', '.')}": v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_splits(spark, **more):
    return settings(spark, adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB",
                    adaptive__advisoryPartitionSizeInBytes="100KB", shuffle__partitions="16", **more)


@pytest.fixture
def crowd(spark):
    """200,000 trips of which nine in ten have the same zone, day and month."""
    hot, pickup = F.col("id") % 10 != 0, F.lit(ts("2024-01-05 10:00:00"))
    return spark.range(0, 200_000, 1, 8).select(
        pickup.alias("pickup_datetime"), F.timestamp_micros(F.unix_micros(pickup) + 1 + F.col("id")).alias("dropoff_datetime"),
        F.when(hot, 1).otherwise(F.col("id") % 50).cast("int").alias("pickup_zone_id"),
        F.lit(2).alias("dropoff_zone_id"), (F.col("id") / 100).alias("total_amount"), F.lit(1.0).alias("fare_amount"),
        F.md5(F.col("id").cast("string")).alias("trip_sk"), F.lit(2024).alias("year"),
        F.when(hot, 1).otherwise(F.col("id") % 12 + 1).cast("int").alias("month"))


def test_a_large_month_is_written_by_several_tasks(spark, crowd, tmp_path):
    path = str(tmp_path / "t")
    with small_splits(spark):
        sinks.replace_partition(sinks.by_month(crowd), path)
    files = spark.read.parquet(path).withColumn("f", F.input_file_name()).groupBy("month").agg(
        F.countDistinct("f").alias("files"), F.count("*").alias("n")).collect()
    by_month = {r.month: r.files for r in files}
    assert by_month[1] > max(v for m, v in by_month.items() if m != 1)
    assert sum(r.n for r in files) == 200_000


def test_a_busy_zone_is_split_when_the_dimension_is_too_large_to_broadcast(spark, crowd):
    zones = spark.range(60).select(F.col("id").cast("int").alias("zone_id"), F.lit("b").alias("borough"),
                                   F.lit("z").alias("zone_name"), F.lit("s").alias("service_zone"))
    dates = dim_date(date_spine(spark, date(2024, 1, 1), date(2025, 1, 1)))
    whole = measures.star_join(crowd, zones, dates)
    assert "BroadcastHashJoin" in final_plan(whole.select("trip_sk", "borough"))
    with small_splits(spark, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1"):
        keyed = crowd.withColumn("zone_id", F.col("pickup_zone_id"))
        joined = keyed.join(zones, "zone_id", "left")
        assert "skew=true" in final_plan(joined)
        assert measures.star_join(crowd, zones, dates).where("borough = 'b' AND quarter = 1").count() == 200_000


def test_dimension_joins_see_aggregated_rows(spark, crowd):
    zones = spark.range(60).select(F.col("id").cast("int").alias("zone_id"), F.lit("b").alias("borough"),
                                   F.lit("z").alias("zone_name"), F.lit("s").alias("service_zone"))
    for frame in (measures.borough_drilldown(crowd, zones),
                  measures.service_mix(crowd, zones)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        join = plan.index("Join LeftOuter")
        assert "Aggregate [pickup_zone_id" in plan[join:]


def test_shuffle_settings_grow_with_the_data():
    parts = [int(shuffle_settings(n)["spark.sql.shuffle.partitions"]) for n in (0, 1 << 40, 100 << 40)]
    assert parts == [200, 5243, 40_000]


def test_scratch_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    assert root is None or first.startswith(root)
