from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, ts
from curbline import schemas
from curbline.operators import staging
from curbline.operators.dedup import first_per_key
from curbline.operators.dimensions import date_spine, dim_date, dim_zones
from curbline.operators.events import event_key, in_event_order, to_events, to_wire
from curbline.operators.normalize import normalize_trips
from curbline.operators.rules import REASON, split_valid, tag_rejects
from curbline.sources import model, named_source, read_gold_for_load, read_month, read_zone_lookup, register_view

RAW = ("tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID bigint,"
       " DOLocationID bigint, passenger_count double, trip_distance double, fare_amount double,"
       " tip_amount double, total_amount double, payment_type bigint")


def raw_row(**changes):
    row = dict(a=ts("2024-01-05 10:00:00"), b=ts("2024-01-05 10:20:00"), c=1, d=2, e=1.0, f=3.0, g=15.0,
               h=2.0, i=20.0, j=1)
    row.update(changes)
    return tuple(row.values())


def test_normalize_gives_the_bronze_schema(spark):
    out = normalize_trips(spark.createDataFrame([raw_row()], RAW), 2024, 1)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schemas.BRONZE]
    row = out.first()
    assert (row.year, row.month, row.airport_fee) == (2024, 1, None)
    assert row._ingested_at is not None


def test_optional_column_is_found_in_any_case(spark):
    raw = spark.createDataFrame([raw_row()], RAW).withColumn("Airport_Fee", F.lit(1.25))
    assert normalize_trips(raw, 2024, 1).first().airport_fee == 1.25


def test_value_that_does_not_fit_becomes_null(spark):
    raw = spark.createDataFrame([raw_row(e=float("nan"))], RAW)
    assert normalize_trips(raw, 2024, 1).first().passenger_count is None


@pytest.mark.parametrize("row, reason", [
    (dict(pickup_datetime=None), "null_pickup"),
    (dict(pickup_datetime=None, dropoff_datetime=None, fare_amount=-1.0), "null_pickup"),
    (dict(dropoff_datetime=None, fare_amount=-1.0), "null_dropoff"),
    (dict(dropoff_datetime="2024-01-05 10:00:00"), "zero_or_negative_duration"),
    (dict(dropoff_datetime="2024-01-05 09:00:00", fare_amount=-1.0), "zero_or_negative_duration"),
    (dict(fare_amount=-0.01, trip_distance=500.0), "negative_fare"),
    (dict(trip_distance=200.1), "absurd_distance"),
    (dict(trip_distance=200.0), None),
    (dict(fare_amount=None), None),
    (dict(fare_amount=None, trip_distance=201.0), "absurd_distance"),
    (dict(trip_distance=None), None),
    (dict(total_amount=-5.0, payment_type=0, pickup_zone_id=None), None),
])
def test_first_matching_rule_names_the_reject(make_trips, row, reason):
    assert tag_rejects(make_trips(row)).first()[REASON] == reason


def test_split_loses_no_row(make_trips):
    rows = make_trips({}, dict(fare_amount=-1.0), dict(fare_amount=None), dict(pickup_datetime=None))
    clean, bad = split_valid(rows)
    assert (clean.count(), bad.count()) == (2, 2)
    assert clean.columns == schemas.BRONZE.names


@pytest.mark.parametrize("row, reason", [
    (dict(dropoff_datetime="2024-01-05 10:00:00"), "duration_not_positive"),
    (dict(fare_amount=None), "fare_missing_or_negative"),
    (dict(total_amount=-0.01), "total_missing_or_negative"),
    (dict(payment_type=0), "payment_type_unknown"),
    (dict(payment_type=7), "payment_type_unknown"),
    (dict(payment_type=None), "payment_type_unknown"),
    (dict(pickup_zone_id=None), "pickup_zone_missing"),
    (dict(dropoff_zone_id=None), "dropoff_zone_missing"),
])
def test_gate_drops_with_a_reason(make_trips, row, reason):
    rows = make_trips({}, row)
    assert staging.trip_gate(rows).count() == 1
    assert [r[staging.GATE_REASON] for r in staging.gate_rejects(rows).collect()] == [reason]


def test_loss_adds_up(make_trips):
    rows = make_trips({}, {}, {}, dict(fare_amount=None), dict(payment_type=9))
    loss = {r.reason: r.rows for r in staging.staging_loss(rows).collect()}
    assert loss == {"duplicate": 2, "fare_missing_or_negative": 1, "payment_type_unknown": 1}
    assert staging.stage_trips(rows).count() == rows.count() - sum(loss.values())


def test_survivor_is_the_smallest_complete_row_whatever_the_order(make_trips):
    rows = [dict(passenger_count=n, tip_amount=t) for n, t in ((3, 1.0), (2, 9.0), (2, 4.0), (None, 7.0))]
    for order in (rows, rows[::-1]):
        kept = first_per_key(make_trips(*order).repartition(4), schemas.TRIP_KEY).collect()
        assert [(r.passenger_count, r.tip_amount) for r in kept] == [(2, 4.0)]


def test_a_valid_copy_always_reaches_the_fact_table(make_trips):
    rows = make_trips(dict(fare_amount=None), {}, dict(tip_amount=None))
    assert [r.fare_amount for r in staging.stage_trips(first_per_key(rows, schemas.TRIP_KEY)).collect()] == [15.0]
    # Copies that also differ in a column before: by values alone the first would win, and the trip would be gone.
    for poor in (dict(passenger_count=1, fare_amount=None), dict(passenger_count=1, payment_type=9), dict(passenger_count=1, payment_type=None)):
        rows = make_trips(poor, dict(passenger_count=2, tip_amount=None))
        assert [r.passenger_count for r in staging.stage_trips(first_per_key(rows, schemas.TRIP_KEY)).collect()] == [2]


def test_null_keys_group_like_values(make_trips):
    assert first_per_key(make_trips(*[dict(pickup_zone_id=None)] * 3), schemas.TRIP_KEY).count() == 1


def test_copies_are_dropped_before_the_shuffle(spark, make_trips):
    """One key holding most rows reaches the shuffle as one row per task."""
    plan = final_plan(first_per_key(make_trips(*[{}] * 500, *[dict(total_amount=float(i)) for i in range(50)]),
                                    schemas.TRIP_KEY))
    assert "Window" not in plan and plan.count("partial_min") >= 1
    hot = make_trips({}).crossJoin(spark.range(0, 40_000, 1, 8)).drop("id")
    out = first_per_key(hot, schemas.TRIP_KEY)
    final_plan(out)
    shuffled = _shuffle_records(out)
    assert out.count() == 1 and 0 < shuffled <= 8


def _shuffle_records(df):
    """Rows the query's exchanges wrote."""
    plan = df._jdf.queryExecution().executedPlan()
    stage = plan.finalPhysicalPlan() if hasattr(plan, "finalPhysicalPlan") else plan
    total, todo = 0, [stage]
    while todo:
        node = todo.pop()
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_staged_trip(make_trips):
    row = staging.stage_trips(make_trips(dict(dropoff_datetime="2024-01-05 10:20:59"))).first()
    assert row.trip_duration_minutes == 20 and len(row.trip_sk) == 32
    assert list(row.asDict()) == schemas.FCT_TRIPS.names


def test_month_filter_reads_one_partition(spark, make_trips, tmp_path):
    path = str(tmp_path / "t")
    trips = make_trips({}, dict(month=2), dict(year=2023))
    trips.write.partitionBy("year", "month").parquet(path)
    one_month = staging.stage_month(spark.read.parquet(path), date(2024, 2, 1))
    plan = final_plan(one_month)
    assert "PartitionFilters: [isnotnull(year" in plan and one_month.count() == 1
    gate = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(fare_amount,0.0)" in gate and "In(payment_type" in gate
    assert "airport_fee" not in gate.split("ReadSchema")[1]


def test_month_scan_and_upper_case_load(spark, make_trips, tmp_path):
    path = str(tmp_path / "t")
    make_trips({}, dict(month=2)).write.partitionBy("year", "month").parquet(path)
    assert read_month(spark, path, 2024, 2).count() == 1
    loaded = read_gold_for_load(spark, path, 2024, 1)
    assert loaded.columns == [c.upper() for c in read_month(spark, path, 2024, 1).columns]
    assert loaded.first().YEAR == 2024


def test_zone_csv_keeps_na_as_text(spark, tmp_path):
    csv = tmp_path / "zones.csv"
    csv.write_text('"LocationID","Borough","Zone","service_zone"\n1,"East","Old, Port","Boro Zone"\n'
                   '2,"Unknown","N/A","N/A"\n')
    rows = dim_zones(read_zone_lookup(spark, str(csv))).orderBy("zone_id").collect()
    assert [tuple(r) for r in rows] == [(1, "East", "Old, Port", "Boro Zone"), (2, "Unknown", "N/A", "N/A")]


def test_date_dimension(spark):
    days = dim_date(date_spine(spark, date(2024, 1, 1), date(2025, 1, 1)))
    by_day = {r.date_day: r for r in days.collect()}
    assert len(by_day) == 366 and max(by_day) == date(2024, 12, 31)
    new_year, monday = by_day[date(2024, 1, 1)], by_day[date(2024, 12, 30)]
    assert (new_year.day_of_week, new_year.day_name, new_year.month_name, new_year.is_weekend) == (1, "Mon", "Jan", False)
    assert monday.week_of_year == 1 and by_day[date(2024, 6, 9)].is_weekend
    assert date_spine(spark, date(2024, 1, 1), date(2024, 1, 1)).count() == 0


def test_events_are_sane_and_ids_repeat(spark):
    rows = [raw_row(), raw_row(a=None), raw_row(b=None), raw_row(b=ts("2024-01-05 10:00:00")),
            raw_row(g=-3.0), raw_row(f=float("nan"))]
    first, second = (to_events(spark.createDataFrame(rows, RAW)) for _ in range(2))
    got = first.orderBy("fare_amount").collect()
    assert [r.fare_amount for r in got] == [-3.0, 15.0, 15.0]
    assert sorted(r.trip_id for r in got) == sorted(r.trip_id for r in second.collect())
    assert any(r.trip_distance is None for r in got)


def test_event_key_and_wire_times(make_events):
    events = make_events(("a", "2024-01-01 00:00:01.5", 7, 1.0), ("b", "2024-01-01", None, 1.0),
                         ("c", "2024-01-01", 0, 1.0))
    rows = {r.trip_id: r for r in to_wire(events).collect()}
    assert [rows[k].event_key for k in "abc"] == ["7", "0", "0"]
    assert rows["a"].dropoff_datetime == 1704067201500
    assert event_key() is not None


def test_event_order_splits_a_hot_time_stamp(spark, make_events):
    hot = make_events(("x", "2024-01-01", 1, 1.0)).crossJoin(spark.range(0, 4000, 1, 4)).drop("id")
    ordered = in_event_order(hot)
    sizes = [r["n"] for r in ordered.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 4000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = ordered.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) > 1 and max(r["count"] for r in parts) < 4000


def test_named_sources(spark, make_trips):
    register_view(make_trips({}), "trips", group="lake")
    register_view(make_trips({}, {}), "stg")
    assert named_source(spark, "lake", "trips").count() == 1
    assert model(spark, "stg").count() == 2
