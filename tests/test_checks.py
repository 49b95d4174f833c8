from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import ts
from curbline.fixed import PAYMENT_TYPES
from curbline.operators import checks
from curbline.operators.staging import stage_trips
from curbline.plans.marts import build_checks, runtime_checks

AS_OF = ts("2024-01-06 12:00:00")


def results(df):
    return {r.check: (r.status, r.observed) for r in df.collect()}


@pytest.fixture
def fct(make_trips):
    return stage_trips(make_trips({}, dict(total_amount=30.0), dict(total_amount=31.0, payment_type=2)))


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(1, "A", "x", "s"), (2, "A", "y", "s")],
                                 "zone_id int, borough string, zone_name string, service_zone string")


@pytest.fixture
def dates(spark):
    return spark.createDataFrame([(date(2024, 1, 5),)], "date_day date")


def test_clean_marts_pass_every_check(fct, zones, dates):
    build = results(build_checks(fct, zones, dates))
    assert len(build) == 11 and {s for s, _ in build.values()} == {"pass"}
    runtime = results(runtime_checks(fct, ts("2024-01-05 12:00:00")))
    assert len(runtime) == 8 and {s for s, _ in runtime.values()} == {"pass"}


def test_each_build_check_finds_its_fault(fct, zones, dates):
    broken = (fct.unionByName(fct.limit(1))
              .unionByName(fct.limit(1).withColumns({"trip_sk": F.lit(None).cast("string"), "pickup_zone_id": F.lit(99),
                                                     "payment_type": F.lit(0), "dropoff_datetime": F.col("pickup_datetime")})))
    got = results(build_checks(broken, zones.unionByName(zones), dates))
    failed = {c: o for c, (s, o) in got.items() if s == "fail"}
    assert failed == {
        "not_null(fct_trips.trip_sk)": 1.0, "unique(fct_trips.trip_sk)": 1.0, "unique(dim_zones.zone_id)": 2.0,
        "accepted_values(fct_trips.payment_type)": 1.0, "relationships(fct_trips.pickup_zone_id)": 1.0,
        "zero_duration_trips": 1.0}
    with pytest.raises(checks.CheckFailed, match="relationships"):
        checks.gate(build_checks(broken, zones, dates))


def test_nulls_pass_the_checks_that_are_not_about_nulls(spark, zones):
    rows = spark.createDataFrame([(None, None)], "payment_type int, pickup_zone_id int")
    ok = checks.all_checks(
        checks.run_checks(rows, [checks.accepted_values("payment_type", PAYMENT_TYPES, "t"),
                                 checks.invalid_percent("payment_type", PAYMENT_TYPES, 0.1)]),
        checks.relationships(rows, "pickup_zone_id", zones, "zone_id", "t"), checks.unique(rows, "payment_type", "t"))
    assert {s for s, _ in results(ok).values()} == {"pass"}


def test_metric_of_nothing_is_not_evaluated(fct):
    got = results(checks.run_checks(fct.limit(0), checks.fact_checks(AS_OF)))
    assert got["row_count(fct_trips)"] == ("fail", 0.0)
    assert got["min(fare_amount)"] == got["freshness(pickup_datetime)"] == ("not_evaluated", None)


@pytest.mark.parametrize("hours, status", [(25, "pass"), (26, "pass"), (27, "warn"), (48, "warn"), (49, "fail")])
def test_source_freshness_levels(make_trips, hours, status):
    as_of = ts("2024-02-01 00:00:00") + timedelta(hours=hours)
    got = results(checks.run_checks(make_trips({}), [checks.source_freshness(as_of)]))
    assert got["freshness(_ingested_at)"] == (status, float(hours))


@pytest.mark.parametrize("minutes, status", [(14, "pass"), (15, "fail")])
def test_live_freshness_is_strict(spark, minutes, status):
    demand = spark.createDataFrame([(AS_OF - timedelta(minutes=minutes),)], "window_end timestamp")
    assert results(checks.run_checks(demand, checks.demand_checks(AS_OF)))["freshness(window_end)"][0] == status


def test_thresholds_of_the_fact_checks(spark):
    rows = spark.createDataFrame([(ts("2024-01-06 00:00:00"), -1.0, 300, 7), (None, None, 1, 1)],
                                 "pickup_datetime timestamp, fare_amount double, trip_duration_minutes bigint, payment_type int")
    got = results(checks.run_checks(rows, checks.fact_checks(AS_OF)))
    assert got["missing_count(fare_amount)"] == ("fail", 1.0)
    assert got["min(fare_amount)"] == ("fail", -1.0)
    assert got["max(trip_duration_minutes)"] == ("fail", 300.0)
    assert got["invalid_percent(payment_type)"] == ("fail", 50.0)
    assert got["avg(fare_amount)"] == ("fail", -1.0)
    assert got["freshness(pickup_datetime)"] == ("pass", 12.0)


def test_volume_change_uses_up_to_seven_earlier_runs(spark):
    counts = [100, 100, 130, 110, 100, 100, 100, 100, 100, 50]
    history = spark.createDataFrame([("t", date(2024, 1, d + 1), n) for d, n in enumerate(counts)],
                                    "table_name string, run_at date, row_count bigint")
    got = [(r.status, r.change_pct) for r in checks.volume_change(history).orderBy("run_at").collect()]
    assert got[0] == ("not_evaluated", None) and got[1] == ("pass", 0.0) and got[2] == ("fail", 30.0)
    assert got[9][0] == "fail" and got[9][1] == abs(50 - sum(counts[2:9]) / 7) * 100 / (sum(counts[2:9]) / 7)
