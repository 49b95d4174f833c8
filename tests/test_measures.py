from datetime import date

import pytest

from conftest import final_plan
from curbline.operators import measures
from curbline.operators.dimensions import date_spine, dim_date
from curbline.operators.staging import stage_trips


def trip(day, total, zone=1, drop=2, fare=10.0, tip=1.0):
    return dict(pickup_datetime=f"{day} 10:00:00", dropoff_datetime=f"{day} 11:00:00", total_amount=total,
                pickup_zone_id=zone, dropoff_zone_id=drop, fare_amount=fare, tip_amount=tip)


@pytest.fixture
def fct(make_trips):
    return stage_trips(make_trips(
        trip("2023-01-05", 10.0), trip("2023-01-06", 11.0), trip("2024-01-05", 12.0), trip("2024-01-06", 13.0),
        trip("2024-01-07", 14.0, zone=2, drop=1), trip("2024-03-01", 15.0, zone=9, fare=0.0)))


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(1, "East", "Port", "Yellow"), (2, "West", "Hill", "Boro")],
                                 "zone_id int, borough string, zone_name string, service_zone string")


def test_year_over_year_survives_month_gaps(fct):
    rows = {r.month_start: (r.trips, r.prev_trips, r.yoy) for r in measures.trips_yoy(fct).collect()}
    assert rows == {date(2023, 1, 1): (2, None, None), date(2024, 1, 1): (3, 2, 0.5),
                    date(2024, 3, 1): (1, None, None)}


def test_measures_overall_and_without_fares(fct):
    whole = measures.measures(fct).first()
    assert (whole.trips, whole.total_revenue, whole.avg_fare, whole.tip_rate) == (6, 75.0, 50 / 6, 6 / 50)
    by_month = {r.month_start: r for r in measures.monthly_measures(fct).collect()}
    assert by_month[date(2024, 3, 1)].tip_rate is None
    trend = {r.month_start: r.total_revenue for r in measures.revenue_trend(fct).collect()}
    assert trend[date(2024, 1, 1)] == 39.0


def test_star_join_keeps_trips_without_a_zone_and_broadcasts_small_dimensions(spark, fct, zones):
    dates = dim_date(date_spine(spark, date(2023, 1, 1), date(2025, 1, 1)))
    joined = measures.star_join(fct, zones, dates)
    rows = joined.collect()
    assert len(rows) == 6 and sum(r.borough is None for r in rows) == 1
    assert next(r for r in rows if r.total_amount == 14.0).is_weekend
    assert "NestedLoop" not in final_plan(joined)


def test_service_mix_shares_add_up(fct, zones):
    rows = {r.service_zone: r for r in measures.service_mix(fct, zones).collect()}
    assert {k: r.trips for k, r in rows.items()} == {"Yellow": 4, "Boro": 1, None: 1}
    assert sum(r.trip_share for r in rows.values()) == pytest.approx(1)
    assert rows["Boro"].revenue_share == 14 / 75


def test_zones(fct, zones):
    top = {(r.direction, r.rank): (r.zone_id, r.trips) for r in measures.top_zones(fct, 1).collect()}
    assert top == {("pickup", 1): (1, 4), ("dropoff", 1): (2, 5)}
    assert {(r.pickup_zone_id, r.dropoff_zone_id): r.trips for r in measures.zone_heatmap(fct).collect()} == {
        (1, 2): 4, (2, 1): 1, (9, 2): 1}
    drill = {(r.borough, r.zone_name): (r.trips, r.avg_fare) for r in measures.borough_drilldown(fct, zones).collect()}
    assert drill == {("East", "Port"): (4, 10.0), ("West", "Hill"): (1, 10.0), (None, None): (1, 0.0)}
