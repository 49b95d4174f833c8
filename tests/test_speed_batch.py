"""Windowed demand and anomalies in batch form, against brute force on small inputs."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import final_plan, ts
from curbline.operators.anomalies import anomaly_feed, fare_anomalies
from curbline.operators.demand import hop_average, live_demand, recount, zone_demand

START = datetime(2024, 1, 1)
MIN = timedelta(minutes=1)


def random_rows(n, seed=1):
    rnd = random.Random(seed)
    return [(f"t{i}", START + timedelta(seconds=rnd.randrange(0, 7200)), rnd.choice([1, 1, 1, 2, None]),
             rnd.choice([5.0, 6.0, 7.5, 40.0, 90.0, None])) for i in range(n)]


def brute_windows(rows, size, slide):
    out = {}
    for _, t, zone, fare in rows:
        first = START + ((t - START) // slide) * slide
        for k in range(size // slide):
            out.setdefault((zone, first - k * slide), []).append(fare)
    return {key: (round(sum(f for f in fares if f is not None), 4) / len([f for f in fares if f is not None])
                  if any(f is not None for f in fares) else None) for key, fares in out.items()}


def brute_anomalies(rows, size, slide, factor=3.0):
    averages = brute_windows(rows, size, slide)
    return sorted((i, fare, avg) for i, t, zone, fare in rows if zone is not None and fare is not None
                  for (z, w), avg in averages.items()
                  if z == zone and w <= t < w + size and avg is not None and fare > factor * avg)


@pytest.mark.parametrize("size, slide", [(30, 5), (10, 10), (12, 4)])
def test_hop_windows_and_anomalies_equal_brute_force(make_events, size, slide):
    rows = random_rows(120)
    events = make_events(*rows)
    hops = {(r.pickup_zone_id, r.window_start): r.zone_avg_fare
            for r in hop_average(events, size * MIN, slide * MIN).collect()}
    assert hops == brute_windows(rows, size * MIN, slide * MIN)
    found = fare_anomalies(events, size * MIN, slide * MIN).collect()
    expected = brute_anomalies(rows, size * MIN, slide * MIN)
    assert sorted((r.trip_id, r.fare_amount, r.zone_avg_fare) for r in found) == expected


def test_lone_spike_shows_in_all_six_windows_unless_asked_for_once(make_events):
    quiet = [(f"q{i}", f"2024-01-01 00:{m:02d}:00", 1, 1.0) for i, m in enumerate(range(0, 60, 1))]
    events = make_events(*quiet, ("spike", "2024-01-01 00:32:30", 1, 50.0))
    rows = fare_anomalies(events).collect()
    assert [r.trip_id for r in rows] == ["spike"] * 6
    once = fare_anomalies(events, one_per_trip=True).collect()
    assert len(once) == 1 and once[0].deviation_ratio == max(r.deviation_ratio for r in rows)


def test_zero_average_gives_no_ratio(make_events):
    events = make_events(("free", "2024-01-01 00:01:00", 1, -5.0), ("paid", "2024-01-01 00:02:00", 1, 5.0))
    assert {r.deviation_ratio for r in fare_anomalies(events).collect()} == {None}


def test_window_size_must_be_a_multiple(make_events):
    with pytest.raises(ValueError):
        hop_average(make_events(("a", "2024-01-01", 1, 1.0)), 30 * MIN, 7 * MIN)


def test_demand_boundaries_and_null_zone(make_events):
    events = make_events(("a", "2024-01-01 00:04:59.999", 1, 4.0), ("b", "2024-01-01 00:05:00", 1, 6.0),
                         ("c", "2024-01-01 00:05:00", 1, None), ("d", "2024-01-01 00:05:00", None, 9.0))
    rows = zone_demand(events).orderBy("window_start").collect()
    assert [(r.window_start, r.window_end, r.trip_count, r.avg_fare, r.total_revenue) for r in rows] == [
        (ts("2024-01-01"), ts("2024-01-01 00:05:00"), 1, 4.0, 4.0),
        (ts("2024-01-01 00:05:00"), ts("2024-01-01 00:10:00"), 2, 6.0, 6.0)]


def test_recount_agrees_with_demand(make_events):
    events = make_events(*random_rows(200)).where("pickup_zone_id IS NOT NULL")
    demand = {(r.window_start, r.pickup_zone_id): r.trip_count for r in zone_demand(events).collect()}
    assert demand == {(r.window_start, r.pickup_zone_id): r.batch_count for r in recount(events).collect()}


def test_live_views(make_events):
    demand = zone_demand(make_events(*random_rows(200)))
    live = live_demand(demand, 15 * MIN).collect()
    newest = max(r.window_end for r in demand.collect())
    assert {newest - r.window_end for r in live} <= {k * 5 * MIN for k in range(3)} and live
    feed = anomaly_feed(fare_anomalies(make_events(*random_rows(200))), 3).collect()
    assert len(feed) == 3 and feed[0].dropoff_datetime >= feed[2].dropoff_datetime


def test_few_hot_panes_are_broadcast_and_events_stay_where_they_are(spark, make_events):
    plan = final_plan(fare_anomalies(make_events(*random_rows(200)))).split("== Initial Plan ==")[0]
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "BroadcastHashJoin [pickup_zone_id" in plan and "hashpartitioning" not in plan


def test_a_first_window_cut_by_the_look_back_is_no_drift(make_events):
    from curbline.operators.reconcile import reconcile
    events = make_events(*[(f"e{i}", START + timedelta(minutes=i), 1, 5.0) for i in range(60)])
    as_of = START + timedelta(minutes=32, seconds=17)
    assert reconcile(events, zone_demand(events), as_of, lookback=timedelta(minutes=20)).count() == 0


def test_hot_pane_is_split(spark, make_events):
    """One zone and pane with nearly all events: the join cuts it over several tasks, results whole."""
    quiet = make_events(*[(f"q{i}", START + timedelta(minutes=i), 2, 1.0) for i in range(300)])
    crowd = (spark.range(0, 200_000, 1, 8).select(
        F.concat(F.lit("h"), "id").alias("trip_id"), F.lit(START).alias("dropoff_datetime"),
        F.lit(1).alias("pickup_zone_id"), F.when(F.col("id") % 100 == 0, 50.0).otherwise(1.0).alias("fare_amount")))
    events = quiet.select(*crowd.columns).unionByName(crowd)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = fare_anomalies(events)
        assert "skew=true" in final_plan(found)
        assert found.groupBy("trip_id").count().where("count = 6").count() == 2000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
