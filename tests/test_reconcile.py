from datetime import timedelta

import pytest

from conftest import final_plan, ts
from curbline.operators.demand import zone_demand
from curbline.operators.events import to_events
from curbline.operators.reconcile import DriftError, assert_reconciled, reconcile, worst_drifts
from curbline.operators.staging import stage_trips

AS_OF = ts("2024-01-06 10:00:00")


def as_raw(trips):
    return trips.withColumnsRenamed({
        "pickup_datetime": "tpep_pickup_datetime", "dropoff_datetime": "tpep_dropoff_datetime",
        "pickup_zone_id": "PULocationID", "dropoff_zone_id": "DOLocationID"})


def drifts(trips, **kw):
    kw.setdefault("as_of", AS_OF)
    return reconcile(stage_trips(trips), zone_demand(to_events(as_raw(trips))), **kw)


def test_layers_that_agree_give_no_rows(make_trips):
    same = drifts(make_trips({}, dict(total_amount=30.0)))
    assert same.count() == 0
    assert_reconciled(same)


def test_drift_is_reported_with_both_counts(make_trips):
    """The stream keeps copies and negative fares, the batch does not."""
    trips = make_trips({}, {}, dict(pickup_zone_id=3, fare_amount=-2.0))
    rows = {r.zone_id: (r.batch_count, r.speed_count, r.rel_diff) for r in drifts(trips).collect()}
    assert rows == {1: (1, 2, 0.5), 3: (0, 1, 1.0)}
    with pytest.raises(DriftError, match="zone 3: batch 0, speed 1, difference 100.00%"):
        assert_reconciled(drifts(trips))


def test_with_shared_validity_only_copies_differ(make_trips):
    from curbline.operators.events import batch_grade
    trips = make_trips({}, {}, dict(pickup_zone_id=3, fare_amount=-2.0), dict(pickup_zone_id=4, payment_type=0))
    speed = zone_demand(batch_grade(to_events(as_raw(trips))))
    assert [r.zone_id for r in reconcile(stage_trips(trips), speed, AS_OF).collect()] == [1]


def test_tolerance_is_strict_and_only_the_lookback_counts(make_trips):
    trips = make_trips({}, {})
    assert drifts(trips, tolerance=0.5).count() == 0
    assert drifts(trips, tolerance=0.49).count() == 1
    assert drifts(trips, as_of=AS_OF + timedelta(days=2)).count() == 0
    assert drifts(trips, as_of=AS_OF + timedelta(days=2), lookback=timedelta(days=4)).count() == 1


def test_batch_only_windows_count_too(make_trips):
    trips = stage_trips(make_trips({}))
    empty = zone_demand(to_events(as_raw(make_trips({})))).limit(0)
    assert [(r.batch_count, r.speed_count) for r in reconcile(trips, empty, AS_OF).collect()] == [(1, 0)]


def test_worst_first_without_a_full_sort(make_trips):
    trips = make_trips({}, {}, dict(pickup_zone_id=3, fare_amount=-2.0))
    top = worst_drifts(drifts(trips), 1)
    assert [r.zone_id for r in top.collect()] == [3]
    assert "TakeOrderedAndProject" in final_plan(top)
