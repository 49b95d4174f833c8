from datetime import timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import ts
from curbline.functions.clock import moment
from curbline.functions import exact_avg, exact_sum, minute_boundaries, slice_start, surrogate_key


def one(spark, **cols):
    row = spark.range(1).select(*(c.alias(n) for n, c in cols.items())).first()
    return row[0] if len(cols) == 1 else row


@pytest.mark.parametrize("start, end, minutes", [
    ("2024-01-01 00:00:59", "2024-01-01 00:01:01", 1),
    ("2024-01-01 00:00:00", "2024-01-01 00:00:59", 0),
    ("2024-01-01 00:10:00", "2024-01-01 00:00:30", -10),
    ("1969-12-31 23:59:30", "1970-01-01 00:00:30", 1),
])
def test_minutes_count_boundaries(spark, start, end, minutes):
    assert one(spark, m=minute_boundaries(F.lit(ts(start)), F.lit(ts(end)))) == minutes


def test_slices_are_epoch_aligned_before_1970_too(spark):
    five = timedelta(minutes=5)
    assert one(spark, s=slice_start(F.lit(ts("2024-01-01 00:04:59.999999")), five)) == ts("2024-01-01")
    assert one(spark, s=slice_start(F.lit(ts("1969-12-31 23:59:00")), five)) == ts("1969-12-31 23:55:00")


@settings(max_examples=20, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-10**9, 10**9)), min_size=1, max_size=40))
def test_sums_are_exact_and_independent_of_order(spark, cents):
    rows = [(None if c is None else c / 100,) for c in cents]
    known = [c for c in cents if c is not None]
    for order in (rows, rows[::-1]):
        got = (spark.createDataFrame(order, "x double").repartition(3)
               .agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first())
        assert got.s == (sum(known) / 100 if known else None)
        assert got.a == (sum(known) / 100 / len(known) if known else None)


@pytest.mark.parametrize("cents", [
    [1, 154_818_537], [-1, -154_818_537], [90_000_001, -90_000_000, 1], [10 ** 9, 10 ** 9 - 1, 7], [3] * 5 + [13_743_895_347_199, -13_743_895_347_100],
    [999_999_999] * 40])
def test_large_amounts_are_summed_to_the_cent(spark, cents):
    for order in (cents, cents[::-1]):
        got = spark.createDataFrame([(c / 100,) for c in order], "x double").repartition(3).agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
        assert (got.s, got.a) == (sum(cents) / 100, sum(cents) / 100 / len(cents))


def test_sums_beyond_the_count_do_not_raise(spark):
    from curbline.functions import exact_total
    full = 9_223_372_036_854_775_000
    assert one(spark, t=exact_total(F.lit(full), F.lit(2.0 ** 40))) == pytest.approx(full / 1e4 + 2.0 ** 40)


def test_a_time_without_zone_is_utc_wherever_the_driver_runs(spark, monkeypatch):
    from datetime import datetime, timezone
    import time
    for zone in ("UTC", "America/New_York"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        try:
            for t in (datetime(2024, 1, 1), datetime(2024, 1, 1, tzinfo=timezone.utc)):
                assert one(spark, s=F.unix_seconds(moment(t))) == 1704067200
        finally:
            monkeypatch.undo()
            time.tzset()


def test_nan_is_no_amount(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "x double")
    got = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    assert (got.s, got.a) == (1.5, 1.5)


@pytest.mark.parametrize("amounts, total", [
    ([9e14, 9e14], 1.8e15), ([1e15, 20.5], 1e15 + 20.5), ([float("inf"), 1.0], float("inf")),
    ([0.00004] * 3, 0.00004 * 3), ([-1e300, 1e300, 0.25], 0.25)])
def test_no_amount_is_cut_or_raises(spark, amounts, total):
    got = spark.createDataFrame([(a,) for a in amounts], "x double").coalesce(1).agg(
        exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    assert got.s == pytest.approx(total) and got.a == pytest.approx(total / len(amounts))


def test_different_totals_never_share_a_trip_key(spark):
    from curbline.functions import trip_key
    totals = [12.0, 12.00001, 12.00002, 12.0001, 120000.0, float("inf"), float("nan"), 1e15, None]
    t = ts("2024-01-01 00:00:00")
    rows = [(t, t, 1, 2, x) for x in [*totals, -0.0, 0.0]]
    frame = spark.createDataFrame(rows, "pickup_datetime timestamp, dropoff_datetime timestamp, pickup_zone_id int, dropoff_zone_id int, total_amount double")
    keys = [r[0] for r in frame.select(trip_key()).collect()]
    assert len(set(keys[:-2])) == len(totals) and keys[-1] == keys[-2]


def test_key_tells_null_from_empty_and_keeps_positions(spark):
    key = lambda *vs: one(spark, k=surrogate_key(*(F.lit(v).cast("string") for v in vs)))
    assert len({key("a", None), key(None, "a"), key("a", ""), key("a", "a")}) == 4
