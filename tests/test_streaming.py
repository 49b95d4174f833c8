"""Streams against their batch form, and the side outputs. Only closed windows are compared."""

import json
from datetime import timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import ts
import arrival
from curbline import schemas, streaming
from curbline.operators.anomalies import fare_anomalies
from curbline.operators.demand import zone_demand
from curbline.streaming.speed import DELAY
from test_speed_batch import START, random_rows

SECOND, MIN = timedelta(seconds=1), timedelta(minutes=1)
# Far later than all rows: moves the watermark past every window. It has no zone, hence no result of
# its own, unless a test says so.
FLUSH = START + timedelta(days=2)


def write_files(make_events, path, *batches):
    for rows in batches:
        make_events(*rows).coalesce(1).write.mode("append").parquet(path)


def drain(*queries):
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def dirs(tmp_path):
    return lambda name: str(tmp_path / name)


def test_streams_equal_the_batch(spark, make_events, dirs):
    rows = sorted(random_rows(150), key=lambda r: r[1])
    # The last two files only move time on; their own windows stay open.
    write_files(make_events, dirs("in"), rows[:50], rows[50:100], rows[100:], [("flush", FLUSH, 1, 1.0)],
                [("flush2", FLUSH + SECOND, 1, 1.0)])
    events = streaming.read_event_files(spark, dirs("in"), max_files=1)
    landing, *results = streaming.start_speed_layer(events, dirs("out"), dirs("cp"), rollover=None, max_files=1)
    drain(landing, *results)
    # The source is read and judged once, whatever reads the landing table.
    assert sum(p.numInputRows for p in landing.recentProgress) == len(rows) + 2
    closed = make_events(*rows)
    assert as_set(spark.read.parquet(dirs("out/zone_demand_5min"))) == as_set(zone_demand(closed))
    assert spark.read.parquet(dirs("out/zone_demand_5min")).dtypes == [
        (f.name, f.dataType.simpleString()) for f in schemas.ZONE_DEMAND]
    got = as_set(spark.read.parquet(dirs("out/fare_anomalies")))
    assert got and got == as_set(fare_anomalies(closed))


def test_disorder_inside_the_delay_changes_nothing(spark, make_events, dirs):
    rows = random_rows(300, seed=5)
    mixed = arrival.disorder(make_events(*rows), fraction=0.4, longest=140 * SECOND)
    arrival.write_in_arrival_order(mixed, dirs("in"), timedelta(minutes=12))
    write_files(make_events, dirs("in"), [("f1", FLUSH, 1, 1.0)], [("f2", FLUSH + SECOND, 1, 1.0)])
    events = streaming.read_event_files(spark, dirs("in"), max_files=1)
    drain(*streaming.start_speed_layer(events, dirs("out"), dirs("cp"), rollover=None))
    assert as_set(spark.read.parquet(dirs("out/zone_demand_5min"))) == as_set(zone_demand(make_events(*rows)))
    assert as_set(spark.read.parquet(dirs("out/fare_anomalies"))) == as_set(fare_anomalies(make_events(*rows)))


def test_event_after_its_pane_closed_is_judged_but_enters_no_average(spark, make_events, dirs):
    quiet = [(f"q{m}", START + m * MIN, 1, 1.0) for m in (1, 2, 3)]
    # 00:15 closes the pane that ends at 00:05; the spike of 00:04 comes after that, the next one in time.
    write_files(make_events, dirs("in"), quiet, [("x", START + 15 * MIN, 1, 1.0)], [("y", START + 15 * MIN, 2, 1.0)],
                [("late", START + 4 * MIN, 1, 50.0), ("spike", START + 14 * MIN, 1, 50.0)], [("f", FLUSH, 1, 1.0)], [("g", FLUSH + SECOND, 1, 1.0)])
    events = streaming.read_event_files(spark, dirs("in"), max_files=1)
    drain(streaming.start_file_sink(streaming.fare_anomaly_stream(events), dirs("out"), dirs("cp"), None))
    rows = spark.read.parquet(dirs("out")).collect()
    late = sorted(r.zone_avg_fare for r in rows if r.trip_id == "late")
    assert late == [1.0, 1.0, 10.8, 10.8, 10.8, 13.25]
    assert {r.trip_id for r in rows} == {"late", "spike"}


def test_restart_adds_nothing_and_then_only_what_is_new(spark, make_events, dirs):
    def run():
        events = streaming.read_event_files(spark, dirs("in"))
        drain(streaming.start_file_sink(streaming.zone_demand_stream(events), dirs("out"), dirs("cp"), None))
        out = spark.read.parquet(dirs("out"))
        return sorted((r.window_start, r.trip_count) for r in out.collect())

    write_files(make_events, dirs("in"), [("a", START, 1, 1.0)])
    run()
    write_files(make_events, dirs("in"), [("b", START + 20 * MIN, 1, 1.0)])
    first = run()
    assert first == [(START, 1)] and run() == first
    write_files(make_events, dirs("in"), [("c", START + 60 * MIN, 1, 1.0)])
    assert run() == [(START, 1), (START + 20 * MIN, 1)]


def test_join_state_stays_bounded(spark, make_events, dirs):
    """As many events per hour for six hours; rows in the join state must not keep growing."""
    batches = [[(f"e{h}-{m}", START + timedelta(hours=h, minutes=m), 1, 1.0) for m in range(0, 60, 2)] for h in range(6)]
    write_files(make_events, dirs("in"), *batches)
    events = streaming.read_event_files(spark, dirs("in"), max_files=1)
    query = streaming.start_file_sink(streaming.fare_anomaly_stream(events), dirs("out"), dirs("cp"), None)
    drain(query)
    state = [max((op.numRowsTotal for op in p.stateOperators if "Join" in op.operatorName), default=0)
             for p in query.recentProgress]
    assert len(state) >= 6 and max(state[3:]) <= 1.5 * max(state[1:3])


def test_events_of_one_zone_are_spread_over_state_partitions(spark, make_events):
    rows = [(f"e{i}", START, 1, 1.0) for i in range(500)]
    salted = make_events(*rows).select(F.pmod(F.xxhash64("trip_id"), F.lit(16)).alias("s")).groupBy("s").count().collect()
    assert len(salted) == 16 and max(r["count"] for r in salted) < 70


def wire_line(**changes):
    millis = int(START.timestamp() * 1000) + 60_000
    event = dict(trip_id="x", pickup_datetime=millis, dropoff_datetime=millis, pickup_zone_id=1, fare_amount=2.5,
                 event_produced_at=millis)
    event.update(changes)
    return json.dumps({k: v for k, v in event.items() if v is not ...})


def test_contract_split_loses_no_message(spark):
    lines = [wire_line(), wire_line(trip_id=None), wire_line(dropoff_datetime=...), "{not json", "",
             wire_line(fare_amount="much"), wire_line(pickup_zone_id=None)]
    raw = spark.createDataFrame([(v,) for v in lines], "value string")
    events, dead = streaming.split_contract(streaming.decode_json(raw))
    assert events.columns == schemas.TRIP_EVENT.names and events.count() == 2
    reasons = {r.value: r._violation for r in dead.collect()}
    assert len(reasons) == 5
    assert reasons["{not json"] == reasons[lines[5]] == "malformed"
    assert reasons[lines[1]] == "missing trip_id" and reasons[lines[2]] == "missing dropoff_datetime"
    assert events.first().dropoff_datetime == START + MIN


def test_producer_side_contract(spark, make_events):
    events = make_events(("a", "2024-01-01", 1, 1.0))
    assert streaming.require_schema(events).columns == schemas.TRIP_EVENT.names
    with pytest.raises(streaming.ContractError, match="fare_amount double"):
        streaming.require_schema(events.withColumn("fare_amount", F.lit("1")))
    with pytest.raises(streaming.ContractError, match="trip_id string"):
        streaming.require_schema(events.drop("trip_id"))
    valid, dead = streaming.split_contract(events.withColumn("trip_id", F.lit(None).cast("string")))
    assert (valid.count(), dead.first()["_violation"]) == (0, "missing trip_id")


def test_landing_holds_every_message_once_also_after_a_crash(spark, make_events, dirs):
    """The commit of the last batch is taken away, as if the driver had died before it: the batch runs again, the table stays."""
    write_files(make_events, dirs("in"), [("a", START, 1, 1.0), (None, START, 1, 1.0)], [("b", START + MIN, None, 2.0)])

    def land():
        query = streaming.start_landing(streaming.read_event_files(spark, dirs("in"), max_files=1), dirs("landing"), dirs("cp"), rollover=None)
        drain(query)
        return sum(p.numInputRows for p in query.recentProgress)

    assert land() == 3
    last = max((Path(dirs("cp")) / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    last.unlink()
    last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    land()
    assert sorted(r.trip_id for r in streaming.landed_events(spark, dirs("landing")).collect()) == ["a", "b"]
    assert [r._violation for r in streaming.dead_letters(spark, dirs("landing")).collect()] == ["missing trip_id"]


def test_a_result_restarts_in_the_middle_of_a_batch(spark, make_events, dirs):
    rows = [(f"t{i}", START + i * MIN, 1, 1.0) for i in range(60)]

    def run():
        drain(*streaming.start_speed_layer(streaming.read_event_files(spark, dirs("in"), max_files=1), dirs("out"), dirs("cp"), rollover=None, max_files=1))

    write_files(make_events, dirs("in"), rows[:20], rows[20:40])
    run()
    for name in ("zone_demand_5min", "fare_anomalies"):
        last = max((Path(dirs("cp")) / name / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
        last.unlink()
        last.with_name(f".{last.name}.crc").unlink(missing_ok=True)
    write_files(make_events, dirs("in"), rows[40:], [("f", FLUSH, 1, 1.0)])
    run()
    assert as_set(spark.read.parquet(dirs("out/zone_demand_5min"))) == as_set(zone_demand(make_events(*rows)))


def test_an_event_enters_the_averages_state_once(spark, make_events, dirs):
    """Rows of the first aggregate's state: one for each pane, however many events and windows lie over it."""
    rows = [(f"e{i}", START + timedelta(seconds=6 * i), 1 + i % 2, 1.0) for i in range(600)]
    write_files(make_events, dirs("in"), rows[:300], rows[300:], [("f", FLUSH, 1, 1.0)])
    stream = streaming.read_event_files(spark, dirs("in"), max_files=1)
    query = streaming.start_file_sink(streaming.fare_anomaly_stream(stream, salts=2), dirs("out"), dirs("cp"), None)
    drain(query)
    aggregates = [[op for op in p.stateOperators if op.operatorName == "stateStoreSave"] for p in query.recentProgress]
    assert all(len(ops) == 2 for ops in aggregates)
    # Two zones and six panes in each half hour; updates of a batch are panes, not events times windows.
    assert max(min(op.numRowsTotal for op in ops) for ops in aggregates) <= 2 * 8
    assert all(op.numRowsUpdated <= 2 * 18 for ops in aggregates for op in ops)


@pytest.mark.parametrize("seed", [1, 2])
def test_no_event_is_lost_between_windows_and_late_counts(spark, make_events, dirs, seed):
    """Disorder in three bands: inside the watermark, inside the lateness, beyond both; stopped in between."""
    rows = [(f"t{i}", START + timedelta(seconds=24 * i), 1 + i % 3, 1.0) for i in range(600)]
    events = arrival.disorder(make_events(*rows), fraction=0.3, longest=timedelta(minutes=40), seed=seed)
    arrived = events.where("arrival_time < TIMESTAMP '2024-01-01 02:00:00'")
    dropped = 0

    def run():
        stream = streaming.read_event_files(spark, dirs("in"), max_files=1)
        _, demand, _ = queries = streaming.start_speed_layer(stream, dirs("out"), dirs("cp"), rollover=None, max_files=1)
        drain(*queries)
        return sum(op.numRowsDroppedByWatermark for p in demand.recentProgress for op in p.stateOperators)

    assert arrival.write_in_arrival_order(arrived, dirs("in"), timedelta(minutes=30)) == 4
    dropped += run()
    rest = events.where("arrival_time >= TIMESTAMP '2024-01-01 02:00:00'")
    assert arrival.write_in_arrival_order(rest, dirs("in"), timedelta(minutes=30)) >= 4
    write_files(make_events, dirs("in"), [("f1", FLUSH, 1, 1.0)], [("f2", FLUSH + SECOND, 1, 1.0)])
    dropped += run()
    demand = spark.read.parquet(dirs("out/zone_demand_5min"))
    landed = streaming.landed_events(spark, dirs("out/landing"))
    late = streaming.late_counts(landed, demand, FLUSH - MIN).agg(F.sum("late")).first()[0]
    counted = demand.agg(F.sum("trip_count")).first()[0]
    assert late and counted + late == len(rows) and dropped > 0


def test_disorder_is_repeatable_and_within_bounds(spark, make_events):
    events = make_events(*[(f"t{i}", START + i * SECOND, 1, 1.0) for i in range(2000)])
    delay = (F.unix_micros("arrival_time") - F.unix_micros("dropoff_datetime")) / 1e6
    out = arrival.disorder(events, fraction=0.1, longest=90 * SECOND).withColumn("delay", delay)
    held = [r.delay for r in out.where("delay > 0").collect()]
    assert 130 < len(held) < 270 and 5 <= min(held) and max(held) <= 90
    again = arrival.disorder(events.repartition(3), fraction=0.1, longest=90 * SECOND)
    assert as_set(again) == as_set(out.drop("delay"))


def test_replays_are_counted_once_if_asked(spark, make_events, dirs):
    rows = [("a", START, 1, 1.0), ("b", START, 1, 1.0)]
    write_files(make_events, dirs("in"), rows, rows, [("f", FLUSH, 1, 1.0)], [("g", FLUSH + SECOND, 1, 1.0)])
    events = streaming.once_per_trip(streaming.read_event_files(spark, dirs("in"), max_files=1))
    from curbline.operators.demand import zone_demand as demand
    drain(streaming.start_file_sink(demand(events), dirs("out"), dirs("cp"), None))
    assert [r.trip_count for r in spark.read.parquet(dirs("out")).collect()] == [2]


def test_json_lines_to_events_and_dead_letters(spark, dirs):
    poison = wire_line(trip_id="p", dropoff_datetime=9_200_000_000_000_000_000)
    lines = [wire_line(trip_id="a"), "broken", poison, wire_line(trip_id="b")]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(dirs("in"))
    decoded = streaming.decode_json(streaming.read_json_lines(spark, dirs("in")))
    drain(streaming.start_landing(decoded, dirs("landing"), dirs("cp"), rollover=None))
    dead = streaming.dead_letters(spark, dirs("landing")).collect()
    assert sorted((r.value, r._violation) for r in dead) == sorted([("broken", "malformed"), (poison, "malformed")])
    assert sorted(r.trip_id for r in streaming.landed_events(spark, dirs("landing")).collect()) == ["a", "b"]


def test_slices_are_written_in_the_order_of_time(spark, make_events, dirs):
    rows = [(f"t{i}", START + i * MIN, 1, 1.0) for i in range(40)] + [("none", None, 1, 1.0)]
    events = make_events(*rows)
    for only in (range(0, 1), range(1, 4)):
        streaming.write_in_slices(events, dirs("in"), (START, START + 39 * MIN), 4, files=2, only=only)
    assert spark.read.parquet(dirs("in")).count() == 41
    files = sorted(Path(dirs("in")).glob("part-*"), key=lambda f: f.stat().st_mtime_ns)
    first = [min(r.dropoff_datetime or START for r in spark.read.parquet(str(f)).collect()) for f in files]
    assert len(files) == 8 and first[:2] < first[2:4] < first[4:6] < first[6:]


def test_delay_is_watermark_plus_lateness():
    assert DELAY == 150 * SECOND
