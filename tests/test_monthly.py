"""The whole chain on files of two months."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from curbline.operators.checks import CheckFailed
from curbline.plans import Lake, backfill, run_month
from curbline.plans.marts import build_fct_trips
from curbline.operators.demand import zone_demand
from curbline.operators.reconcile import DriftError
from curbline.plans.journal import Journal
from curbline.plans.monthly import read_marts
from curbline.sources.files import read_table
from curbline.sources.star_tables import raw_trips

CALENDAR = (date(1998, 1, 1), date(1999, 1, 1))
MONTHS = [date(1998, 2, 1), date(1998, 3, 1)]


def after(m):
    """The day after the month's last: its trips are fresh."""
    return datetime(m.year, m.month + 1, 1)


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Raw files by month, with the zone outside the dimension taken out and fares of a usual size."""
    root = tmp_path_factory.mktemp("raw")
    usual = {c: F.floor(F.col(c) / 10) / 100 for c in ("fare_amount", "total_amount")}
    raw = raw_trips(spark, str(DATA / "sf0.01")).withColumns({**usual, "PULocationID": F.col("PULocationID") % 25}).cache()
    for m in MONTHS:
        (raw.where((F.col("year") == m.year) & (F.col("month") == m.month)).drop("year", "month")
         .write.parquet(str(root / f"{m:%Y-%m}")))
    lines = ["LocationID,Borough,Zone,service_zone"] + [f"{i},B,Z{i},S" for i in range(25)]
    (root / "zones.csv").write_text("\n".join(lines) + "\n")
    return root


def raw_path(files):
    return lambda m: str(files / f"{m:%Y-%m}")


def contents(spark, lake):
    tables = (lake.bronze, lake.quarantine, lake.silver, lake.gold_trips, lake.gold_daily, lake.warehouse_trips,
              lake.fct_trips)
    return [sorted(str(tuple(r)) for r in spark.read.parquet(t).drop("_ingested_at").collect()) for t in tables]


def test_backfill_and_rerun(spark, files, tmp_path):
    lake, zones = Lake(str(tmp_path)), str(files / "zones.csv")
    metrics = backfill(spark, lake, raw_path(files), MONTHS, zones, CALENDAR, after)
    before = contents(spark, lake)
    bronze, bad, silver, gold, daily, warehouse, fct = map(len, before)
    assert sum(m["silver_total"] for m in metrics.values()) == bronze
    assert sum(m["silver_quarantined"] for m in metrics.values()) == bad > 0
    assert bronze - bad >= silver == gold == warehouse > fct > 0 and daily > 0
    # Passed over, and run anew: the same tables.
    assert backfill(spark, lake, raw_path(files), MONTHS, zones, CALENDAR, after) == metrics
    assert backfill(spark, lake, raw_path(files), MONTHS, zones, CALENDAR, after, resume=False) == metrics
    assert contents(spark, lake) == before


def test_a_repaired_month_loses_its_old_rejects(spark, files, tmp_path):
    lake, zones, month = Lake(str(tmp_path / "lake")), str(files / "zones.csv"), MONTHS[0]
    run_month(spark, lake, raw_path(files)(month), month, zones, CALENDAR, after(month))
    good = str(tmp_path / "good")
    (spark.read.parquet(raw_path(files)(month))
     .where("tpep_pickup_datetime < tpep_dropoff_datetime AND fare_amount >= 0 AND trip_distance <= 200")
     .write.parquet(good))
    metrics = run_month(spark, lake, good, month, zones, CALENDAR, after(month))
    assert metrics["silver_quarantined"] == 0 and spark.read.parquet(lake.quarantine).count() == 0


def test_a_failing_check_stops_the_run(spark, files, tmp_path):
    few = tmp_path / "few.csv"
    few.write_text("LocationID,Borough,Zone,service_zone\n1,B,Z,S\n")
    month, zones = MONTHS[0], str(files / "zones.csv")
    lake = Lake(str(tmp_path / "a"))
    with pytest.raises(CheckFailed, match="relationships"):
        run_month(spark, lake, raw_path(files)(month), month, str(few), CALENDAR, after(month))
    assert read_table(spark, lake.run_history) is None  # a run counts when its gates have passed
    dear = str(tmp_path / "dear")
    spark.read.parquet(raw_path(files)(month)).withColumn("fare_amount", F.col("fare_amount") * 100).write.parquet(dear)
    with pytest.raises(CheckFailed, match="avg\\(fare_amount\\)"):
        run_month(spark, Lake(str(tmp_path / "b")), dear, month, zones, CALENDAR, after(month))
    # Now is decades after the trips.
    with pytest.raises(CheckFailed, match="freshness\\(pickup_datetime\\)"):
        run_month(spark, Lake(str(tmp_path / "c")), raw_path(files)(month), month, zones, CALENDAR, datetime(2024, 1, 1))
    with pytest.raises(CheckFailed, match="freshness\\(_ingested_at\\)"):
        run_month(spark, Lake(str(tmp_path / "d")), raw_path(files)(month), month, zones, CALENDAR, datetime(2100, 1, 1))


def test_a_failed_backfill_goes_on_at_the_step_that_failed(spark, files, tmp_path, monkeypatch):
    lake, zones, ran = Lake(str(tmp_path)), str(files / "zones.csv"), []
    real = Journal.step

    def step(self, name, work):
        return real(self, name, lambda: ran.append((self.path[-2:], name)) or work())

    monkeypatch.setattr(Journal, "step", step)
    with pytest.raises(CheckFailed, match="freshness"):
        backfill(spark, lake, raw_path(files), MONTHS, zones, CALENDAR, lambda m: datetime(1998, 12, 1) if m == MONTHS[1] else after(m))
    assert [n for m, n in ran if m == "02"][-1] == "history" and ran[-1] == ("03", "runtime_gate")
    ran.clear()
    metrics = backfill(spark, lake, raw_path(files), MONTHS, zones, CALENDAR, after)
    assert ran == [("03", "runtime_gate"), ("03", "history")] and len(metrics) == 2
    assert spark.read.parquet(lake.run_history).count() == 2


def test_the_speed_layers_table_gates_a_run(spark, files, tmp_path):
    month, zones = MONTHS[0], str(files / "zones.csv")
    lake, demand = Lake(str(tmp_path / "lake")), str(tmp_path / "demand")
    run_month(spark, lake, raw_path(files)(month), month, zones, CALENDAR, after(month))
    fct, _, _ = read_marts(spark, lake)
    newest = fct.agg(F.max("dropoff_datetime")).first()[0]
    zone_demand(fct).write.parquet(demand)
    run_month(spark, lake, raw_path(files)(month), month, zones, CALENDAR, newest, demand, resume=True)
    assert {"live_gate", "drift_gate"} <= {r.step for r in spark.read.parquet(lake.journal).collect()}
    # The same table without one zone's windows, then one whose newest window is days old.
    spark.read.parquet(demand).where("pickup_zone_id <> 3").write.parquet(f"{demand}-less")
    with pytest.raises(DriftError):
        run_month(spark, Lake(str(tmp_path / "b")), raw_path(files)(month), month, zones, CALENDAR, newest, f"{demand}-less")
    spark.read.parquet(demand).where("window_end < '1998-02-20'").write.parquet(f"{demand}-old")
    with pytest.raises(CheckFailed, match="freshness\\(window_end\\)"):
        run_month(spark, Lake(str(tmp_path / "c")), raw_path(files)(month), month, zones, CALENDAR, newest, f"{demand}-old")


def test_first_build_takes_all_loaded_months(spark, files, tmp_path):
    from curbline.plans.lake import build_gold, build_silver, ingest_bronze
    from curbline.plans.marts import build_dimensions, load_warehouse_month
    lake = Lake(str(tmp_path))
    for m in MONTHS:
        ingest_bronze(spark, lake, raw_path(files)(m), m.year, m.month)
        build_silver(spark, lake, m.year, m.month)
        build_gold(spark, lake, m.year, m.month)
        load_warehouse_month(spark, lake, m.year, m.month)
    build_dimensions(spark, lake, str(files / "zones.csv"), *CALENDAR)
    build_fct_trips(spark, lake, MONTHS[1])
    fct, zones, dates = read_marts(spark, lake)
    assert {r.month for r in fct.select("month").distinct().collect()} == {2, 3}
    assert (zones.count(), dates.count()) == (25, 365)


def test_a_jump_in_volume_fails(spark, tmp_path):
    from curbline.operators.check_states import METRICS
    from curbline.plans.marts import record_run, run_history, volume_check
    lake = Lake(str(tmp_path))
    for month, rows, status in ((1, 100, "not_evaluated"), (2, 110, "pass"), (3, 1000, "fail"), (3, 1000, "fail")):
        day = date(2024, month, 1)
        state = spark.createDataFrame([(2024, month, rows)], "year int, month int, row_count bigint")
        state.drop("year", "month").write.mode("overwrite").parquet(f"{lake.states}/{METRICS}/year=2024/month={month}")
        got = volume_check(run_history(spark, lake, day), day).collect()
        assert [r.status for r in got] == [status]
        record_run(spark, lake, day)
    assert spark.read.parquet(lake.run_history).count() == 3
