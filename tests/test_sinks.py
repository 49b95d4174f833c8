import pytest
from pyspark.sql import functions as F

from conftest import DATA, final_plan
from curbline.operators import sinks
from curbline.operators.dedup import repeated_hashes
from curbline.operators.staging import stage_trips
from curbline.plans.lake import bad_months
from curbline.registry import queries


def months(spark, path):
    rows = spark.read.parquet(path).groupBy("year", "month").count().collect()
    return {(r.year, r.month): r["count"] for r in rows}


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def test_replace_leaves_other_months_alone_and_reruns_change_nothing(spark, make_trips, path):
    sinks.replace_partition(make_trips({}, {}, dict(month=2)), path)
    for _ in range(2):
        sinks.replace_partition(make_trips(dict(month=2), dict(month=2, fare_amount=1.0), dict(month=2)), path)
        assert months(spark, path) == {(2024, 1): 2, (2024, 2): 3}


@pytest.mark.parametrize("empty", ["no row passes", "false literal"])
def test_a_month_without_rows_is_emptied(spark, make_trips, path, empty):
    trips = make_trips({}, dict(month=2))
    sinks.replace_months(trips, path, [(2024, 1), (2024, 2)])
    none = trips.where("fare_amount < 0") if empty == "no row passes" else trips.where(F.lit(False))
    sinks.replace_months(none, path, [(2024, 1)])
    assert months(spark, path) == {(2024, 2): 1}
    sinks.replace_months(trips.where("month = 1"), path, [(2024, 1)])
    assert months(spark, path) == {(2024, 1): 1, (2024, 2): 1}


@pytest.mark.parametrize("stray", [dict(month=2), dict(month=None), dict(year=None, month=None)])
def test_rows_of_other_months_fail_the_write_and_change_nothing(spark, make_trips, path, stray):
    sinks.replace_months(make_trips({}, {}), path, [(2024, 1)])
    with pytest.raises(Exception, match="row of another month"):
        sinks.replace_months(make_trips({}, stray), path, [(2024, 1)])
    assert months(spark, path) == {(2024, 1): 2}


def test_delete_then_append_creates_replaces_and_folds_case(spark, make_trips, path):
    upper = lambda df: df.toDF(*(c.upper() for c in df.columns))
    for _ in range(2):
        sinks.delete_then_append_month(upper(make_trips({}, {})), path, 2024, 1)
        sinks.delete_then_append_month(make_trips(dict(month=2)), path, 2024, 2)
        assert months(spark, path) == {(2024, 1): 2, (2024, 2): 1}
    assert "pickup_datetime" in spark.read.parquet(path).columns


def test_merge_replaces_inserts_and_keeps(spark, make_trips, path):
    base = stage_trips(make_trips({}, dict(total_amount=30.0), dict(total_amount=40.0, month=2)))
    sinks.merge_upsert(spark, base, path)
    update = stage_trips(make_trips(dict(tip_amount=9.0), dict(total_amount=50.0)))
    for _ in range(2):
        assert sinks.merge_upsert(spark, update, path, layout=sinks.clustered) == [(2024, 1)]
        rows = {r.total_amount: r for r in spark.read.parquet(path).collect()}
        assert sorted(rows) == [20.0, 30.0, 40.0, 50.0]
        assert rows[20.0].tip_amount == 9.0 and rows[40.0].month == 2


def test_merge_moves_a_trip_between_months(spark, make_trips, path):
    """The same trip in the file of a later month: the old month is rewritten, here to nothing."""
    sinks.merge_upsert(spark, stage_trips(make_trips({})), path)
    touched = sinks.merge_upsert(spark, stage_trips(make_trips(dict(month=2, tip_amount=5.0))), path)
    assert touched == [(2024, 1), (2024, 2)]
    assert months(spark, path) == {(2024, 2): 1}


def test_merge_looks_for_replaced_rows_in_the_span_of_the_updates(spark, make_trips, path):
    days = ["2024-01-01", "2024-01-05", "2024-01-06", "2024-01-09"]
    trip = lambda d, total: dict(pickup_datetime=f"{d} 23:59:59", dropoff_datetime=f"{d} 23:59:59.5",
                                 total_amount=total)
    sinks.merge_upsert(spark, stage_trips(make_trips(*[trip(d, float(n)) for d in days for n in range(3)])), path)
    updates = stage_trips(make_trips(*[trip(d, 1.0) for d in days[1:]]))
    hit = sinks.replaced_rows(spark.read.parquet(path), updates, "trip_sk", "pickup_datetime")
    plan = final_plan(hit)
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    pushed = scan.split("PushedFilters")[1].split("ReadSchema")[0]
    assert pushed.count("GreaterThanOrEqual(pickup_datetime") == 1 and hit.count() == 3
    whole = sinks.replaced_rows(spark.read.parquet(path), updates, "trip_sk", None)
    assert sorted(whole.collect()) == sorted(hit.collect())


def test_merge_finds_a_replaced_row_without_a_time(spark, make_trips, path):
    """A table made elsewhere may hold trips without a pickup time."""
    keyed = lambda **c: make_trips(c).withColumn("trip_sk", F.lit("k"))
    sinks.merge_upsert(spark, keyed(pickup_datetime=None), path)
    assert sinks.merge_upsert(spark, keyed(pickup_datetime=None, month=2), path) == [(2024, 1), (2024, 2)]
    assert months(spark, path) == {(2024, 2): 1}


@pytest.mark.parametrize("bad, message", [
    ([dict(month=None)], "without a year or month"), ([{}, dict(month=None)], "without a year or month"), ([{}, {}], "2 times")])
def test_merge_refuses_bad_updates_before_it_writes(spark, make_trips, path, bad, message):
    keyed = lambda *rows: make_trips(*rows).withColumn("trip_sk", F.lit("k"))
    sinks.merge_upsert(spark, keyed({}), path)
    with pytest.raises(ValueError, match=message):
        sinks.merge_upsert(spark, keyed(*bad), path)
    assert months(spark, path) == {(2024, 1): 1}


def test_keys_are_compared_only_where_their_hashes_repeat(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("a",), (None,), ("c",), (None,)], "k string")
    alike = rows.join(repeated_hashes(rows, "k"), F.xxhash64("k") == F.col("_hash"), "left_semi")
    assert sorted(alike.collect(), key=str) == sorted([("a",), ("a",), (None,), (None,)], key=str)
    plan = final_plan(repeated_hashes(rows, "k"))
    assert "hashpartitioning(_hash" in plan and "hashpartitioning(k" not in plan


def test_trips_are_staged_by_one_shuffle_and_as_silver_would_have_them(spark, make_trips, monkeypatch):
    """Copies in one month and in two, complete and not, valid and not."""
    trips = make_trips(*[dict(total_amount=float(n % 7), fare_amount=[None, 5.0, -1.0, 6.0][n % 4], payment_type=[1, 9, 2][n % 3],
                              passenger_count=[None, 2, 1][n % 5 % 3], tip_amount=[None, 1.0][n % 2], month=1 + n % 2) for n in range(210)])
    monkeypatch.setattr(queries, "bronze", lambda spark, sf: trips.drop("_ingested_at"))
    fct = queries.fct(spark, "")
    assert final_plan(fct).split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(fct) == rows(stage_trips(queries.silver(spark, ""))) and fct.count() == 7


def test_a_moved_month_is_read_from_the_table(spark, tmp_path, monkeypatch):
    read, merge = [], sinks.merge_upsert
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(sinks, "merge_upsert", lambda spark, updates, path: read.append(updates.inputFiles()) or merge(spark, updates, path))
    queries.fct_trips_merge_moved(spark, str(DATA / "sf0.001"))
    assert len(read) == 2 and read[1] and all("fct_trips_merge_moved/year=1998/month=3/" in f for f in read[1])


def test_merge_leaves_no_working_folder(spark, make_trips, path, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "scratch_dir", lambda spark, label: str(tmp_path / "curbline" / label))
    for _ in range(2):
        sinks.merge_upsert(spark, stage_trips(make_trips({})), path)
        assert not list((tmp_path / "curbline").glob("*"))


def test_merge_of_nothing_changes_nothing(spark, make_trips, path):
    sinks.merge_upsert(spark, stage_trips(make_trips({})), path)
    assert sinks.merge_upsert(spark, stage_trips(make_trips(dict(fare_amount=None))), path) == []
    assert months(spark, path) == {(2024, 1): 1}


def test_clustered_files_cover_few_days(spark, make_trips, path):
    rows = [dict(pickup_datetime=f"2024-01-{d:02d} 10:00:00", dropoff_datetime=f"2024-01-{d:02d} 11:00:00",
                 total_amount=float(i)) for d in range(1, 21) for i in range(10)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.replace_partition(sinks.clustered(make_trips(*rows)), path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per_file = (spark.read.parquet(path).groupBy(F.input_file_name().alias("f"))
                .agg(F.collect_set(F.to_date("pickup_datetime")).alias("days")).collect())
    assert len(per_file) > 1
    days = [d for r in per_file for d in r.days]
    assert len(days) == len(set(days)) == 20


def test_full_refresh_and_drop_schema(spark, make_trips):
    sinks.drop_schema(spark, "ci_run")
    spark.sql("CREATE DATABASE ci_run")
    for _ in range(2):
        sinks.full_refresh(make_trips({}), "ci_run.dim")
        assert spark.table("ci_run.dim").count() == 1
    sinks.drop_schema(spark, "ci_run")
    assert not spark.catalog.databaseExists("ci_run")


def test_bad_months(spark, make_trips, tmp_path):
    from curbline.plans import Lake
    lake = Lake(str(tmp_path))
    sinks.replace_partition(make_trips({}, {}, dict(month=2)), lake.bronze)
    sinks.replace_partition(make_trips({}), lake.quarantine)
    assert [(r.month, r.silver_quarantined) for r in bad_months(spark, lake, 0.4).collect()] == [(1, 1)]
