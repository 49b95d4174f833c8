import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from curbline import schemas  # noqa: E402
from curbline.session import build_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.sql.maxMetadataStringLength": "10000", "spark.sql.debug.maxToStringFields": "1000",
        "spark.sql.warehouse.dir": "/tmp/curbline-test-warehouse",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


BASE = dict(pickup_datetime="2024-01-05 10:00:00", dropoff_datetime="2024-01-05 10:20:00",
            pickup_zone_id=1, dropoff_zone_id=2, passenger_count=1, trip_distance=3.0, fare_amount=15.0,
            tip_amount=2.0, total_amount=20.0, payment_type=1, airport_fee=None, year=2024, month=1,
            _ingested_at="2024-02-01 00:00:00")


@pytest.fixture(scope="session")
def make_trips(spark):
    """Bronze trips from rows that say only what differs from a plain trip."""
    def make(*rows: dict):
        full = [{**BASE, **r} for r in rows]
        for r in full:
            for c in ("pickup_datetime", "dropoff_datetime", "_ingested_at"):
                r[c] = ts(r[c])
        return spark.createDataFrame([tuple(r[n] for n in schemas.BRONZE.names) for r in full], schemas.BRONZE)
    return make


@pytest.fixture(scope="session")
def make_events(spark):
    """Contract events; a row is (trip_id, dropoff time, zone, fare)."""
    def make(*rows):
        out = []
        for trip_id, dropoff, zone, fare in rows:
            t = ts(dropoff) if isinstance(dropoff, str) else dropoff
            out.append((trip_id, t, t, zone, 1, 1, 1.0, fare, 0.0, fare, 1, t))
        nullable = schemas.T.StructType([schemas.T.StructField(f.name, f.dataType) for f in schemas.TRIP_EVENT])
        return spark.createDataFrame(out, nullable)
    return make


def final_plan(df) -> str:
    """Text of the physical plan after the query ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
