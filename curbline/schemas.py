"""Fixed schemas of the lake tables, the marts and the event contract."""

from pyspark.sql import types as T

MONTH_KEYS = ["year", "month"]

# Two rows with equal values here are the same trip.
TRIP_KEY = ["pickup_datetime", "dropoff_datetime", "pickup_zone_id", "dropoff_zone_id", "total_amount"]


_TYPES = {"timestamp": T.TimestampType(), "int": T.IntegerType(), "bigint": T.LongType(),
          "double": T.DoubleType(), "string": T.StringType()}


def _struct(spec: str, required: str = "") -> T.StructType:
    """Schema from "name type, ..." text; unlike fromDDL it needs no running session."""
    must = set(required.split())
    fields = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind], name not in must) for name, kind in fields])


BRONZE = _struct(
    "pickup_datetime timestamp, dropoff_datetime timestamp, pickup_zone_id int, dropoff_zone_id int,"
    " passenger_count int, trip_distance double, fare_amount double, tip_amount double,"
    " total_amount double, payment_type int, airport_fee double,"
    " year int, month int, _ingested_at timestamp")

FCT_TRIPS = _struct(
    "trip_sk string, pickup_datetime timestamp, dropoff_datetime timestamp,"
    " trip_duration_minutes bigint, pickup_zone_id int, dropoff_zone_id int, passenger_count int,"
    " trip_distance double, fare_amount double, tip_amount double, total_amount double,"
    " payment_type int, year int, month int")

ZONE_LOOKUP = _struct("LocationID int, Borough string, Zone string, service_zone string")

# Contract v1 of the event stream; the required fields are never NULL in a valid event.
REQUIRED_EVENT_FIELDS = ["trip_id", "pickup_datetime", "dropoff_datetime", "event_produced_at"]
TRIP_EVENT = _struct(
    "trip_id string, pickup_datetime timestamp, dropoff_datetime timestamp, pickup_zone_id int,"
    " dropoff_zone_id int, passenger_count int, trip_distance double, fare_amount double,"
    " tip_amount double, total_amount double, payment_type int, event_produced_at timestamp",
    required=" ".join(REQUIRED_EVENT_FIELDS))

ZONE_DEMAND = _struct(
    "window_start timestamp, window_end timestamp, pickup_zone_id int, trip_count bigint,"
    " avg_fare double, total_revenue double")

FARE_ANOMALIES = _struct(
    "trip_id string, dropoff_datetime timestamp, pickup_zone_id int, fare_amount double,"
    " zone_avg_fare double, deviation_ratio double")
