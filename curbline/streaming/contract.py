"""The event contract: decoding, violations, and the split into events and dead letters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..schemas import REQUIRED_EVENT_FIELDS, TRIP_EVENT

VIOLATION = "_violation"
_CORRUPT = "_corrupt"
#: Epoch milliseconds of the year 9999, about.
LATEST_MS = 2.5e14


class ContractError(TypeError):
    """A frame does not have the columns of the contract."""


def require_schema(df: DataFrame, schema: StructType = TRIP_EVENT) -> DataFrame:
    """The contract's columns of ``df``, or an error naming what is missing or of another type."""
    have = {f.name: f.dataType for f in df.schema}
    wrong = [f"{f.name} {f.dataType.simpleString()}" for f in schema if have.get(f.name) != f.dataType]
    if wrong:
        raise ContractError("contract wants " + ", ".join(wrong))
    return df.select(*schema.names)


def wire_schema() -> StructType:
    """Events as they travel: times are epoch milliseconds."""
    return StructType([StructField(f.name, LongType() if f.dataType == TimestampType() else f.dataType)
                       for f in TRIP_EVENT])


def decode_json(raw: DataFrame) -> DataFrame:
    """JSON ``value`` to event columns; the text stays in ``value`` for the dead letters.

    A time beyond what a timestamp holds makes the message malformed, and not the query fail.
    """
    wire = wire_schema().add(_CORRUPT, StringType())
    parsed = F.from_json(F.col("value"), wire, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    times = [F.col(f"e.{f.name}") for f in TRIP_EVENT if f.dataType == TimestampType()]
    absurd = reduce(Column.__or__, (F.coalesce(F.abs(t.cast("double")) > LATEST_MS, F.lit(False)) for t in times))
    fields = [F.timestamp_millis(F.when(F.abs(F.col(f"e.{f.name}").cast("double")) <= LATEST_MS, F.col(f"e.{f.name}"))).alias(f.name)
              if f.dataType == TimestampType() else F.col(f"e.{f.name}") for f in TRIP_EVENT]
    corrupt = F.coalesce(F.col(f"e.{_CORRUPT}"), F.when(absurd, F.col("value"))).alias(_CORRUPT)
    return raw.select("value", parsed.alias("e")).select("value", *fields, corrupt)


def contract_violation(df: DataFrame) -> Column:
    """First violation of a row: undecodable, or a required field missing. NULL if valid."""
    rules = [F.when(F.col(_CORRUPT).isNotNull(), "malformed")] if _CORRUPT in df.columns else []
    rules += [F.when(F.col(c).isNull(), f"missing {c}") for c in REQUIRED_EVENT_FIELDS]
    return F.coalesce(*rules)


def split_contract(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, dead letters). Works on streams and on batches, before and after the wire."""
    tagged = df.withColumn(VIOLATION, contract_violation(df))
    events = tagged.where(F.col(VIOLATION).isNull()).select(*TRIP_EVENT.names)
    return events, tagged.where(F.col(VIOLATION).isNotNull()).drop(_CORRUPT)
