"""Time arithmetic on epoch-aligned slices."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F


def interval_us(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def interval_text(span: timedelta) -> str:
    """Spark interval text of a span, for window() and withWatermark()."""
    return f"{interval_us(span)} microseconds"


def slice_start(ts: Column, size: timedelta) -> Column:
    """Start of the epoch-aligned slice that holds ``ts``."""
    us = F.unix_micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(interval_us(size))))


def minute_boundaries(start: Column, end: Column) -> Column:
    """Minute marks passed between two times: 00:00:59 to 00:01:01 passes one."""
    minute = lambda ts: F.floor(F.unix_seconds(ts) / 60)
    return (minute(end) - minute(start)).cast("bigint")


def moment(t: datetime | Column) -> Column:
    """A time given by the caller. A datetime without a zone is a UTC reading, wherever the driver runs."""
    if isinstance(t, Column):
        return t
    return F.lit(t if t.tzinfo else t.replace(tzinfo=timezone.utc))


def age_hours(ts: Column, as_of: Column) -> Column:
    return (F.unix_micros(as_of) - F.unix_micros(ts)) / F.lit(3.6e9)
