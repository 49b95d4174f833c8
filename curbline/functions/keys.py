"""Hash keys over columns with one fixed text form per type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..schemas import TRIP_KEY
from .amounts import exact_rest, exact_units

NULL_TEXT = "<null>"


def surrogate_key(*parts: Column) -> Column:
    """md5 over the text of integral or string parts; NULL has a text of its own."""
    texts = [F.coalesce(p.cast("string"), F.lit(NULL_TEXT)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def trip_key() -> Column:
    """Key of a trip from its natural key.

    Times go in as epoch microseconds and money as whole 1/10000: integers print the same in every
    engine and session, doubles and timestamps do not. An amount that is no such number goes in as the
    shortest decimal text that reads back as it, so different amounts never share a key.
    """
    pickup, dropoff, pickup_zone, dropoff_zone, total = (F.col(c) for c in TRIP_KEY)
    return surrogate_key(F.unix_micros(pickup), F.unix_micros(dropoff), pickup_zone, dropoff_zone,
                         F.when(exact_rest(total) == 0, exact_units(total).cast("string")).otherwise(total.cast("string")))
