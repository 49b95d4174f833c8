"""Money sums that do not depend on the order tasks finish in.

A double sum changes in its last digits between runs, so a rerun would rewrite a partition with
other bytes, and a total over 10^12 trips is off by whole cents. Amounts are therefore summed as
64-bit counts of 1/10000: exact, and as cheap as a double sum inside generated code. What such a count
cannot hold is summed beside it as a double: a residue below 1/10000, of an amount of ``LARGE`` and more the whole multiples of
``STEP``, which doubles add exactly, and amounts of ``BEYOND`` and more, infinities among them. Nothing is cut and nothing raises. NaN
carries no amount and is skipped like NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec, functions as F

UNITS = 10_000.0
#: Amounts from here on are counted without their multiples of STEP. Below it, 10^9 rows of the largest amount still fit 64 bits.
LARGE = 900_000.0
STEP = 2.0 ** 19
#: Amounts from here on are summed as doubles: their count of 1/10000 is no longer exact.
BEYOND = 2.0 ** 37
#: Sums of doubles below it are brought to 1/10000 and added to the count.
_JOINED = 4e14


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _known(amount: Column) -> Column:
    return amount.isNotNull() & ~F.isnan(amount)


def _steps(units: Column) -> Column:
    """The whole multiples of STEP nearest to an amount of ``units``."""
    return F.rint(units / F.lit(UNITS * STEP)) * F.lit(STEP)


def exact_units(c: Column | str) -> Column:
    """The part of an amount that is a whole number of 1/10000, without the multiples of STEP of a large one; 0 of one too large, NULL of none."""
    amount = _col(c)
    units = F.rint(amount * F.lit(UNITS))
    counted = F.when(F.abs(amount) < LARGE, units).when(F.abs(amount) < BEYOND, units - _steps(units) * F.lit(UNITS)).otherwise(0.0)
    return F.when(_known(amount), counted.cast("bigint"))


def exact_rest(c: Column | str) -> Column:
    """What ``exact_units`` leaves of an amount; 0 for money as it is usually written."""
    amount = _col(c)
    units = F.rint(amount * F.lit(UNITS))
    residue = amount - units / F.lit(UNITS)
    left = F.when(F.abs(amount) < LARGE, residue).when(F.abs(amount) < BEYOND, _steps(units) + residue).otherwise(amount)
    return F.when(_known(amount), left)


def exact_total(units: Column | str, rest: Column | str) -> Column:
    """Amount from sums of both parts. Whole doubles join the count first, so that the total is rounded once."""
    units, rest = _col(units), _col(rest)
    whole = (F.abs(rest) < _JOINED) & (rest == F.rint(rest))
    joined = F.when(whole, F.try_add(units, (rest * F.lit(UNITS)).cast("bigint")))
    return F.coalesce(joined / F.lit(UNITS), units / F.lit(UNITS) + rest)


def exact_sum(c: Column | str, over: WindowSpec | None = None) -> Column:
    units, rest = F.sum(exact_units(c)), F.sum(exact_rest(c))
    return exact_total(units, rest) if over is None else exact_total(units.over(over), rest.over(over))


def exact_avg(c: Column | str) -> Column:
    return ratio(exact_sum(c), F.count(exact_units(c)))


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where den is 0."""
    return num / F.nullif(den, F.lit(0))
