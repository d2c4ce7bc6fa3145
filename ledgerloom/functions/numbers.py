"""Zero-guarded ratios and rounding. Money stays DECIMAL until it is divided."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import col


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as DOUBLE, NULL where den is 0."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def percent(num: Column | str, den: Column | str) -> Column:
    return ratio(num, den) * 100.0


def growth_percent(now: Column | str, before: Column | str) -> Column:
    """Change from ``before`` to ``now`` in percent, NULL where ``before`` is 0 or missing."""
    now, before = col(now), col(before)
    return percent(now - before, before)


def or_zero(c: Column | str) -> Column:
    c = col(c)
    return F.coalesce(c, F.lit(0))


def sum_or_zero(c: Column | str) -> Column:
    """Sum that is 0, not NULL, for a group without values."""
    return or_zero(F.sum(col(c)))


def rounded(c: Column, digits: int | None, half_even: bool = False) -> Column:
    if digits is None:
        return c
    return F.bround(c, digits) if half_even else F.round(c, digits)


def min_max_index(value: Column | str, low: Column, high: Column) -> Column:
    """Position of value between low and high as 0..1; 0 where low equals high."""
    value = col(value)
    return F.coalesce(ratio(value - low, high - low), F.lit(0.0))


def display_number(c: Column | str, digits: int = 2) -> Column:
    """1234567.891 as '1,234,567.89'."""
    return F.format_number(col(c), digits)
