"""Calendar expressions over DATE columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(d: Column | str) -> Column:
    """First day of the month as a DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(col(d), "MM")


def month_label(d: Column | str) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def date_key(d: Column | str) -> Column:
    """20240131 for 2024-01-31."""
    d = col(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def whole_months(start: Column | str, end: Column | str) -> Column:
    """Calendar months from ``start`` to ``end``, days ignored."""
    start, end = col(start), col(end)
    return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)


def quarter_label(d: Column | str) -> Column:
    return F.concat(F.lit("Q"), F.quarter(col(d)).cast("string"))


def month_name(d: Column | str) -> Column:
    return F.date_format(col(d), "MMMM")


def day_name(d: Column | str) -> Column:
    return F.date_format(col(d), "EEEE")


def week_of_year(d: Column | str) -> Column:
    """ISO week, except that December days in ISO week 1 count as week 53."""
    d = col(d)
    return F.when((F.month(d) == 12) & (F.weekofyear(d) == 1), 53).otherwise(F.weekofyear(d))


def is_weekend(d: Column | str) -> Column:
    return F.when(F.dayofweek(col(d)).isin(1, 7), 1).otherwise(0)


def month_range(first: Column, last: Column) -> Column:
    """Array of month starts from ``first`` to ``last``, both included."""
    return F.sequence(first, last, F.expr("interval 1 month"))
