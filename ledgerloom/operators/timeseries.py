"""Month series without gaps, growth measures, the calendar dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.numbers import growth_percent, percent, rounded


def date_bounds(df: DataFrame, date: str = "order_date") -> DataFrame:
    return df.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def resample_months(
    df: DataFrame, date: str, measures: dict[str, Column], by: Sequence[str] = (), month: str = "month_start"
) -> DataFrame:
    """Measures per month from the first to the last month (of each ``by`` group); 0 in empty months.

    Each month with rows also stands in for the empty months up to the next one, so neither a
    calendar join nor a second pass for its bounds is needed.
    """
    dated = df.filter(F.col(date).isNotNull())
    monthly = dated.groupBy(*by, dates.month_start(date).alias("_from")).agg(
        *[c.alias(name) for name, c in measures.items()]
    )
    next_month = F.lead("_from").over(Window.partitionBy(*by).orderBy("_from"))
    until = F.coalesce(F.add_months(next_month, -1), F.col("_from"))
    filled = monthly.withColumn("_until", until).withColumn(
        month, F.explode(dates.month_range(F.col("_from"), F.col("_until")))
    )
    values = [
        F.coalesce(F.when(F.col(month) == F.col("_from"), F.col(name)), F.lit(0)).alias(name) for name in measures
    ]
    return filled.select(*by, month, *values)


def with_growth(
    df: DataFrame,
    value: str,
    month: str = "month_start",
    by: Sequence[str] = (),
    mode: str = "lag",
    previous: str | None = None,
    out: str = "mom_growth_pct",
    digits: int | None = None,
    months_back: int = 1,
) -> DataFrame:
    """Percent change of ``value`` against an earlier month of the same ``by`` group.

    ``lag`` compares with the row before, whichever month that is. ``calendar`` compares with
    the calendar month ``months_back`` earlier and is NULL where that month has no row. On a
    series from ``resample_months`` the two agree. Input is one row per month and group, so the
    window without ``by`` sorts a few hundred rows at most.
    """
    if mode == "lag":
        before = F.lag(value).over(Window.partitionBy(*by).orderBy(month))
    elif mode == "calendar":
        index = F.year(month) * 12 + F.month(month)
        then = Window.partitionBy(*by).orderBy(index).rangeBetween(-months_back, -months_back)
        before = F.max(value).over(then)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    name = previous or "_previous"
    grown = df.withColumn(name, before).withColumn(out, rounded(growth_percent(value, name), digits))
    return grown if previous else grown.drop(name)


def drops(df: DataFrame, threshold: float = -10, growth: str = "mom_growth_pct") -> DataFrame:
    """Months whose growth is at or below the threshold; months without growth are left out."""
    return df.filter(F.col(growth) <= F.lit(threshold))


def flag_below(df: DataFrame, limit: float, growth: str = "mom_growth_pct", out: str = "is_low") -> DataFrame:
    """Marks rows strictly below the limit."""
    return df.withColumn(out, F.coalesce(F.col(growth) < F.lit(limit), F.lit(False)))


def with_share(
    df: DataFrame, value: str, out: str = "share_pct", digits: int | None = None, few_rows: bool = False
) -> DataFrame:
    """Each row's part of the total of ``value`` in percent.

    A window over all rows would bring them to one task, so it is used only for ``few_rows``
    (months, categories, regions). Otherwise the total is a scalar subquery over the same frame: it
    comes from partial sums, and what the two have in common is shuffled once.
    """
    if few_rows:
        total = F.sum(value).over(Window.partitionBy())
    else:
        total = df.agg(F.sum(value)).scalar()
    return df.withColumn(out, rounded(percent(F.col(value), total), digits))


DEFAULT_CALENDAR = ("2024-01-01", "2025-12-31")  # fixed values used when there are no orders


def calendar_columns(d: Column) -> list[Column]:
    return [
        dates.date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        dates.quarter_label(d).alias("quarter"),
        F.month(d).alias("month_num"),
        dates.month_name(d).alias("month_name"),
        dates.week_of_year(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        dates.day_name(d).alias("day_name"),
        dates.is_weekend(d).alias("is_weekend"),
    ]


def date_dimension(bounds: DataFrame) -> DataFrame:
    """One row per day between min_date and max_date of ``bounds`` (see ``date_bounds``)."""
    low, high = (F.lit(x).cast("date") for x in DEFAULT_CALENDAR)
    empty = F.col("min_date").isNull()
    first = F.when(empty, low).otherwise(F.col("min_date"))
    last = F.when(empty, high).otherwise(F.col("max_date"))
    days = bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("_day"))
    return days.select(*calendar_columns(F.col("_day")))


def with_calendar(df: DataFrame, calendar: DataFrame, date: str = "order_date") -> DataFrame:
    """Rows joined with the calendar row of their date."""
    return df.join(calendar.withColumnRenamed("date", date), date)
