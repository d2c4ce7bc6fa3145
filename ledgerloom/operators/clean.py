"""Deduplication, default filling, typed casts and filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_DEFAULTS, RAW_KEYS

POSITION = "_position"


def dedupe(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key: the first by ``order_by``.

    Without ``order_by`` the row's file position decides when the reader kept it, else all
    remaining columns in order. Spark keeps one row per key in each map task before the
    shuffle (WindowGroupLimit), so a key with very many copies stays cheap.
    """
    if order_by is None:
        order_by = [POSITION] if POSITION in df.columns else [c for c in df.columns if c not in keys]
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by] or [F.lit(1)]
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn", POSITION)


def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Replace nulls column by column; column types are kept."""
    types = dict(df.dtypes)
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in defaults.items() if c in types}
    )


def cast_schema(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Columns of ``schema`` cast to its types; text that does not parse raises an error."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in _struct(schema)])


def cast_with_rejects(df: DataFrame, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(rows that cast cleanly, original rows with a value that does not)."""
    fields = _struct(schema)
    bad = F.lit(False)
    for f in fields:
        bad = bad | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    good = df.filter(~bad).select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields])
    return good, df.filter(bad)


def _struct(schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def clean_table(name: str, df: DataFrame) -> DataFrame:
    """A raw table without duplicates on its key and without fillable nulls."""
    return fill_defaults(dedupe(df, RAW_KEYS[name]), RAW_DEFAULTS[name])


def clean_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: clean_table(name, df) for name, df in raw.items()}


def by_status(df: DataFrame, status: str | None, column: str = "order_status") -> DataFrame:
    """Rows with the given order status; every row for None."""
    return df if status is None else df.filter(F.col(column) == F.lit(status))


def slice_rows(
    df: DataFrame,
    date_from: str | None = None,
    date_to: str | None = None,
    year: int | None = None,
    date: str = "order_date",
    month: str = "order_month",
    **equal: str | None,
) -> DataFrame:
    """Optional report filters. Dates and years become ranges so that file scans can use them.

    A frame with the month column that belongs to ``date`` is also filtered by months: tables laid out by
    month then read the folders of those months only.
    """
    if year is not None:
        df = slice_rows(df, f"{year:04d}-01-01", f"{year:04d}-12-31", date=date, month=month)
    by_month = date == "order_date" and month in df.columns
    if date_from is not None:
        df = df.filter(F.col(date) >= F.lit(date_from).cast("date"))
        df = df.filter(F.col(month) >= F.lit(date_from[:7])) if by_month else df
    if date_to is not None:
        df = df.filter(F.col(date) <= F.lit(date_to).cast("date"))
        df = df.filter(F.col(month) <= F.lit(date_to[:7])) if by_month else df
    for column, value in equal.items():
        if value is not None:
            df = df.filter(F.col(column) == F.lit(value))
    return df
