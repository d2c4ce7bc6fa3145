"""JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import PROCESSED
from .files import read_processed

APP_TABLES = ("fct_sales", "fct_orders", "dim_customers", "dim_products")
BATCH_ROWS = 5000


def jdbc_options(url: str, table: str, **extra: object) -> dict[str, str]:
    return {"url": url, "dbtable": table, **{k: str(v) for k, v in extra.items()}}


def split_options(column: str | None, lower: object, upper: object, parts: int) -> dict[str, object]:
    """Options that read one table over several connections, by ranges of ``column``."""
    if column is None:
        return {}
    return {"partitionColumn": column, "lowerBound": lower, "upperBound": upper, "numPartitions": parts}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    lower: object = None,
    upper: object = None,
    parts: int = 16,
    **extra: object,
) -> DataFrame:
    """A database table. Give a numeric or date ``column`` with bounds to read it in parallel."""
    options = jdbc_options(url, table, **split_options(column, lower, upper, parts), **extra)
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(
    tables: dict[str, DataFrame], url: str, if_exists: str = "replace", connections: int = 16, **extra: object
) -> None:
    """Write tables to a database in batches, over at most ``connections`` connections at a time."""
    if if_exists not in ("replace", "append"):
        raise ValueError("if_exists must be replace or append")
    mode = "overwrite" if if_exists == "replace" else "append"
    for name, df in tables.items():
        options = jdbc_options(url, name, batchsize=BATCH_ROWS, numPartitions=connections, **extra)
        df.write.format("jdbc").options(**options).mode(mode).save()


def read_any(
    spark: SparkSession,
    url: str | None,
    folder: str,
    names: tuple[str, ...] = APP_TABLES,
    splits: dict[str, tuple[str, object, object]] | None = None,
) -> dict[str, DataFrame]:
    """Processed tables from the database if one is configured, else from files.

    ``splits`` gives (column, lower, upper) per table; each table of a database needs one, so that no
    table comes over a single connection.
    """
    if url:
        splits = splits or {}
        unknown = [name for name in names if name not in PROCESSED]
        if unknown:
            raise ValueError(f"no processed tables {', '.join(unknown)}")
        whole = [name for name in names if name not in splits]
        if whole:
            raise ValueError(f"no split column for {', '.join(whole)}")
        return {name: read_jdbc(spark, url, name, *splits[name]) for name in names}
    return read_processed(spark, folder, names)
