"""Writers for processed tables, reports and key figures."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import Watch
from ..session import delete, freeing, scratch_path
from .files import exists

PARQUET_CODEC = "zstd"
# Facts are laid out by month, which most reports filter or group on.
MONTH_PARTITIONED = {"fct_sales": "order_month"}


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """The rows of ``df`` as a Parquet table in the scratch folder, which goes at the end.

    So the shuffle files that ``df`` takes are gone before those of the next shuffle are written, and what is shuffled inside goes with
    its job. The table takes less disk than the rows in shuffle files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    with freeing(spark):
        df.write.option("compression", PARQUET_CODEC).parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    delete(spark, path)


def write_tables(
    tables: dict[str, DataFrame],
    folder: str,
    fmt: str = "parquet",
    partitions: dict[str, str] | None = None,
    watches: dict[str, Watch] | None = None,
) -> dict[str, str]:
    """Write each table below ``folder``; returns their paths.

    A partitioned table is rebalanced on its partition column first: AQE then cuts large months
    into several files and keeps small ones from being spread over many. It is ``staged`` before, so that its joins and
    this shuffle don't fill the disks at once. A watch of the same name counts rows and violations on the way.
    """
    partitions = (MONTH_PARTITIONED if fmt == "parquet" else {}) if partitions is None else partitions
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{folder}/{name}"
        column = partitions.get(name)
        with staged(df) if column else nullcontext(df) as rows:
            if column:
                rows = rows.hint("rebalance", column)
            if watches and name in watches:
                rows = watches[name].on(rows)
            writer = rows.write.partitionBy(column) if column else rows.write
            if fmt == "csv":
                writer = writer.option("header", True)
            if fmt == "parquet":
                writer = writer.option("compression", PARQUET_CODEC)
            writer.mode("overwrite").format(fmt).save(paths[name])
    return paths


def load_table(df: DataFrame, path: str, how: str = "replace", fmt: str = "parquet") -> str:
    """Write ``df`` as the whole content of ``path`` ("replace") or beside what is there ("append")."""
    modes = {"replace": "overwrite", "append": "append"}
    df.write.mode(modes[how]).format(fmt).save(path)
    return path


def replace_partitions(df: DataFrame, path: str, column: str, values: Sequence[str]) -> None:
    """Give the partitions ``values`` of a partitioned Parquet table the rows of ``df``, and touch no other file.

    ``df`` holds rows of these partitions only. Partitions that have rows are exchanged by a dynamic overwrite,
    the others of ``values`` are deleted. Running it again gives the same table. Rows are ``staged``.
    """
    with staged(df.filter(F.col(column).isin(list(values)))) as rows:
        seen = Observation()  # taken while writing: asking for the values afterwards would read the rows twice
        dealt = rows.hint("rebalance", column).observe(seen, F.collect_set(F.col(column).cast("string")).alias("left"))
        writer = dealt.write.partitionBy(column).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.option("compression", PARQUET_CODEC).parquet(path)
        told = seen.get  # without the entry if Spark found beforehand that nothing is there to count
        left = set(told["left"]) if told.get("left") is not None else {str(r[0]) for r in rows.select(column).distinct().collect()}
    for value in set(values) - left:
        delete(df.sparkSession, f"{path}/{column}={value}")


def bucket_count(rows: int, rows_per_bucket: int = 4_000_000) -> int:
    """Buckets for the largest table of a join: a power of two, so that tables of other sizes can meet it."""
    return 1 << max(0, -(-rows // rows_per_bucket) - 1).bit_length()


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as ``table`` in ``buckets`` sorted by ``key``; returns the table.

    Tables with the same key and number of buckets (or a power of two apart) join on it without a shuffle. The rows
    are dealt as the buckets are, so each bucket is one file, and read back as one task: take ``bucket_count``.
    """
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def write_report(df: DataFrame, folder: str, name: str, single_file: bool = False) -> str:
    """Write a report as CSV with header. ``single_file`` is for reports of a few hundred rows."""
    path = f"{folder}/{name}"
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_kpis(df: DataFrame, path: str) -> str:
    """Write the one-row key figures as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def written_counts(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> dict[str, int]:
    """Rows per written table, read back from the files (Parquet answers from its footers)."""
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    return {name: reader.format(fmt).load(p).count() for name, p in paths.items() if exists(spark, p)}
