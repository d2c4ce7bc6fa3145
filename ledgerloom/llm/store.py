"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import freeing, shared_dir


def kept(df: DataFrame) -> DataFrame:
    """A checkpoint in the folder that the session names. The shuffles it took leave no files."""
    shared_dir(df.sparkSession)
    with freeing(df.sparkSession):
        return df.select("*").checkpoint()


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files and checkpoints that no frame in use needs.

    It does so when the driver collects its garbage, which may be long after a job of many steps has filled the disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Fewer rows to an Arrow batch while jobs run inside, so that a batch of texts takes little memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
