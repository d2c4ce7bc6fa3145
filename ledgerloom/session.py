"""Session settings and the shared folder that jobs may write intermediate data to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the jobs are written for; ``conf`` adds or replaces entries.

    Shuffle partitions are left to the caller: cores on one machine, a few per core on a
    cluster, where AQE merges the small ones again.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``, or one below the warehouse if unset."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Frames made inside lose their shuffle files as soon as a job on them ends.

    A second job on such a frame is right but shuffles again, so it is for frames that are used once.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


_scratch: dict[str, list[str]] = {}
_tables: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder. ``clean_scratch`` deletes it."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_table(spark: SparkSession, label: str) -> str:
    """A new, unused table name. ``clean_scratch`` drops the table."""
    name = f"{label}_{uuid.uuid4().hex}"
    _tables.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def clean_scratch(spark: SparkSession) -> None:
    """Deletes the session's scratch tables and checkpoints. Frames that read them are lost, so call it last."""
    sc = spark.sparkContext
    for name in _tables.pop(sc.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    paths = _scratch.pop(sc.applicationId, [])
    if sc.getCheckpointDir() is not None:
        paths.append(sc.getCheckpointDir())
        sc.setCheckpointDir(shared_dir(spark))  # a new folder of its own for what comes next
        paths.append(sc.getCheckpointDir())
    for path in paths:
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
