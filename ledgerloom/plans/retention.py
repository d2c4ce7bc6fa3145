"""Retention kept in tables that grow by a month: a new month needs its own orders and bitmaps, no earlier order."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_start, whole_months
from ..operators import cohorts
from ..sources import sinks

SCHEMAS = {
    "active": "bucket BIGINT, bits BINARY, order_month DATE",
    "known": "bucket BIGINT, bits BINARY, cohort_month DATE",
    "counts": "cohort_month DATE, customers BIGINT, order_month DATE",
}


def stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table below ``path``; each is laid out by its last column."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{path}/{name}")


def build(orders: DataFrame, path: str, status: str | None = "Delivered") -> None:
    """Write the tables of all months of ``orders`` anew.

    active has the bitmaps of each month's customers, known those of all customers up to a month, counts the
    customers of each pair of months. Their size grows with customers times months, not with orders.
    """
    spark = orders.sparkSession

    def write(name: str, df: DataFrame) -> DataFrame:
        month = SCHEMAS[name].split()[-2]
        df.hint("rebalance", month).write.partitionBy(month).mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{name}")
        return stored(spark, path, name)

    active = write("active", cohorts.month_bitmaps(orders, status))
    months = sorted(r[0] for r in active.select("order_month").distinct().collect())  # calendar months
    known = write("known", cohorts.known_bitmaps(active, months))
    write("counts", cohorts.bitmap_counts(known, active))


def add_month(orders: DataFrame, path: str, month: date, status: str | None = "Delivered") -> None:
    """Add ``month``, of which ``orders`` has all orders, to the tables; orders of other months are left out.

    It reads no order and no counts of the months before. The last stored month may be given again, and is
    replaced, as after a run that was lost half-way. Earlier ones raise: they change all later cohorts.
    """
    spark = orders.sparkSession
    known = stored(spark, path, "known")
    last = known.agg(F.max("cohort_month")).first()[0]
    if last is not None and last > month:
        raise ValueError(f"{month} is earlier than the last stored month {last}: build the tables anew")
    own = orders.filter(month_start("order_date") == F.lit(month))
    at = [str(month)]
    sinks.replace_partitions(cohorts.month_bitmaps(own, status).select("bucket", "bits", "order_month"), f"{path}/active", "order_month", at)
    active = stored(spark, path, "active").filter(F.col("order_month") == F.lit(month))
    earlier = known.filter(F.col("cohort_month") < F.lit(month))
    before = earlier.agg(F.max("cohort_month")).first()[0]
    both = earlier.filter(F.col("cohort_month") == F.lit(before).cast("date")).select("bucket", "bits").union(active.select("bucket", "bits"))
    upto = both.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits")).withColumn("cohort_month", F.lit(month))
    sinks.replace_partitions(upto, f"{path}/known", "cohort_month", at)
    counts = cohorts.bitmap_counts(stored(spark, path, "known").filter(F.col("cohort_month") <= F.lit(month)), active)
    sinks.replace_partitions(counts, f"{path}/counts", "order_month", at)


def retention(spark: SparkSession, path: str) -> DataFrame:
    """The retention table of all stored months."""
    index = whole_months("cohort_month", "order_month").alias("cohort_index")
    return cohorts.with_retention(stored(spark, path, "counts").select("cohort_month", index, "customers"))
