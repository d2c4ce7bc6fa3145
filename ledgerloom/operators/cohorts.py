"""Retention of customers by month of first order."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_start, whole_months
from ..functions.numbers import ratio
from .clean import by_status


def active_months(orders: DataFrame, status: str | None = "Delivered") -> DataFrame:
    """Distinct (customer, month): what retention needs of the orders.

    The distinct is pre-aggregated before the shuffle, so a customer with very many orders
    leaves each map task as at most one row per month.
    """
    dated = by_status(orders, status).filter(F.col("customer_id").isNotNull())
    return dated.select("customer_id", month_start("order_date").alias("order_month")).distinct()


def with_first_month(rows: DataFrame, month: str = "order_month") -> DataFrame:
    """Adds each customer's first month; input has at most one row per customer and month."""
    first = F.min(month).over(Window.partitionBy("customer_id"))
    return rows.withColumn("cohort_month", first)


def first_months(orders: DataFrame, status: str | None = "Delivered") -> DataFrame:
    """(customer, first order month)."""
    dated = by_status(orders, status).filter(F.col("customer_id").isNotNull())
    return dated.groupBy("customer_id").agg(month_start(F.min("order_date")).alias("cohort_month"))


def cohort_assign(orders: DataFrame, status: str | None = "Delivered") -> DataFrame:
    """Every order with its customer's first month and the months since.

    First months come from a partial aggregate and a join rather than a window over orders, so
    no customer's orders are gathered in one task.
    """
    dated = by_status(orders, status).withColumn("order_month", month_start("order_date"))
    joined = dated.join(first_months(orders, status), "customer_id", "left")
    return joined.withColumn("cohort_index", whole_months("cohort_month", "order_month"))


def cohort_counts(orders: DataFrame, status: str | None = "Delivered") -> DataFrame:
    """Distinct customers per (cohort month, months since)."""
    rows = with_first_month(active_months(orders, status))
    index = whole_months("cohort_month", "order_month").alias("cohort_index")
    # one row per customer and month, so counting rows counts distinct customers
    return rows.groupBy("cohort_month", index).agg(F.count("*").alias("customers"))


def with_retention(counts: DataFrame) -> DataFrame:
    """Adds the size of the cohort at month 0 and the part of it that is active."""
    at_start = F.when(F.col("cohort_index") == 0, F.col("customers"))
    sized = counts.withColumn("cohort_size", F.max(at_start).over(Window.partitionBy("cohort_month")))
    return sized.withColumn("retention_rate", ratio("customers", "cohort_size"))


def cohort_retention(orders: DataFrame, status: str | None = "Delivered") -> DataFrame:
    return with_retention(cohort_counts(orders, status))


def first_cohort(retention: DataFrame) -> DataFrame:
    """The retention curve of the earliest cohort. Input is one row per pair of months."""
    earliest = F.min("cohort_month").over(Window.partitionBy())
    return retention.withColumn("_earliest", earliest).filter("cohort_month = _earliest").drop("_earliest")


def month_bitmaps(orders: DataFrame, status: str | None = "Delivered") -> DataFrame:
    """(order_month, bucket, bits): the customers with an order in a month, as bitmaps of 32,768 each.

    Orders without a date or a customer are left out. Customer ids are whole numbers given out in turn; wide gaps between them make bitmaps with few bits. Bitmaps
    are built in the map tasks, so a month with very many orders leaves each of them as one row per bucket.
    """
    dated = by_status(orders, status).filter("customer_id IS NOT NULL AND order_date IS NOT NULL")
    number = F.col("customer_id").cast("bigint")
    place = [month_start("order_date").alias("order_month"), F.bitmap_bucket_number(number).alias("bucket")]
    return dated.groupBy(*place).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def known_bitmaps(active: DataFrame, months: Sequence[date]) -> DataFrame:
    """(cohort_month, bucket, bits): the customers with an order in each of ``months`` or before it."""
    later = F.filter(F.array(*[F.lit(m) for m in months]).cast("array<date>"), lambda m: m >= F.col("order_month"))
    spread = active.select(F.explode(later).alias("cohort_month"), "bucket", "bits")
    return spread.groupBy("cohort_month", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(known: DataFrame, active: DataFrame) -> DataFrame:
    """(cohort_month, order_month, customers) from ``known_bitmaps`` and the ``month_bitmaps`` of any months.

    A month shares |known| + |active| - |known or active| customers with those known by a cohort's month;
    what the month before it shares already belongs to earlier cohorts.
    """
    pairs = known.withColumnRenamed("bits", "known").join(active.withColumnRenamed("bits", "active"), "bucket")
    pairs = pairs.filter("cohort_month <= order_month")
    apart = F.bitmap_count("known") + F.bitmap_count("active")
    two = pairs.select("cohort_month", "order_month", "bucket", apart.alias("n"), F.explode(F.array("known", "active")).alias("bits"))
    shared = F.max("n") - F.bitmap_count(F.bitmap_or_agg("bits"))
    each = two.groupBy("cohort_month", "order_month", "bucket").agg(shared.alias("shared"))
    total = each.groupBy("cohort_month", "order_month").agg(F.sum("shared").alias("shared"))
    before = F.lag("shared", 1, 0).over(Window.partitionBy("order_month").orderBy("cohort_month"))
    counts = total.withColumn("customers", F.col("shared") - before).filter("customers > 0")
    return counts.select("cohort_month", "order_month", "customers")
