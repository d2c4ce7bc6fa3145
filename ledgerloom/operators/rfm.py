"""Recency-frequency-monetary scoring of customers and the CRM export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lookups import crm_action, crm_priority, rfm_segment
from ..functions.numbers import or_zero, ratio
from .clean import by_status
from .ranking import global_scores, ntile_of, quantile_bin_of, top_k

REFERENCE_DATE = "2026-01-01"  # fixed value: the day recency is counted from

# The columns of the CRM export.
EXPORT_COLUMNS = (
    "customer_id", "customer_name", "email", "region", "customer_segment", "last_order_date",
    "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_code",
    "rfm_segment", "priority", "crm_action",
)


def rfm_base(orders: DataFrame, reference_date: str = REFERENCE_DATE, status: str | None = "Delivered") -> DataFrame:
    """Last order, number of orders, revenue and days since the last order per customer."""
    totals = by_status(orders, status).filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count("order_id").alias("frequency"),
        F.sum("order_revenue").alias("monetary"),
    )
    today = F.lit(reference_date).cast("date")
    return totals.withColumn("recency_days", F.datediff(today, F.col("last_order_date")))


def _scored(base: DataFrame, rule) -> DataFrame:
    told = global_scores(base, "customer_id", ["recency_days", "frequency", "monetary"], rule)
    scores = {"r_score": 6 - F.col("recency_days_bucket"), "f_score": F.col("frequency_bucket"), "m_score": F.col("monetary_bucket")}
    scored = told.select(*base.columns, *[c.alias(name) for name, c in scores.items()])
    code = F.concat(*[F.col(c).cast("string") for c in scores])
    return scored.withColumn("rfm_code", code).withColumn("rfm_segment", rfm_segment(*scores))


def rfm_ntile(base: DataFrame) -> DataFrame:
    """Scores 1..5 by NTILE, the most recent customers getting r = 5."""
    return _scored(base, ntile_of)


def rfm_qcut(base: DataFrame) -> DataFrame:
    """Scores 1..5 by quantile edges of the rank, the most recent customers getting r = 5."""
    return _scored(base.withColumn("monetary", or_zero("monetary")), quantile_bin_of)


def rfm_sql(orders: DataFrame, reference_date: str = REFERENCE_DATE, status: str | None = "Delivered") -> DataFrame:
    """NTILE scores and segment per customer, the largest revenue first."""
    scored = rfm_ntile(rfm_base(orders, reference_date, status)).withColumnRenamed("rfm_segment", "segment").select(
        "customer_id", "recency_days", "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_code", "segment"
    )
    return scored.orderBy(F.desc_nulls_last("monetary"), F.asc("customer_id"))


def with_crm_actions(scored: DataFrame) -> DataFrame:
    return scored.withColumn("crm_action", crm_action("rfm_segment")).withColumn(
        "priority", crm_priority("rfm_segment")
    )


def join_customers(scored: DataFrame, customers: DataFrame) -> DataFrame:
    """Scored customers with their contact data; the customer's own segment is renamed first."""
    contact = customers.select(
        "customer_id", "customer_name", "email", "region", F.col("segment").alias("customer_segment")
    )
    return scored.join(contact, "customer_id", "left")


def rfm_crm(
    orders: DataFrame,
    customers: DataFrame,
    reference_date: str = REFERENCE_DATE,
    status: str | None = "Delivered",
    ordered: bool = False,
) -> DataFrame:
    """The CRM export, sorted by priority and then revenue when ``ordered``."""
    scored = with_crm_actions(rfm_qcut(rfm_base(orders, reference_date, status)))
    export = join_customers(scored, customers).select(*EXPORT_COLUMNS)
    return export.orderBy(F.asc("priority"), F.desc("monetary"), F.asc("customer_id")) if ordered else export


def rfm_summary(export: DataFrame) -> DataFrame:
    """Customers, revenue and mean recency per RFM segment."""
    return export.groupBy("rfm_segment").agg(
        F.count("customer_id").alias("customers"),
        F.sum("monetary").alias("revenue"),
        ratio(F.sum("recency_days"), F.count("recency_days")).alias("avg_recency_days"),
    )


def top_rfm_segment(summary: DataFrame) -> DataFrame:
    """The segment with the highest revenue."""
    best = top_k(summary, 1, [F.desc("revenue"), F.asc("rfm_segment")])
    return best.select("rfm_segment", "customers", "revenue")
