"""Late data: rebuild the months of the sales table that it changes, and nothing else."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_label
from ..operators import model
from ..session import freeing
from ..sources import sinks


def touched_months(late: DataFrame, known: DataFrame | None = None) -> list[str]:
    """Months of late orders, and those that their earlier versions in ``known`` were in."""
    with freeing(late.sparkSession):
        months = late.select(month_label("order_date").alias("month"))
        if known is not None:
            moved = known.join(late.select("order_id"), "order_id", "left_semi")
            months = months.union(moved.select(month_label("order_date")))
        return sorted(r[0] for r in months.filter("month IS NOT NULL").distinct().collect())  # calendar months


def with_late(known: DataFrame, late: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``known`` with the rows of ``late``, which replace those of the same key."""
    return known.join(late.select(*keys).distinct(), list(keys), "left_anti").unionByName(late)


def reload_sales(
    items: DataFrame, orders: DataFrame, customers: DataFrame, months: Sequence[str], path: str, products: DataFrame | None = None
) -> None:
    """Rebuild ``months`` of the written sales table from enriched items, orders and customers.

    Orders are cut to the months before they meet the lines, and only lines of these orders are joined. With
    ``products``, ``items`` are the plain lines, and only those of these orders are enriched.
    """
    orders = orders.filter(month_label("order_date").isin(list(months)))
    own = items.join(orders.select("order_id"), "order_id", "left_semi")
    own = own if products is None else model.items_enriched(own, products)
    sinks.replace_partitions(model.fct_sales(own, orders, customers), path, "order_month", months)
