"""The star schema: line metrics, enriched facts and dimensions.

Order keys and dimension keys are unique here (``clean_tables`` makes them so). Joins carry no
broadcast hints: Spark broadcasts a dimension below its size threshold and otherwise shuffles,
splitting skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key, month_label
from ..functions.numbers import or_zero, sum_or_zero

MONEY = "decimal(14,2)"


def with_line_metrics(items: DataFrame) -> DataFrame:
    """Adds line_cost and line_profit (and total_revenue where it is missing).

    A null unit_cost leaves both null, so sums skip the line.
    """
    if "total_revenue" not in items.columns:
        items = with_line_revenue(items)
    return items.withColumn("line_cost", (F.col("quantity") * F.col("unit_cost")).cast(MONEY)).withColumn(
        "line_profit", (F.col("total_revenue") - F.col("line_cost")).cast(MONEY)
    )


def with_line_revenue(items: DataFrame) -> DataFrame:
    return items.withColumn("total_revenue", (F.col("quantity") * F.col("unit_selling_price")).cast(MONEY))


def profit(null_cost: str = "zero") -> Column:
    """revenue - unit_cost * quantity; a null cost is 0 (``zero``) or makes it null (``skip``)."""
    cost = or_zero("unit_cost") if null_cost == "zero" else F.col("unit_cost")
    return F.col("revenue") - cost * F.col("quantity")


def items_enriched(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with product attributes and line metrics; items of unknown products are kept."""
    attributes = products.select("product_id", "unit_cost", "category", "brand", "product_name")
    return with_line_metrics(with_line_revenue(items).join(attributes, "product_id", "left"))


def order_value(items: DataFrame) -> DataFrame:
    """Revenue, profit and item count per order, from enriched items."""
    return items.groupBy("order_id").agg(
        sum_or_zero("total_revenue").alias("order_revenue"),
        sum_or_zero("line_profit").alias("order_profit"),
        F.count("product_id").alias("order_items_count"),
    )


def orders_enriched(orders: DataFrame, values: DataFrame) -> DataFrame:
    """Orders with their totals; an order without items keeps null totals."""
    return orders.join(values, "order_id", "left")


def customer_totals(orders: DataFrame) -> DataFrame:
    """Value, frequency and tenure per customer over enriched orders of every status."""
    totals = orders.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        sum_or_zero("order_revenue").alias("lifetime_value"),
        F.count("order_id").alias("order_frequency"),
        F.try_divide(F.sum("order_revenue").cast("double"), F.count("order_revenue").cast("double")).alias(
            "avg_order_value"
        ),
        sum_or_zero("order_profit").alias("total_profit"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    days = F.datediff("last_order_date", "first_order_date")
    # greatest() skips nulls, hence the guard for a customer without dated orders
    return totals.withColumn("customer_tenure_days", F.when(days.isNotNull(), F.greatest(days, F.lit(1))))


def customers_enriched(customers: DataFrame, totals: DataFrame) -> DataFrame:
    """Customers with their totals; 0 instead of null in the four measures, tenure stays null."""
    measures = ("lifetime_value", "order_frequency", "avg_order_value", "total_profit")
    return customers.join(totals, "customer_id", "left").withColumns({c: or_zero(c) for c in measures})


def customer_features(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return customers_enriched(customers, customer_totals(orders))


def fct_sales(items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Enriched items with the attributes of their order and customer."""
    order_side = orders.select("order_id", "order_date", "customer_id", "region", "order_status")
    customer_side = customers.select("customer_id", "segment", "city")
    # customers join at order grain: far fewer rows than items, and no shuffle of items by customer
    context = order_side.join(customer_side, "customer_id", "left").withColumn("order_month", month_label("order_date"))
    return items.join(context, "order_id", "left")


def build_star(clean: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six processed tables from the five cleaned ones."""
    items = items_enriched(clean["order_items"], clean["products"])
    orders = orders_enriched(clean["orders"], order_value(items))
    return {
        "dim_customers": customer_features(orders, clean["customers"]),
        "dim_products": clean["products"],
        "fct_orders": orders,
        "fct_order_items": items,
        "fct_payments": clean["payments"],
        "fct_sales": fct_sales(items, clean["orders"], clean["customers"]),
    }


def join_sales_orders(sales: DataFrame, orders: DataFrame) -> DataFrame:
    return sales.join(orders, "order_id")


def join_sales_products(sales: DataFrame, products: DataFrame) -> DataFrame:
    return sales.join(products, "product_id")


def fact_sales_enriched(sales: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Sales with order and product attributes, date key and profit; unmatched sales are dropped."""
    joined = join_sales_orders(join_sales_products(sales, products), orders)
    return joined.select(
        "order_id", "order_date", date_key("order_date").alias("order_date_key"), "customer_id",
        "customer_name", "region", "product_id", "product_name", "category", "quantity", "revenue",
        "unit_price", "unit_cost", profit().alias("profit"),
    )


def items_by_status(items: DataFrame, orders: DataFrame, status: str | None) -> DataFrame:
    """Items whose order has the given status."""
    wanted = orders.select("order_id") if status is None else orders.filter(F.col("order_status") == status)
    return items.join(wanted.select("order_id"), "order_id")


def order_totals(sales: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Starter sales per order: revenue, units and, with products, cost.

    Summing per order first lets the join with orders move one row per order instead of one
    per line, and turns distinct order counts into plain counts.
    """
    measures = [F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units")]
    if products is not None:
        sales = sales.join(products.select("product_id", "unit_cost"), "product_id")
        cost = or_zero("unit_cost") * F.col("quantity")
        measures.append(F.sum(cost).alias("cost"))
    return sales.groupBy("order_id").agg(*measures)


def product_totals(sales: DataFrame) -> DataFrame:
    """Starter sales per product, summed before any join with products."""
    return sales.groupBy("product_id").agg(F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units"))
