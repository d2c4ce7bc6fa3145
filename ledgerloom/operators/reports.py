"""Named business reports.

``orders`` with totals are enriched orders (``order_revenue``, ``order_profit``); ``items`` are
enriched items; ``sales``/``orders``/``products`` are the starter tables. Reports derived from
grouped frames leave null keys out, those derived from SQL keep them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_label, month_name, month_start
from ..functions.lookups import region_latitude, region_longitude
from ..functions.numbers import or_zero, percent, ratio, rounded, sum_or_zero
from .clean import by_status, slice_rows
from .model import items_by_status, order_totals, product_totals
from .ranking import top_k
from .timeseries import drops, resample_months, with_growth, with_share


# -- monthly ------------------------------------------------------------------------------


def monthly_trend(orders: DataFrame, status: str | None = "Delivered") -> DataFrame:
    """Revenue, orders and profit per month, empty months included, with growth."""
    monthly = resample_months(
        by_status(orders, status),
        "order_date",
        {
            "revenue": F.sum("order_revenue"),
            "orders": F.count("order_id"),
            "profit": F.sum("order_profit"),
        },
    )
    return with_growth(monthly, "revenue")


def monthly_sales(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue, units, orders and order value per month, with growth on the row before."""
    joined = order_totals(sales).join(orders.select("order_id", "order_date"), "order_id")
    monthly = joined.groupBy(month_start("order_date").alias("month_start")).agg(
        F.sum("revenue").alias("revenue"),
        F.sum("units").alias("units_sold"),
        F.count("*").alias("orders"),
    )
    monthly = monthly.withColumn("month_num", F.month("month_start")).withColumn(
        "aov", F.round(ratio("revenue", "orders"), 2)
    )
    return with_growth(monthly, "revenue", previous="prev_month_revenue", digits=2)


def monthly_orders(orders: DataFrame, status: str | None = "Delivered") -> DataFrame:
    """As ``monthly_sales`` but from enriched orders, with profit; empty months are absent."""
    monthly = by_status(orders, status).groupBy(month_start("order_date").alias("month_start")).agg(
        F.sum("order_revenue").alias("revenue"),
        F.sum("order_profit").alias("profit"),
        F.count("order_id").alias("orders"),
    )
    monthly = monthly.withColumn("avg_order_value", F.round(ratio("revenue", "orders"), 2))
    return with_growth(monthly, "revenue", previous="prev_month_revenue", digits=2)


def monthly_units(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue and units per month with unrounded growth."""
    monthly = monthly_totals(sales, orders).withColumnRenamed("units_sold", "units")
    return with_growth(monthly.drop("orders"), "revenue")


def monthly_totals(sales: DataFrame, orders: DataFrame) -> DataFrame:
    joined = order_totals(sales).join(orders.select("order_id", "order_date"), "order_id")
    return joined.groupBy(month_start("order_date").alias("month_start")).agg(
        F.sum("revenue").alias("revenue"), F.sum("units").alias("units_sold"), F.count("*").alias("orders")
    )


def sales_drop_months(sales: DataFrame, orders: DataFrame, threshold: float = -10, digits: int | None = 2) -> DataFrame:
    """Months whose revenue fell by the threshold or more, compared after rounding to ``digits``."""
    monthly = monthly_totals(sales, orders).withColumnRenamed("units_sold", "units")
    return drops(with_growth(monthly, "revenue", previous="prev_revenue", digits=digits), threshold)


def drop_alerts(sales: DataFrame, orders: DataFrame, threshold: float = -10) -> DataFrame:
    """Drop months as (month, growth to show); the threshold applies to the raw growth."""
    found = drops(monthly_units(sales, orders), threshold)
    return found.select("month_start", F.round("mom_growth_pct", 2).alias("mom_growth_pct"))


def monthly_by_region(sales: DataFrame, orders: DataFrame) -> DataFrame:
    joined = order_totals(sales).join(orders.select("order_id", "order_date", "region"), "order_id")
    return joined.groupBy(month_start("order_date").alias("month_start"), "region").agg(
        F.sum("revenue").alias("revenue")
    )


def monthly_by_category(sales: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per month and category.

    Lines are summed per (order, category) before they meet the orders: a map-side sum, and a
    join that moves a handful of rows per order.
    """
    tagged = sales.join(products.select("product_id", "category"), "product_id")
    per_order = tagged.groupBy("order_id", "category").agg(F.sum("revenue").alias("revenue"))
    joined = per_order.join(orders.select("order_id", "order_date"), "order_id")
    return joined.groupBy(month_start("order_date").alias("month_start"), "category").agg(
        F.sum("revenue").alias("revenue")
    )


def growth_by(monthly: DataFrame, dimension: str) -> DataFrame:
    """Growth of each region or category against its own row before; first rows are left out."""
    out = f"{dimension}_mom_growth_pct"
    grown = with_growth(monthly, "revenue", by=[dimension], previous="prev_revenue", out=out, digits=2)
    return grown.filter(F.col("prev_revenue").isNotNull())


def drop_months_of(monthly_by_dimension: DataFrame, threshold: float = -10) -> DataFrame:
    """Drop months from a (month, region) frame, whose exchange the drill-through can reuse."""
    monthly = monthly_by_dimension.groupBy("month_start").agg(F.sum("revenue").alias("revenue"))
    return drops(with_growth(monthly, "revenue", digits=2), threshold)


def drill_through(monthly_by_dimension: DataFrame, months: DataFrame) -> DataFrame:
    """Region or category rows of the selected months."""
    return monthly_by_dimension.join(months.select("month_start"), "month_start", "left_semi")


def drill_sales(sales: DataFrame, months: DataFrame, by: str = "region") -> DataFrame:
    """Monthly revenue by region or category in the selected months, from a sales table laid out by ``order_month``.

    The months are one row for each calendar month at most, so they are sent to all tasks; the scan then
    leaves out the folders of all other months while it runs.
    """
    wanted = F.broadcast(months.select(month_label("month_start").alias("order_month")).distinct())
    rows = sales.join(wanted, "order_month", "left_semi")
    return rows.groupBy(month_start("order_date").alias("month_start"), by).agg(F.sum("total_revenue").alias("revenue"))


def seasonality(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean monthly revenue per calendar month and its share of the twelve means."""
    return seasonality_of(monthly_totals(sales, orders))


def seasonality_of(monthly: DataFrame) -> DataFrame:
    """``seasonality`` of a frame with month_start and revenue, a row per month."""
    means = (
        monthly.groupBy(F.month("month_start").alias("month_num"))
        .agg(ratio(F.sum("revenue"), F.count("*")).alias("_mean"))
    )
    shared = with_share(means, "_mean", "seasonal_share_pct", digits=2, few_rows=True)
    return shared.select("month_num", F.round("_mean", 2).alias("avg_revenue"), "seasonal_share_pct")


def seasonality_lines(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Mean line revenue per calendar month."""
    per_order = sales.groupBy("order_id").agg(F.sum("revenue").alias("revenue"), F.count("*").alias("lines"))
    joined = per_order.join(orders.select("order_id", "order_date"), "order_id")
    return joined.groupBy(F.month("order_date").alias("month_num")).agg(
        ratio(F.sum("revenue"), F.sum("lines")).alias("avg_revenue")
    )


# -- categories and regions -----------------------------------------------------------------


def _line_totals(items: DataFrame, by: Sequence[str]) -> DataFrame:
    return items.groupBy(*by).agg(
        sum_or_zero("total_revenue").alias("revenue"), sum_or_zero("line_profit").alias("profit")
    )


def profit_by_category(items: DataFrame) -> DataFrame:
    """Revenue, profit and margin per category over all statuses."""
    totals = _line_totals(items.filter(F.col("category").isNotNull()), ["category"])
    return totals.withColumn("profit_margin_pct", percent("profit", "revenue"))


def region_totals(orders: DataFrame) -> DataFrame:
    """Revenue and profit of the lines of each region, from enriched orders.

    Equal to summing fct_sales by region: every line belongs to one order, and orders without
    lines add 0. ``order_items_count`` keeps regions without any line out.
    """
    sold = orders.filter(F.col("region").isNotNull() & F.col("order_items_count").isNotNull())
    return sold.groupBy("region").agg(
        sum_or_zero("order_revenue").alias("revenue"), sum_or_zero("order_profit").alias("profit")
    )


def region_sales(orders: DataFrame) -> DataFrame:
    """Revenue, profit and margin (2 digits, half to even) per region over all statuses."""
    return region_totals(orders).withColumn("margin_pct", rounded(percent("profit", "revenue"), 2, half_even=True))


def region_map(orders: DataFrame, coordinates: dict | None = None) -> DataFrame:
    """Revenue per region with the position to draw it at."""
    revenue = region_totals(orders).select("region", F.col("revenue").alias("total_revenue"))
    return revenue.withColumn("lat", region_latitude("region", coordinates)).withColumn(
        "lon", region_longitude("region", coordinates)
    )


def region_margin(sales: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Starter revenue, profit and margin per region; a missing cost counts as 0."""
    totals = _region_totals_starter(sales, orders, products)
    return totals.select(
        "region",
        F.col("revenue").alias("total_revenue"),
        F.col("profit").alias("total_profit"),
        F.round(percent("profit", "revenue"), 2).alias("profit_margin_pct"),
    )


def pivot_region_margin(sales: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """As ``region_margin`` with the margin as an unrounded fraction."""
    return _region_totals_starter(sales, orders, products).withColumn("margin", ratio("profit", "revenue"))


def _region_totals_starter(sales: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    joined = order_totals(sales, products).join(orders.select("order_id", "region"), "order_id")
    return joined.groupBy("region").agg(
        F.sum("revenue").alias("revenue"), F.sum(F.col("revenue") - F.col("cost")).alias("profit")
    )


def contribution(items: DataFrame, by: str = "category", few_rows: bool = False) -> DataFrame:
    """Revenue, share of all revenue and margin per category (or other item column).

    ``few_rows`` says that the column has few values, as in ``with_share``.
    """
    totals = _line_totals(items.filter(F.col(by).isNotNull()), [by])
    return with_share(totals, "revenue", "revenue_share_pct", few_rows=few_rows).withColumn(
        "profit_margin_pct", percent("profit", "revenue")
    )


def status_rates(orders: DataFrame, returned: str = "Returned", cancelled: str = "Cancelled") -> DataFrame:
    """Part of each region's orders that were returned or cancelled."""

    def rate(status: str) -> Column:
        return ratio(F.count_if(F.col("order_status") == status), F.count("*"))

    return orders.groupBy("region").agg(
        F.count("*").alias("orders"), rate(returned).alias("return_rate"), rate(cancelled).alias("cancel_rate")
    )


# -- products -------------------------------------------------------------------------------


def top_products(sales: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Best products by revenue, with their share of the revenue of all products."""
    totals = product_totals(sales).join(products.select("product_id", "product_name", "category"), "product_id")
    named = totals.select(
        "product_id", "product_name", "category", F.col("units").alias("total_units"),
        F.col("revenue").alias("total_revenue"),
    )
    shared = with_share(named, "total_revenue", "revenue_share_pct", digits=2)
    return top_k(shared, n, [F.desc("total_revenue"), F.asc("product_id")])


def item_product_totals(items: DataFrame, products: DataFrame) -> DataFrame:
    """Units, revenue and profit per product, from items that only have ``total_revenue``.

    Items are summed per product before products are joined, and profit follows from the sums:
    revenue - units * unit_cost is the sum of the line profits, NULL without a unit cost.
    """
    totals = items.groupBy("product_id").agg(
        sum_or_zero("total_revenue").alias("total_revenue"), F.sum("quantity").alias("total_units")
    )
    return with_product(totals, products)


def with_product(totals: DataFrame, products: DataFrame) -> DataFrame:
    """Product totals with name, category and profit."""
    attributes = products.select("product_id", "product_name", "category", "unit_cost")
    cost = F.col("total_units") * F.col("unit_cost")
    return totals.join(attributes, "product_id", "left").withColumn(
        "total_profit", F.col("total_revenue") - cost
    ).drop("unit_cost")


def top_products_by_status(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    status: str | None = "Delivered",
    n: int = 20,
    by: str = "total_revenue",
) -> DataFrame:
    """Best products by ``by`` (total_revenue or total_profit) over orders of one status.

    By revenue, products are joined once the best are known.
    """
    sold = items_by_status(items, orders, status)
    order = [F.desc_nulls_last(by), F.asc("product_id")]
    if by == "total_revenue":
        revenue = sold.groupBy("product_id").agg(sum_or_zero("total_revenue").alias("total_revenue"), F.sum("quantity").alias("total_units"))
        totals = with_product(top_k(revenue, n, order), products).orderBy(*order)
    else:
        totals = top_k(item_product_totals(sold, products), n, order)
    return totals.withColumnRenamed("total_units", "units_sold")


def top_products_all(items: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Best products by revenue over all statuses; products without name or category are left out."""
    totals = item_product_totals(items, products)
    named = totals.filter(F.col("product_name").isNotNull() & F.col("category").isNotNull()).withColumn(
        "total_profit", or_zero("total_profit")
    )
    return top_k(named, n, [F.desc("total_revenue"), F.asc("product_id")])


def top_product_names(items: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """Best product names by revenue; products that share a name count together."""
    totals = item_product_totals(items, products).filter(F.col("product_name").isNotNull())
    named = totals.groupBy("product_name").agg(
        F.sum("total_revenue").alias("total_revenue"), F.sum("total_units").alias("total_units")
    )
    return top_k(named, n, [F.desc("total_revenue"), F.asc("product_name")])


def pivot_top_products(
    sales: DataFrame, orders: DataFrame, products: DataFrame, year: int | None, region: str | None, n: int = 10
) -> DataFrame:
    """Best product names of one year and region."""
    kept = slice_rows(orders, year=year, region=region).select("order_id")
    totals = product_totals(sales.join(kept, "order_id")).join(
        products.select("product_id", "product_name"), "product_id"
    )
    named = totals.groupBy("product_name").agg(F.sum("revenue").alias("revenue"), F.sum("units").alias("units"))
    return top_k(named, n, [F.desc("revenue"), F.asc("product_name")])


# -- customers ------------------------------------------------------------------------------


def customer_ltv(sales: DataFrame, orders: DataFrame, n: int = 20) -> DataFrame:
    """Best customers by revenue; a customer without a name shows its id."""
    totals = order_totals(sales).join(orders.select("order_id", "customer_id", "customer_name"), "order_id")
    per_customer = totals.groupBy("customer_id").agg(
        F.max("customer_name").alias("customer_name"),
        F.count("*").alias("orders_count"),
        F.sum("units").alias("lifetime_units"),
        F.sum("revenue").alias("lifetime_revenue"),
    )
    named = per_customer.withColumn(
        "customer_name", F.coalesce("customer_name", F.col("customer_id").cast("string"))
    ).withColumn("avg_order_value", F.round(ratio("lifetime_revenue", "orders_count"), 2))
    return top_k(named, n, [F.desc("lifetime_revenue"), F.asc("customer_id")])


def top_customers(sales: DataFrame, orders: DataFrame, n: int = 10) -> DataFrame:
    """Best (customer, name) pairs by revenue."""
    totals = order_totals(sales).join(orders.select("order_id", "customer_id", "customer_name"), "order_id")
    per_customer = totals.groupBy("customer_id", "customer_name").agg(
        F.sum("revenue").alias("lifetime_revenue"),
        F.sum("units").alias("lifetime_units"),
        F.count("*").alias("orders_count"),
    )
    return top_k(per_customer, n, [F.desc("lifetime_revenue"), F.asc("customer_id"), F.asc("customer_name")])


def segment_summary(customers: DataFrame) -> DataFrame:
    """Customers and mean lifetime value per customer segment."""
    return customers.filter(F.col("segment").isNotNull()).groupBy("segment").agg(
        F.count("customer_id").alias("customers"),
        ratio(F.sum("lifetime_value"), F.count("lifetime_value")).alias("avg_ltv"),
    )


# -- key figures ----------------------------------------------------------------------------


def kpis(orders: DataFrame, customers: DataFrame, status: str | None = "Delivered") -> DataFrame:
    """One row: delivered revenue, profit, margin, orders and order value; customers; active regions.

    Regions are active when some order of any status has items there. Sums per region come first,
    so one pass over the orders gives the totals and the regions.
    """
    counted = F.lit(True) if status is None else F.col("order_status") == F.lit(status)
    per_region = orders.groupBy("region").agg(
        F.sum(F.when(counted, F.col("order_revenue"))).alias("revenue"),
        F.sum(F.when(counted, F.col("order_profit"))).alias("profit"),
        F.count(F.when(counted, F.col("order_id"))).alias("orders"),
        F.count("order_items_count").alias("sold"),
    )
    totals = per_region.agg(
        sum_or_zero("revenue").alias("revenue"),
        sum_or_zero("profit").alias("profit"),
        sum_or_zero("orders").alias("total_orders"),
        F.count_if(F.col("region").isNotNull() & (F.col("sold") > 0)).alias("active_regions"),
    )
    all_customers = customers.agg(F.count_distinct("customer_id")).scalar()

    def two(c: Column) -> Column:
        return F.bround(or_zero(c.cast("double")), 2)

    return totals.select(
        two(F.col("revenue")).alias("total_revenue"),
        two(F.col("profit")).alias("total_profit"),
        two(percent("profit", "revenue")).alias("profit_margin_pct"),
        "total_orders",
        all_customers.alias("total_customers"),
        two(ratio("revenue", "total_orders")).alias("avg_order_value"),
        "active_regions",
    )


def kpis_starter(sales: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row over the joined starter tables; orders are all orders, also those without sales."""
    joined = order_totals(sales, products).join(orders.select("order_id"), "order_id")
    totals = joined.agg(
        sum_or_zero("revenue").alias("total_revenue"),
        sum_or_zero(F.col("revenue") - F.col("cost")).alias("total_profit"),
        sum_or_zero("units").alias("total_units"),
    )
    all_orders = orders.agg(F.count_distinct("order_id")).scalar()
    return totals.withColumn("total_orders", all_orders).select(
        "*",
        or_zero(ratio("total_revenue", "total_orders")).alias("aov"),
        or_zero(percent("total_profit", "total_revenue")).alias("margin_pct"),
    )



def _measures() -> dict[str, Column]:
    revenue, cost = F.sum("revenue"), sum_or_zero("cost")
    return {
        "total_revenue": revenue,
        "total_units": F.sum("units"),
        "total_orders": F.count("order_id"),
        "aov": ratio(revenue, F.count("order_id")),
        "total_cost": cost,
        "total_profit": revenue - cost,
        "profit_margin": ratio(revenue - cost, revenue),
        "customer_ltv": revenue,
    }


def measures(
    sales: DataFrame, orders: DataFrame, products: DataFrame, by: Sequence[str], names: Sequence[str] | None = None
) -> DataFrame:
    """Dashboard measures per any columns of orders and products.

    Over order columns alone, orders without sales count as orders. With a product column (say the
    category) an order counts in each group it has a line in.
    """
    of_product = [c for c in by if c not in orders.columns]
    if of_product:
        lines = sales.join(products.select("product_id", "unit_cost", *of_product), "product_id")
        cost = or_zero("unit_cost") * F.col("quantity")
        sums = [F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units"), F.sum(cost).alias("cost")]
        rows = orders.join(lines.groupBy("order_id", *of_product).agg(*sums), "order_id")
    else:
        rows = orders.join(order_totals(sales, products), "order_id", "left")
    chosen = {k: v for k, v in _measures().items() if names is None or k in names}
    return rows.groupBy(*by).agg(*[c.alias(name) for name, c in chosen.items()])


def measures_enterprise(orders: DataFrame, by: Sequence[str]) -> DataFrame:
    """Dashboard measures per any columns of enriched orders (one row per order)."""
    revenue, profit = F.sum("order_revenue"), F.sum("order_profit")
    return orders.groupBy(*by).agg(
        revenue.alias("revenue"),
        profit.alias("profit"),
        F.count("order_id").alias("orders"),
        ratio(profit, revenue).alias("margin"),
        ratio(revenue, F.count("order_id")).alias("aov"),
    )


def monthly_by_dimension(sales: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per month and region and per month and category, from one pass over the lines."""
    lines = sales.join(products.select("product_id", "category"), "product_id", "left")
    per_order = lines.groupBy("order_id", "category").agg(F.sum("revenue").alias("revenue"))
    dated = per_order.join(orders.select("order_id", month_start("order_date").alias("month_start"), "region"), "order_id")
    cube = dated.groupBy("month_start", "region", "category").agg(F.sum("revenue").alias("revenue"))
    sides = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value_name")) for c in ("region", "category")])
    rows = cube.select("month_start", "revenue", F.inline(sides))
    return rows.groupBy("month_start", "value_name", "dimension").agg(F.sum("revenue").alias("revenue"))


def total_cost(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Cost of goods per product: units sold times the related unit cost."""
    totals = product_totals(sales).join(products.select("product_id", "unit_cost"), "product_id", "left")
    return totals.select("product_id", "units", (F.col("units") * or_zero("unit_cost")).alias("total_cost"))


# -- pivots ---------------------------------------------------------------------------------


def pivot_revenue(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Revenue with one column per value; values are given, so no extra job looks for them."""
    return df.groupBy(*rows).pivot(column, list(values)).agg(F.sum("revenue"))


def with_year_month(df: DataFrame, month: str = "month_start") -> DataFrame:
    return df.withColumn("year", F.year(month)).withColumn("month_name", month_name(month))


def pivot_monthly_trend(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Revenue, units, orders and order value per (year, month name)."""
    monthly = with_year_month(monthly_totals(sales, orders))
    return monthly.select(
        "year", "month_name", "revenue", F.col("units_sold").alias("units"), "orders",
        ratio("revenue", "orders").alias("aov"),
    )
