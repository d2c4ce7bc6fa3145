"""Sums by month, region and category, made once and read by the month reports.

The lines are read once for the finest cells; coarser sums are made of cells. Stored by grain (``write``), so a
report reads the folder of its own grain only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..sources import sinks

#: What a cell of each grain is made for, beside the month.
GRAINS = {
    "month": (),
    "region": ("region",),
    "category": ("category", "has_product"),
    "cell": ("region", "category", "has_product"),
}


def starter_rows(sales: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Starter sales with the dimensions of the cube, a row per order and category.

    has_product tells lines of unknown products (false) from products without a category.
    """
    known = products.select("product_id", "category", F.lit(True).alias("has_product"))
    lines = sales.join(known, "product_id", "left").withColumn("has_product", F.col("has_product").isNotNull())
    per_order = lines.groupBy("order_id", "category", "has_product").agg(F.sum("revenue").alias("revenue"), F.sum("quantity").alias("units"))
    return per_order.join(orders.select("order_id", "order_date", "region"), "order_id")


def sales_rows(sales: DataFrame) -> DataFrame:
    """``fct_sales`` with the dimensions of the cube; lines without a category count as lines of unknown products."""
    return sales.select(
        "order_date", "region", "category", F.col("category").isNotNull().alias("has_product"),
        F.col("total_revenue").alias("revenue"), F.col("quantity").alias("units"),
    )


def month_cube(rows: DataFrame) -> DataFrame:
    """(grain, month_start, region, category, has_product, revenue, units) of every grain.

    ``rows`` has order_date, region, category, has_product, revenue and units. Columns that a grain sums over are null.
    """
    keys = ["month_start", "region", "category", "has_product"]
    sums = [F.sum("revenue").alias("revenue"), F.sum("units").alias("units")]
    cells = rows.withColumn("month_start", month_start("order_date")).groupBy(*keys).agg(*sums)
    sets = [[F.col(c) for c in ("month_start", *grain)] for grain in GRAINS.values()]
    # One bit for each key that is summed over, the last key lowest.
    bits = {name: sum(1 << i for i, k in enumerate(reversed(keys[1:])) if k not in grain) for name, grain in GRAINS.items()}
    name = F.lit(None).cast("string")
    for grain, mask in bits.items():
        name = F.when(F.col("summed") == mask, grain).otherwise(name)
    cube = cells.groupingSets(sets, *keys).agg(F.grouping_id().alias("summed"), *sums)
    return cube.select(name.alias("grain"), *keys, "revenue", "units")


def write(cube: DataFrame, folder: str) -> DataFrame:
    """Store a cube below ``folder``, laid out by grain, and read it back."""
    path = sinks.write_tables({"month_cube": cube}, folder, partitions={"month_cube": "grain"})["month_cube"]
    return read(cube.sparkSession, path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def by_month(cube: DataFrame, grain: str = "month") -> DataFrame:
    """(month_start, the grain's columns, revenue, units); by category, lines of unknown products are left out."""
    found = cube.filter(F.col("grain") == grain)
    if "has_product" in GRAINS[grain]:
        found = found.filter("has_product")
    return found.select("month_start", *[c for c in GRAINS[grain] if c != "has_product"], "revenue", "units")
