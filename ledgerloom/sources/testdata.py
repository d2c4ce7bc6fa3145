"""The order tables under test, seen through the commerce model.

``o_orderstatus`` F stands for delivered, O for cancelled, P for returned.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import model

DELIVERED, CANCELLED, RETURNED = "F", "O", "P"
REFERENCE_DATE = "2002-01-01"
CATEGORIES = ("ECONOMY", "STANDARD", "PROMO", "LARGE", "SMALL", "MEDIUM")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")

# Declared, so that reading a table starts no job to look at its files.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def hundredths(c: str) -> Column:
    """A DOUBLE of two digits as whole hundredths."""
    return F.floor(F.col(c) * 100 + 0.5)


class TestModel:
    """Raw, starter and processed tables over one folder of Parquet files, all lazy."""

    __test__ = False  # not a pytest class

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    # -- raw layer --

    @cached_property
    def customers(self) -> DataFrame:
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return self.table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.lit(None).cast("string").alias("email"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("city"),
            F.lit(None).cast("date").alias("signup_date"),
            F.col("c_mktsegment").alias("segment"),
        )

    @cached_property
    def products(self) -> DataFrame:
        price = F.col("p_retailprice").cast("decimal(12,2)")
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            price.alias("unit_price"),
            (price * F.lit("0.6").cast("decimal(2,1)")).cast("decimal(12,2)").alias("unit_cost"),
        )

    @cached_property
    def products_some_cost(self) -> DataFrame:
        """Products of one category have no known cost."""
        return self.products.withColumn("unit_cost", F.when(F.col("category") != CATEGORIES[0], F.col("unit_cost")))

    @cached_property
    def order_facts(self) -> DataFrame:
        """Orders without their region, which costs a join with customers."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
        )

    @cached_property
    def orders(self) -> DataFrame:
        places = self.customers.select("customer_id", "region")
        return self.order_facts.join(places, "customer_id", "left").select(
            "order_id", "order_date", "customer_id", "region", "order_status"
        )

    @cached_property
    def items(self) -> DataFrame:
        """Lines with a unit price in whole cents, so that quantity x price is exact."""
        quantity = F.col("l_quantity").cast("int")
        cents = F.floor(hundredths("l_extendedprice") / quantity)
        price = (cents.cast("decimal(12,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(12,2)")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("product_id"),
            quantity.alias("quantity"),
            price.alias("unit_selling_price"),
            hundredths("l_discount").cast("decimal(6,2)").alias("discount_pct"),
            (quantity * price).cast("decimal(14,2)").alias("line_revenue"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("payment_id"),
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").cast("date").alias("payment_date"),
            F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("payment_method"),
            F.when(F.col("o_orderstatus") == CANCELLED, "Failed").otherwise("Success").alias("payment_status"),
            F.col("o_totalprice").cast("decimal(14,2)").alias("amount"),
        )

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "products": self.products,
            "orders": self.orders,
            "order_items": self.items,
            "payments": self.payments,
        }

    # -- starter model --

    @cached_property
    def sales(self) -> DataFrame:
        units = hundredths("l_extendedprice") * (100 - hundredths("l_discount"))
        revenue = (units.cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(4,4)")).cast("decimal(18,4)")
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            revenue.alias("revenue"),
        )

    @cached_property
    def named_orders(self) -> DataFrame:
        """Starter orders: with the name and region of the customer."""
        places = self.customers.select("customer_id", "customer_name", "region")
        return self.order_facts.drop("order_status").join(places, "customer_id").select(
            "order_id", "order_date", "customer_id", "customer_name", "region"
        )

    # -- processed layer: the star schema over the raw tables as they are --

    @cached_property
    def priced_items(self) -> DataFrame:
        return model.with_line_revenue(self.items)

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return model.items_enriched(self.items, self.products)

    @cached_property
    def order_value(self) -> DataFrame:
        return model.order_value(self.fct_order_items)

    @cached_property
    def order_facts_enriched(self) -> DataFrame:
        return model.orders_enriched(self.order_facts, self.order_value)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return model.orders_enriched(self.orders, self.order_value)

    @cached_property
    def fct_sales(self) -> DataFrame:
        return model.fct_sales(self.fct_order_items, self.orders, self.customers)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return model.customer_features(self.order_facts_enriched, self.customers)
