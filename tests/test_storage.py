"""Checks counted while writing, the stored cube of the month reports, tables stored in buckets."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import model, quality, reports
from ledgerloom.plans import batch, cube
from ledgerloom.sources import sinks
from ledgerloom.sources.testdata import TestModel

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def m(spark):
    return TestModel(spark, FOLDER)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# -- checks -------------------------------------------------------------------------------


def test_watches_equal_the_separate_checks(spark, m, tmp_path):
    watches = batch.table_watches()
    tables = batch.process(m.raw, str(tmp_path), watches=watches)
    counts = {r["table_name"]: r["row_count"] for r in quality.row_counts(tables).collect()}
    assert {name: w.counts()["rows"] for name, w in watches.items()} == counts
    lines = tables["fct_sales"]
    nulls = {r[0]: r[1] for r in quality.check_not_null(lines, ["order_id", "order_date", "customer_id"]).collect()}
    assert {c: watches["fct_sales"].counts()[f"{c} is null"] for c in nulls} == nulls
    assert {r["check_name"] for r in quality.watched(spark, watches).filter("table_name = 'fct_sales'").collect()} == {
        "rows", "order_id is null", "order_date is null", "customer_id is null", "quantity positive", "total_revenue not negative"}
    quality.require_clean({"fct_sales": watches["fct_sales"]})


def test_watch_counts_after_the_last_shuffle(m):
    """Only there a task that runs again does not count again."""
    watch = quality.Watch("fct_sales", ["order_id"])
    text = plan(watch.on(m.fct_sales.hint("rebalance", "order_month")))
    assert text.index("CollectMetrics") < text.index("Exchange")


def test_violations_nulls_and_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (None, -2), (3, None), (4, -1)], "k INT, v INT")
    watch = {"t": quality.Watch("t", ["k", "v"], {"v not negative": F.col("v") >= 0}), "e": quality.Watch("e", ["k"])}
    sinks.write_tables({"t": df, "e": df.limit(0)}, str(tmp_path), watches=watch)
    assert watch["t"].counts() == {"rows": 4, "k is null": 1, "v is null": 1, "v not negative": 2}
    assert watch["e"].counts() == {"rows": 0, "k is null": 0}
    with pytest.raises(ValueError, match=r"t: k is null 1, t: v is null 1, t: v not negative 2, e: rows 0"):
        quality.require_clean(watch)


# -- cube -----------------------------------------------------------------------------------


def test_cube_reads_lines_once_and_reports_read_their_grain(spark, m, tmp_path):
    made = cube.month_cube(cube.starter_rows(m.sales, m.orders, m.products))
    assert len(re.findall(r"ReadSchema: struct<l_orderkey", plan(made))) == 1
    cells = cube.write(made, str(tmp_path))
    for grain in cube.GRAINS:
        text = plan(cube.by_month(cells, grain))
        assert re.search(rf"PartitionFilters: \[[^\]]*grain#\d+ = {grain}\)", text)


def test_cube_tells_unknown_products_and_null_dimensions_apart(spark):
    sales = spark.createDataFrame([(1, 1, 10, 1), (1, 2, 20, 2), (1, 9, 40, 4), (2, 1, 80, 8), (3, 1, 160, 1), (7, 1, 5, 1)],
                                  "order_id INT, product_id INT, revenue INT, quantity INT")
    products = spark.createDataFrame([(1, "a"), (2, None)], "product_id INT, category STRING")
    orders = spark.createDataFrame([(1, "2024-01-05", "x"), (2, "2024-02-01", None), (3, None, "x")], "order_id INT, order_date STRING, region STRING")
    orders = orders.withColumn("order_date", F.to_date("order_date"))
    made = cube.month_cube(cube.starter_rows(sales, orders, products))

    def got(grain):
        rows = cube.by_month(made, grain).drop("units").withColumn("month_start", F.month("month_start")).collect()
        return sorted(map(tuple, rows), key=str)

    assert got("month") == [(1, 70), (2, 80), (None, 160)]
    assert got("region") == [(1, "x", 70), (2, None, 80), (None, "x", 160)]
    assert got("category") == [(1, "a", 10), (1, None, 20), (2, "a", 80), (None, "a", 160)]
    assert got("cell") == [(1, "x", "a", 10), (1, "x", None, 20), (2, None, "a", 80), (None, "x", "a", 160)]
    assert cube.month_cube(cube.starter_rows(sales.limit(0), orders, products)).count() == 0


def test_cube_of_the_sales_table(spark, m):
    cells = cube.month_cube(cube.sales_rows(m.fct_sales))
    total = m.fct_sales.agg(F.sum("total_revenue")).first()[0]
    for grain in ("month", "region"):
        assert cube.by_month(cells, grain).agg(F.sum("revenue")).first()[0] == total
    known = m.fct_sales.filter("category IS NOT NULL").agg(F.sum("total_revenue")).first()[0]
    assert cube.by_month(cells, "category").agg(F.sum("revenue")).first()[0] == known
    shares = reports.seasonality_of(cube.by_month(cells)).agg(F.sum("seasonal_share_pct")).first()[0]
    assert abs(shares - 100) < 0.1


# -- buckets --------------------------------------------------------------------------------


@pytest.mark.parametrize("rows, buckets", [(0, 1), (1, 1), (10, 1), (11, 2), (21, 4), (40, 4), (41, 8)])
def test_bucket_count(rows, buckets):
    assert sinks.bucket_count(rows, rows_per_bucket=10) == buckets


@pytest.fixture
def stored(spark, m):
    names = {"st_items": (m.fct_order_items, 4), "st_orders": (m.order_facts, 4), "st_few": (m.order_facts, 2)}
    yield {n: sinks.write_bucketed(df, n, "order_id", k) for n, (df, k) in names.items()}
    for n in names:
        spark.sql(f"DROP TABLE {n}")


def test_bucketed_tables_join_without_a_shuffle(spark, stored, no_broadcast):
    items, orders = stored["st_items"], stored["st_orders"]
    for joined in (model.join_sales_orders(items, orders), model.items_by_status(items, orders, "F"), items.join(orders, "order_id", "left")):
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert "Exchange" not in plan(model.order_value(items)) and "Exchange" not in plan(model.orders_enriched(orders, model.order_value(items)))


def test_star_moves_orders_but_no_lines(spark, m, stored, no_broadcast, tmp_path):
    customers = m.customers.select("customer_id", "segment", "city").write
    customers.mode("overwrite").parquet(str(tmp_path))
    text = plan(model.fct_sales(stored["st_items"], stored["st_orders"].withColumn("region", F.lit("x")), spark.read.parquet(str(tmp_path))))
    moved = re.findall(r"Exchange hashpartitioning\((\w+)#", text)
    assert sorted(moved) == ["customer_id", "customer_id", "order_id"]  # orders and customers meet, orders go back
    assert "Bucketed: true" in text


def test_other_bucket_numbers_keep_the_lines_in_place(spark, stored, no_broadcast):
    """Few buckets meet many: only the smaller table moves, or the larger one is read in fewer parts."""
    joined = model.join_sales_orders(stored["st_items"], stored["st_few"])
    assert len(re.findall("Exchange hashpartitioning", plan(joined))) <= 1
    assert joined.count() == stored["st_items"].count()


def test_one_file_a_bucket(stored):
    assert len(stored["st_items"].inputFiles()) == 4
