"""Physical plans: what must and must not be in them."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import clean, ranking
from ledgerloom.plans import catalog

FOLDER = "/root/testdata/sf0.001"
WRITES = {name for name in catalog.JOBS if name.startswith(("scan_", "sink_", "bulk_"))}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Tables too large to broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(set(catalog.JOBS) - WRITES))
def test_no_cross_joins_and_no_python(spark, no_broadcast, name):
    text = plan(catalog.run(name, spark, FOLDER))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval|MapInPandas|FlatMapGroups", text)


BY_ENTITY = ("rfm_crm_export", "rfm_sql", "recommendations", "top_products_sql", "revenue_share", "customer_ltv", "global_row_number")


@pytest.mark.parametrize("name", BY_ENTITY)
def test_no_window_gathers_customers_or_products(spark, no_broadcast, name):
    """Windows are partitioned by customer or product, or run over one row per file partition."""
    windows = re.findall(r"- Window \[.*", plan(catalog.run(name, spark, FOLDER)))
    for node in windows:
        assert re.search(r"windowspecdefinition\((customer_id|product_id)#|_size#", node), node


def test_scores_are_selected_not_sorted(spark, no_broadcast, monkeypatch):
    """No sort, shuffle or numbering of all customers, and no checkpoint: the written rows are read and compared."""
    monkeypatch.setattr(ranking, "global_row_number", None)
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.checkpoint", None)
    base = spark.range(2000).select(F.col("id").alias("customer_id"), (F.col("id") % 7).alias("recency_days"), "id")
    text = plan(ranking.global_scores(base, "customer_id", ["recency_days", "id"], ranking.ntile_of))
    assert "FileScan parquet" in text and not re.search("Exchange|Sort|Window|Join", text)
    catalog.run("rfm_crm_export", spark, FOLDER)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(catalog.run("monthly_trend_delivered", spark, FOLDER))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(o_orderstatus,F\)", text)
    orders = re.search(r"ReadSchema: struct<(o_orderkey[^>]*)>", text).group(1)
    assert "o_totalprice" not in orders and "o_orderpriority" not in orders
    lines = re.search(r"ReadSchema: struct<(l_orderkey[^>]*)>", text).group(1)
    assert "l_shipdate" not in lines and "l_comment" not in lines
    dates = plan(clean.slice_rows(spark.read.parquet(f"{FOLDER}/orders.parquet"), year=1997, date="o_orderdate"))
    assert "GreaterThanOrEqual(o_orderdate" in dates


def test_monthly_series_reads_its_input_once(spark):
    text = plan(catalog.run("monthly_trend_delivered", spark, FOLDER))
    assert len(re.findall("FileScan parquet", text)) == 3  # orders, lines, parts


def test_first_per_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    for reduced in (clean.dedupe(df, ["k"]), ranking.top_n_per(df, ["k"], [F.desc("id")], 5)):
        text = plan(reduced)
        assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_lines_move_once_on_their_way_to_the_items_table(spark, monkeypatch, tmp_path):
    """Copies of a line and its product meet in one shuffle, by product; before, lines moved by their key and again by product."""
    from ledgerloom.plans import batch
    from ledgerloom.sources import sinks
    from ledgerloom.sources.testdata import TestModel

    plans = {}

    def spy(tables, folder, fmt="parquet", real=sinks.write_tables, **options):
        plans.update({n: df._jdf.queryExecution().executedPlan().toString() for n, df in tables.items()})
        return real(tables, folder, fmt, **options)

    monkeypatch.setattr(sinks, "write_tables", spy)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        raw = TestModel(spark, "/root/testdata/sf0.001").raw
        done = batch.process(raw | {"order_items": raw["order_items"].union(raw["order_items"])}, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(order_id" not in plans["fct_order_items"] and "hashpartitioning(product_id" in plans["fct_order_items"]
    keys = raw["order_items"].select("order_id", "line_no", "product_id").distinct()
    assert done["fct_order_items"].count() == keys.count()
