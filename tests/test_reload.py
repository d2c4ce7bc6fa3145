"""Slices of the written sales table, reloaded months, and malformed raw files."""

import hashlib
import re
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import clean, model, reports
from ledgerloom.plans import reload
from ledgerloom.session import shared_dir
from ledgerloom.sources import files, sinks

ORDERS = "order_id STRING, order_date DATE, customer_id STRING, region STRING, order_status STRING"
ITEMS = "order_id STRING, line_no INT, product_id STRING, total_revenue DECIMAL(14,2), category STRING"
CUSTOMERS = "customer_id STRING, segment STRING, city STRING"


def executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shop(spark):
    """36 months, two orders a month, one line each."""
    orders = [(f"o{m}-{k}", f"{2022 + m // 12}-{m % 12 + 1:02d}-1{k}", f"c{k}", "N" if k else "S", "Delivered") for m in range(36) for k in range(2)]
    items = [(o[0], 1, "p", 10 + i, "pens") for i, o in enumerate(orders)]
    text = ORDERS.replace("DATE", "STRING")
    return {
        "orders": spark.createDataFrame(orders, text).withColumn("order_date", F.col("order_date").cast("date")),
        "items": spark.createDataFrame([(*i[:3], None, i[4]) for i in items], ITEMS).withColumn("total_revenue", F.lit(10).cast("decimal(14,2)")),
        "customers": spark.createDataFrame([("c0", "s", "x"), ("c1", "t", "y")], CUSTOMERS),
    }


@pytest.fixture
def sales(spark, shop, tmp_path):
    df = model.fct_sales(shop["items"], shop["orders"], shop["customers"])
    path = sinks.write_tables({"fct_sales": df}, str(tmp_path))["fct_sales"]
    return path, df.schema


def contents(path):
    return {str(p.relative_to(path)): hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(path).rglob("*.parquet")}


def test_slices_read_their_months_only(spark, sales):
    path, schema = sales
    table = spark.read.schema(schema).parquet(path)
    cut = clean.slice_rows(table, "2022-03-05", "2022-05-12", region="S")
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", executed(cut)).group(1)
    assert ">= 2022-03" in filters and "<= 2022-05" in filters
    assert len(cut.inputFiles()) > 3  # of all months, before pruning
    assert sorted(r["order_date"].isoformat() for r in cut.collect()) == ["2022-03-10", "2022-04-10", "2022-05-10"]
    assert clean.slice_rows(table, year=2023).count() == 24
    plain = clean.slice_rows(table.drop("order_month"), "2022-03-05", "2022-05-12", region="S")
    assert sorted(plain.collect()) == sorted(cut.drop("order_month").collect())
    assert clean.slice_rows(table.withColumn("ship", F.col("order_date")), "2022-12-31", "2023-01-31", date="ship").count() == 2


def test_drill_through_prunes_while_it_runs(spark, sales):
    path, schema = sales
    table = spark.read.schema(schema).parquet(path)
    months = table.groupBy(F.trunc("order_date", "MM").alias("month_start")).agg(F.count("*").alias("n")).filter("n = 2 AND month_start < DATE '2022-03-01'")
    out = reports.drill_sales(table, months)
    assert "dynamicpruning" in executed(out)
    assert sorted((r["month_start"].isoformat(), r["region"], int(r["revenue"])) for r in out.collect()) == [
        ("2022-01-01", "N", 10), ("2022-01-01", "S", 10), ("2022-02-01", "N", 10), ("2022-02-01", "S", 10)]


def test_late_orders_change_their_months_only(spark, shop, sales):
    path, schema = sales
    before = contents(path)
    late = spark.createDataFrame([("new", "2022-03-20", "c1", "N", "Delivered"), ("o5-0", "2023-01-02", "c0", "S", "Returned")], ORDERS.replace("DATE", "STRING"))
    late = late.withColumn("order_date", F.col("order_date").cast("date"))
    months = reload.touched_months(late, shop["orders"])
    assert months == ["2022-03", "2022-06", "2023-01"]  # new, moved away, moved to
    orders = reload.with_late(shop["orders"], late, ["order_id"])
    lines = shop["items"].limit(1).withColumn("order_id", F.lit("new"))
    items = reload.with_late(shop["items"], lines, ["order_id", "line_no"])
    for _ in range(2):  # a second run changes nothing more
        reload.reload_sales(items, orders, shop["customers"], months, path)
        table = spark.read.schema(schema).parquet(path)
        want = model.fct_sales(items, orders, shop["customers"])
        assert sorted(table.collect()) == sorted(want.select(*table.columns).collect()) and table.count() == 73
    after = contents(path)
    assert {f: h for f, h in before.items() if f.split("=")[1][:7] not in months} == {f: h for f, h in after.items() if f.split("=")[1][:7] not in months}


def test_a_month_that_empties_goes(spark, shop, sales):
    path, schema = sales
    before = contents(path)
    orders = shop["orders"].filter(~F.col("order_id").startswith("o7-"))
    reload.reload_sales(shop["items"], orders, shop["customers"], ["2022-08"], path)
    assert contents(path) == {f: h for f, h in before.items() if "2022-08" not in f}
    assert spark.read.schema(schema).parquet(path).count() == 70


def test_append_and_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.load_table(spark.range(3), path)
    first = contents(path)
    sinks.load_table(spark.range(2), path, "append")
    assert first.items() <= contents(path).items() and spark.read.parquet(path).count() == 5
    sinks.load_table(spark.range(1), path, "replace")
    assert spark.read.parquet(path).count() == 1
    with pytest.raises(KeyError):
        sinks.load_table(spark.range(1), path, "merge")


DIRTY = """﻿name,id,day,price
"Smith, J.",1,2024-01-01,1.50
"say ""hi\""",2.0,2024-01-02,
"open,3,2024-01-03,2
four,4,2024-01-04
five,5,2024-01-05,1,extra
six,six,2024-01-06,1
seven,7.5,2024-01-07,1
eight,8,2024-02-30,1
nine,9,2024-01-09,cheap

ten,,,
"""


def test_rejects_are_listed_with_their_reason(spark, tmp_path):
    path = tmp_path / "dirty.csv"
    path.write_text(DIRTY, encoding="utf-8")
    schema = "id BIGINT, name STRING, price DECIMAL(12,2), day DATE"
    good, rejects = files.read_quarantined(spark, str(path), schema)
    rows = [tuple(r)[:4] for r in good.orderBy("id").collect()]
    assert [(r[0], r[1], None if r[2] is None else str(r[2]), None if r[3] is None else r[3].isoformat()) for r in rows] == [
        (None, "ten", None, None), (1, "Smith, J.", "1.50", "2024-01-01"), (2, 'say "hi"', None, "2024-01-02")]
    told = {r["line"].split(",")[0]: r["reason"] for r in rejects.collect()}
    assert told == {
        '"open': "open quote", "four": "number of columns", "five": "number of columns", "six": "id: not bigint",
        "seven": "id: not bigint", "eight": "day: not date", "nine": "price: not decimal(12,2)",
    }
    assert rejects.select("file").distinct().first()[0].endswith("dirty.csv")
    out, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    with pytest.raises(ValueError, match="7 of 10 rows"):
        files.load_quarantined(spark, str(path), schema, out, bad)
    assert spark.read.parquet(bad).count() == 7 and not Path(out).exists()
    assert files.load_quarantined(spark, str(path), schema, out, bad, most=0.7).count() == 3
    with pytest.raises(ValueError, match="lacks the columns"):
        files.read_quarantined(spark, str(path), "other INT")


def test_reload_enriches_the_lines_of_its_months(spark, shop, tmp_path, monkeypatch):
    """With products, lines are cut to the months' orders before they meet products; values left are told by the write itself."""
    plain = shop["items"].select("order_id", "line_no", "product_id", F.lit(2).alias("quantity"), F.lit(5).cast("decimal(12,2)").alias("unit_selling_price"))
    products = spark.createDataFrame([("p", "pens", "b", "pen")], "product_id STRING, category STRING, brand STRING, product_name STRING")
    products = products.withColumn("unit_cost", F.lit(3).cast("decimal(12,2)"))
    want = model.fct_sales(model.items_enriched(plain, products), shop["orders"], shop["customers"])
    path = sinks.write_tables({"fct_sales": want}, str(tmp_path))["fct_sales"]
    enriched = []
    monkeypatch.setattr(model, "items_enriched", lambda i, p, real=model.items_enriched: enriched.append(i) or real(i, p))
    reload.reload_sales(plain, shop["orders"], shop["customers"], ["2022-03"], path, products)
    assert [i.count() for i in enriched] == [2]
    table = spark.read.schema(want.schema).parquet(path)
    assert sorted(table.collect()) == sorted(want.select(*table.columns).collect()) and table.count() == 72


def test_replacing_partitions_works_out_the_rows_once(spark, tmp_path):
    path, seen = str(tmp_path / "t"), spark.sparkContext.accumulator(0)

    def told(rows):
        for r in rows:
            seen.add(1)
            yield r

    df = spark.createDataFrame(spark.sparkContext.parallelize([(1, "a"), (2, "b")], 2).mapPartitions(told), "x INT, k STRING")
    spark.createDataFrame([(9, "c"), (8, "d")], "x INT, k STRING").write.partitionBy("k").parquet(path)
    sinks.replace_partitions(df, path, "k", ["a", "b", "c"])
    assert seen.value == 2
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b"), (8, "d")]


def test_shuffle_files_go_with_their_write(spark, shop, tmp_path):
    """The joins of the sales table, the deal by month and the months of late orders leave no shuffle files and no staged rows."""

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {f for f in files.split("\n") if "/shuffle_" in f}

    orders = shop["orders"].repartition(3, "order_id")
    before, scratch = shuffled(), set(Path(shared_dir(spark).removeprefix("file:")).glob("staged-*"))
    seen = []
    staged = sinks.staged

    @contextmanager
    def told(df):
        with staged(df) as rows:
            seen.append(len(shuffled() - before))
            yield rows

    with pytest.MonkeyPatch.context() as m:
        m.setattr(sinks, "staged", told)
        path = sinks.write_tables({"fct_sales": model.fct_sales(shop["items"], orders, shop["customers"])}, str(tmp_path))["fct_sales"]
        months = reload.touched_months(orders.filter("order_id < 'o2'"), orders)
        reload.reload_sales(shop["items"], orders, shop["customers"], months, path)
    assert seen == [0, 0] and not shuffled() - before
    assert set(Path(shared_dir(spark).removeprefix("file:")).glob("staged-*")) == scratch
    assert spark.read.parquet(path).count() == 72


def test_writing_by_partition_leaves_no_shuffle_files(spark, tmp_path):
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").count("/shuffle_")
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n")).repartition(5, "n")
    before = files()
    sinks.write_tables({"t": df}, str(tmp_path), partitions={"t": "k"})
    assert files() <= before and spark.read.parquet(str(tmp_path / "t")).count() == 7
