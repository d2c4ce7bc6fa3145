"""Readers, writers and the batch run over small files."""

import datetime as dt
import json
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import clean, quality
from ledgerloom.plans import batch, catalog
from ledgerloom.session import clean_scratch, scratch_path, shared_dir
from ledgerloom.sources import files, jdbc, sinks

PRODUCTS = '﻿"product_id","product_name","category","unit_price","unit_cost"\n"P1","Mug, large","Home","62.09","31.00"\n"P2","Say ""hi""","Home","27",""\n'


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_quoted_csv_with_bom(spark, rows, tmp_path):
    path = write(tmp_path / "p.csv", PRODUCTS)
    text = files.read_untyped(spark, path, ["product_id", "product_name", "category", "unit_price", "unit_cost"])
    assert rows(text.select("product_id", "product_name"), "product_id") == [("P1", "Mug, large"), ("P2", 'Say "hi"')]
    typed = files.read_csv(spark, path, schemas.STARTER["products"])
    assert rows(typed.select("unit_price", "unit_cost"), "unit_price") == [(D("27.00"), None), (D("62.09"), D("31.00"))]


def test_csv_columns_are_taken_by_name(spark, rows, tmp_path):
    path = write(tmp_path / "s.csv", "extra,quantity,order_id,revenue,product_id\nx,2,o1,3.50,p1\n")
    assert rows(files.read_csv(spark, path, schemas.STARTER["sales"])) == [("o1", "p1", 2, D("3.50"))]
    with pytest.raises(ValueError, match="customer_id"):
        files.read_csv(spark, path, schemas.STARTER["orders"])


def test_malformed_csv_fails(spark, tmp_path):
    path = write(tmp_path / "s.csv", "order_id,product_id,quantity,revenue\no1,p1,two,3.50\n")
    with pytest.raises(Exception):
        files.read_csv(spark, path, schemas.STARTER["sales"]).collect()


def test_load_csv_into_table(spark, rows, tmp_path):
    path = write(tmp_path / "s.csv", "order_id,product_id,quantity,revenue\no1,p1,2,3.50\n")
    loaded = files.load_csv_table(spark, path, schemas.STARTER["sales"], "loaded_sales")
    assert rows(loaded) == [("o1", "p1", 2, D("3.50"))]
    files.load_csv_table(spark, path, schemas.STARTER["sales"], "loaded_sales", mode="append")
    assert spark.table("loaded_sales").count() == 2
    spark.sql("DROP TABLE loaded_sales")


def test_optional_files(spark, tmp_path):
    missing = files.read_optional(spark, str(tmp_path / "none.csv"), schemas.REPORTS["crm_rfm_summary"])
    assert missing.columns == ["rfm_segment", "customers", "revenue", "avg_recency_days"] and missing.isEmpty()
    with pytest.raises(FileNotFoundError):
        files.read_optional(spark, str(tmp_path / "none.csv"), schemas.KPIS, required=True)


def test_pretty_printed_kpis(spark, tmp_path):
    path = write(tmp_path / "kpis.json", json.dumps({"total_revenue": 1.5, "total_orders": 2}, indent=2))
    one = files.read_kpis(spark, path).first()
    assert (one["total_revenue"], one["total_orders"], one["active_regions"]) == (1.5, 2, None)


def test_first_row_in_file_order_wins_across_splits(spark, tmp_path):
    n = 4000
    lines = ["customer_id,customer_name,email,region,city,signup_date,segment"]
    lines += [f"C{i % 500:04d},name{i},,R,,2024-01-01," for i in range(n)]
    write(tmp_path / "customers_raw.csv", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        raw = files.with_file_position(files.read_csv(spark, str(tmp_path / "customers_raw.csv"), schemas.RAW["customers"]))
        assert raw.rdd.getNumPartitions() > 3
        kept = clean.clean_table("customers", raw.repartition(7))
        wrong = kept.filter(F.col("customer_name") != F.concat(F.lit("name"), F.substring("customer_id", 2, 4).cast("int")))
        assert kept.count() == 500 and wrong.count() == 0 and clean.POSITION not in kept.columns
        assert kept.filter("city = 'Unknown' AND segment = 'Consumer'").count() == 500
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


RAW = {
    "customers": "C1,Ann,a@x,North,Pune,2023-01-01,Corporate\nC2,Bob,b@x,South,,2023-02-01,\nC1,Dup,d@x,East,X,2020-01-01,X\nC3,Cy,c@x,East,Y,2023-03-01,Consumer",
    "products": "P1,Mug,Home,BrandA,10.00,6.00\nP2,Pen,Desk,BrandB,5.00,2.00\nP1,Old,Home,BrandA,1.00,1.00\nP3,Cup,Home,BrandA,8.00,3.00",
    "orders": "\n".join(f"O{i:03d},{2024 + (i // 12) % 2}-{i % 12 + 1:02d}-{i % 27 + 1:02d},C{i % 3 + 1},{'North' if i % 4 else ''},{'Returned' if i % 10 == 9 else 'Delivered'}" for i in range(60)) + "\nO000,2020-01-01,C9,East,Cancelled",
    "order_items": "\n".join(f"O{i:03d},{j},P{(i + j) % 3 + 1},{'' if i == 7 else 2},{10 - j}.50,5.00,{2 * (10 - j) + 1}.00" for i in range(59) for j in (1, 2)) + "\nO000,1,P2,99,1.00,0.00,99.00",
    "payments": "\n".join(f"PAY{i},O{i:03d},2024-01-01,{'Card' if i % 2 else ''},Success,10.00" for i in range(60)),
}


@pytest.fixture
def raw_folder(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, body in RAW.items():
        header = ",".join(c.split()[0] for c in schemas.RAW[name].split(", "))
        write(folder / f"{name}_raw.csv", header + "\n" + body + "\n")
    return str(folder)


def test_batch_run(spark, rows, raw_folder, tmp_path):
    out = str(tmp_path / "out")
    paths = batch.run_batch(spark, raw_folder, out, reference_date="2026-01-01")
    tables = files.read_processed(spark, f"{out}/processed")
    counts = dict(rows(quality.row_counts(tables)))
    assert counts == {"dim_customers": 3, "dim_products": 3, "fct_orders": 60, "fct_order_items": 118, "fct_payments": 60, "fct_sales": 118}
    assert tables["dim_customers"].filter("customer_id = 'C1'").first()["customer_name"] == "Ann"
    assert tables["dim_products"].filter("product_id = 'P1'").first()["product_name"] == "Mug"
    first = tables["fct_orders"].filter("order_id = 'O000'").first()
    assert (first["customer_id"], first["region"], first["order_revenue"]) == ("C1", "Unknown", D("36.00"))
    assert tables["fct_orders"].filter("order_id = 'O059'").first()["order_items_count"] is None
    filled = tables["fct_order_items"].filter("order_id = 'O007'").select("quantity").distinct()
    assert rows(filled) == [(1,)]

    monthly = files.read_report(spark, f"{out}/reports", "monthly_trend")
    assert monthly.count() == 24 and monthly.agg(F.min("order_date")).first()[0] == dt.date(2024, 1, 1)
    kpis = files.read_kpis(spark, paths["kpis"]).first()
    assert kpis["total_orders"] == 54 and kpis["total_customers"] == 3 and kpis["active_regions"] == 2
    assert abs(kpis["total_revenue"] - monthly.agg(F.sum("revenue")).first()[0]) < 1e-6
    assert files.read_report(spark, f"{out}/reports", "sales_forecast").count() == 6
    export = files.read_report(spark, f"{out}/reports", "crm_rfm_export")
    assert export.count() == 3 and export.columns[0] == "customer_id" and len(export.columns) == 16
    summary = files.read_report(spark, f"{out}/reports", "crm_rfm_summary")
    assert summary.agg(F.sum("customers")).first()[0] == 3
    assert spark.read.option("header", True).csv(paths["insights"]).count() == 14

    # reports from the cube and the counts of the writes
    found = {(r[0], r[1]): r[2] for r in rows(files.read_report(spark, f"{out}/reports", "checks"))}
    assert found["fct_sales", "rows"] == 118 and found["fct_orders", "customer_id is null"] == tables["fct_orders"].filter("customer_id IS NULL").count()
    by_region = files.read_report(spark, f"{out}/reports", "region_growth")
    assert by_region.count() > 0 and by_region.filter("prev_revenue IS NULL").isEmpty()
    season = files.read_report(spark, f"{out}/reports", "seasonality")
    assert season.count() == 12 and abs(season.agg(F.sum("seasonal_share_pct")).first()[0] - 100) < 0.1
    for kind in ("region", "category"):
        assert set(files.read_report(spark, f"{out}/reports", f"drop_months_by_{kind}").columns) == {"month_start", kind, "revenue", "units"}

    # the order of the written reports
    def written(name, *columns):
        return rows(files.read_report(spark, f"{out}/reports", name).select(*columns))

    assert written("profit_by_category", "profit") == sorted(written("profit_by_category", "profit"), reverse=True)
    assert written("crm_rfm_summary", "revenue") == sorted(written("crm_rfm_summary", "revenue"), reverse=True)
    assert written("crm_rfm_export", "priority", "monetary") == sorted(written("crm_rfm_export", "priority", "monetary"), key=lambda r: (r[0], -r[1]))
    for name, key in (("monthly_trend", "order_date"), ("sales_forecast", "month"), ("customer_retention_cohorts", "cohort_month")):
        assert written(name, key) == sorted(written(name, key))
    # processed months are laid out so that a month filter reads one folder
    months = spark.read.parquet(f"{out}/processed/fct_sales").filter("order_month = '2024-03'")
    assert "PartitionFilters: [isnotnull(order_month" in months._jdf.queryExecution().executedPlan().toString()


def test_csv_tables_round_trip(spark, rows, tmp_path):
    df = rows.frame([("P1", "a, b", None, "x", D("1.50"), None)], schemas.RAW["products"])
    paths = sinks.write_tables({"dim_products": df}, str(tmp_path), "csv")
    assert rows(files.read_processed(spark, str(tmp_path), ["dim_products"], "csv")["dim_products"]) == rows(df)
    assert sinks.written_counts(spark, {**paths, "absent": str(tmp_path / "no")}, "csv") == {"dim_products": 1}


def test_source_falls_back_to_files(spark, rows, tmp_path):
    df = rows.frame([("P1", "a", "c", "x", D("1.50"), D("1.00"))], schemas.RAW["products"])
    sinks.write_tables({"dim_products": df}, str(tmp_path))
    assert rows(jdbc.read_any(spark, None, str(tmp_path), ("dim_products",))["dim_products"]) == rows(df)


def test_database_tables_are_read_in_parts(spark):
    with pytest.raises(ValueError, match="no processed tables nothing"):
        jdbc.read_any(spark, "jdbc:x", "", ("nothing",))
    with pytest.raises(ValueError, match="no split column for fct_orders"):
        jdbc.read_any(spark, "jdbc:x", "", ("fct_orders",))


def test_whole_numbers_may_be_written_as_decimals(spark, rows, tmp_path):
    path = write(tmp_path / "q.csv", "k,q\na,2.0\nb,2\nc,\nd,-3.00\n")
    assert rows(files.read_csv(spark, path, "k STRING, q INT")) == [("a", 2), ("b", 2), ("c", None), ("d", -3)]
    path = write(tmp_path / "bad.csv", "k,q\na,2.5\n")
    with pytest.raises(Exception, match="not a whole number"):
        files.read_csv(spark, path, "k STRING, q INT").collect()
    assert rows(files.read_csv(spark, path, "k STRING, q INT", strict=False)) == [("a", None)]
    path = write(tmp_path / "text.csv", "k,q\na,x2\n")
    with pytest.raises(Exception):
        files.read_csv(spark, path, "k STRING, q INT").collect()


def test_jdbc_options():
    assert jdbc.jdbc_options("jdbc:x", "t", batchsize=5000) == {"url": "jdbc:x", "dbtable": "t", "batchsize": "5000"}
    assert jdbc.split_options(None, 1, 2, 3) == {}
    assert jdbc.split_options("id", 1, 9, 4)["numPartitions"] == 4
    with pytest.raises(ValueError):
        jdbc.write_jdbc({}, "jdbc:x", if_exists="merge")


@pytest.mark.parametrize("name", ["rfm_sql", "sink_processed", "recommendations", "bulk_load_csv"])
def test_scratch_is_deleted(spark, name):
    catalog.run(name, spark, "/root/testdata/sf0.001").collect()
    clean_scratch(spark)
    left = [p for p in Path(shared_dir(spark)).rglob("*") if p.is_file()]
    assert left == [] and [t for t in spark.catalog.listTables() if t.name.startswith("load_")] == []


def test_shared_folder_comes_from_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    assert scratch_path(spark, "a").startswith(named) and scratch_path(spark, "a") != scratch_path(spark, "a")
