"""Every job under its name, over the test tables. Each entry is (TestModel) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import dates, lookups, numbers
from ..operators import clean, cohorts, forecast, insights, model, quality, ranking, recommend, reports, rfm, timeseries
from ..session import scratch_path, scratch_table
from ..sources import files, jdbc, sinks
from ..sources.testdata import CANCELLED, CATEGORIES, DELIVERED, REFERENCE_DATE, REGIONS, RETURNED, TestModel
from . import batch, cube, reload, retention

Job = Callable[[TestModel], DataFrame]
JOBS: dict[str, Job] = {}


def job(name: str) -> Callable[[Job], Job]:
    def add(f: Job) -> Job:
        JOBS[name] = f
        return f

    return add


def plain_types(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for comparing and printing."""
    return df.select(
        [
            F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return plain_types(JOBS[name](TestModel(spark, folder)))


# -- sources and sinks: written to the shared folder, read back whole -----------------------


def _typed(m: TestModel, name: str, df: DataFrame) -> DataFrame:
    return clean.cast_schema(df, schemas.PROCESSED[name])


def _write_raw(m: TestModel) -> str:
    folder = scratch_path(m.spark, "raw")
    for name, df in m.raw.items():
        sinks.write_report(df, folder, f"{name}_raw.csv")
    return folder


# a money column of each raw table that has one
RAW_AMOUNTS = {"products": "unit_price", "order_items": "line_revenue", "payments": "amount"}


@job("scan_raw")
def _(m):
    # rows, distinct keys and a sum of each of the five tables, from what was read back
    parts = []
    for name, df in files.read_raw(m.spark, _write_raw(m)).items():
        amount = F.sum(RAW_AMOUNTS[name]).cast("double") if name in RAW_AMOUNTS else F.lit(None).cast("double")
        keys = F.count_distinct(*schemas.RAW_KEYS[name])
        parts.append(df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), keys.alias("n_keys"), amount.alias("amount")))
    return reduce(DataFrame.unionByName, parts)


def _write_processed(m: TestModel, fmt: str = "parquet") -> str:
    folder = scratch_path(m.spark, "processed")
    tables = {"fct_orders": m.fct_orders, "dim_customers": m.dim_customers}
    sinks.write_tables({n: _typed(m, n, df) for n, df in tables.items()}, folder, fmt)
    return folder


@job("scan_processed")
def _(m):
    return files.read_processed(m.spark, _write_processed(m), ["fct_orders"])["fct_orders"]


@job("scan_with_fallback")
def _(m):
    return jdbc.read_any(m.spark, None, _write_processed(m), ("dim_customers",))["dim_customers"]


@job("scan_reports")
def _(m):
    folder = scratch_path(m.spark, "reports")
    trend = reports.monthly_trend(m.order_facts_enriched, DELIVERED).withColumnRenamed("month_start", "order_date")
    sinks.write_report(trend.select(*T.StructType.fromDDL(schemas.REPORTS["monthly_trend"]).names), folder, "monthly_trend", True)
    return files.read_report(m.spark, folder, "monthly_trend")


@job("sink_report_csv")
def _(m):
    folder = scratch_path(m.spark, "reports")
    sinks.write_report(reports.profit_by_category(m.fct_order_items), folder, "profit_by_category", True)
    return files.read_report(m.spark, folder, "profit_by_category")


def _kpi_file(m: TestModel) -> str:
    return sinks.write_kpis(JOBS["kpis"](m), scratch_path(m.spark, "kpis"))


@job("sink_kpi_json")
def _(m):
    return m.spark.read.schema(schemas.KPIS).json(_kpi_file(m))


@job("scan_kpi_json")
def _(m):
    return files.read_kpis(m.spark, _kpi_file(m))


@job("scan_optional")
def _(m):
    folder = scratch_path(m.spark, "optional")
    name, schema = "customers", schemas.RAW["customers"]
    sinks.write_report(m.customers, folder, name)
    found = files.read_optional(m.spark, f"{folder}/{name}", schema)
    missing = files.read_optional(m.spark, f"{folder}/absent", schema)
    return found.unionByName(missing)


@job("bulk_load_csv")
def _(m):
    path = sinks.write_report(m.products, scratch_path(m.spark, "load"), "products")
    return files.load_csv_table(m.spark, path, schemas.STARTER["products"], scratch_table(m.spark, "load"))


@job("scan_untyped_csv")
def _(m):
    path = sinks.write_report(m.sales, scratch_path(m.spark, "untyped"), "sales")
    text = files.read_untyped(m.spark, path, ["order_id", "product_id", "quantity", "revenue"])
    return clean.cast_schema(text, "order_id STRING, product_id STRING, quantity INT, revenue DOUBLE")


@job("sink_processed")
def _(m):
    folder = scratch_path(m.spark, "star")
    return quality.row_counts(batch.process(m.raw, folder))


def _written_sales(m: TestModel, sales: DataFrame) -> DataFrame:
    path = sinks.write_tables({"fct_sales": sales}, scratch_path(m.spark, "sales"))["fct_sales"]
    return m.spark.read.schema(sales.schema).parquet(path)


@job("sales_slice")
def _(m):
    kept = clean.slice_rows(_written_sales(m, m.fct_sales), "1996-03-01", "1999-06-30", region="ASIA", category="PROMO", year=1997)
    return kept.select("order_id", "line_no", "product_id", "order_date", "total_revenue")


@job("sales_drillthrough")
def _(m):
    monthly = reports.monthly_by_region(m.sales, m.orders)
    months = reports.drop_months_of(monthly)
    return reports.drill_sales(_written_sales(m, m.fct_sales), months, "region")


@job("sales_reload")
def _(m):
    # lines of a third of the orders of half a year come late, some orders first stood in another month
    months_off = F.when(F.col("customer_id") % 2 == 0, F.add_months("order_date", 1)).otherwise(F.col("order_date"))
    late = m.fct_orders.filter("order_date BETWEEN DATE '1995-02-01' AND DATE '1995-07-31' AND order_id % 3 = 0")
    early = m.fct_orders.withColumn("order_date", F.when(F.col("order_id") % 3 == 0, months_off).otherwise(F.col("order_date")))
    early = m.fct_orders.join(late.select("order_id"), "order_id", "left_anti").unionByName(early.join(late.select("order_id"), "order_id", "left_semi"))
    some = m.fct_order_items.join(late.filter("customer_id % 3 = 0").select("order_id"), "order_id", "left_anti")
    folder = scratch_path(m.spark, "sales")
    path = sinks.write_tables({"fct_sales": model.fct_sales(some, early, m.customers)}, folder)["fct_sales"]
    orders = reload.with_late(early, late, ["order_id"])
    reload.reload_sales(m.items, orders, m.customers, reload.touched_months(late, early), path, m.products)
    return m.spark.read.schema(m.fct_sales.schema).parquet(path)


@job("quarantine_rejects")
def _(m):
    # every 7th order has an open quote, every 11th a column too many, every 13th no number as its key
    id_text = F.when(F.col("order_id") % 13 == 0, F.concat(F.lit("x"), F.col("order_id").cast("string"))).otherwise(F.col("order_id").cast("string"))
    line = F.concat_ws(",", id_text, F.col("order_date").cast("string"), F.col("customer_id").cast("string"))
    line = F.when(F.col("order_id") % 7 == 0, F.concat(line, F.lit('"'))).when(F.col("order_id") % 11 == 0, F.concat(line, F.lit(",more"))).otherwise(line)
    path = scratch_path(m.spark, "dirty")
    raw = {"header": True, "sep": "\u0001", "quote": ""}  # lines as they are
    m.orders.select(line.alias("order_id,order_date,customer_id")).write.options(**raw).csv(path)
    good, rejects = files.read_quarantined(m.spark, path, "customer_id BIGINT, order_id BIGINT, order_date DATE")
    told = rejects.groupBy("reason").agg(F.count("*").alias("n_rows"), F.max(F.length("line")).cast("bigint").alias("longest"))
    kept = good.agg(F.lit("good").alias("reason"), F.count("*").alias("n_rows"), F.max("order_id").alias("longest"))
    return told.unionByName(kept)


@job("sink_row_counts")
def _(m):
    folder = scratch_path(m.spark, "star")
    paths = {name: f"{folder}/{name}" for name in batch.process(m.raw, folder)}
    counts = sinks.written_counts(m.spark, paths)
    return m.spark.createDataFrame(list(counts.items()), "table_name STRING, row_count BIGINT")


# -- cleaning, projections, filters ---------------------------------------------------------


@job("dedupe_keep_first")
def _(m):
    return clean.dedupe(m.items, schemas.RAW_KEYS["order_items"])


@job("fill_defaults")
def _(m):
    return clean.fill_defaults(m.payments, schemas.RAW_DEFAULTS["payments"])


@job("cast_types")
def _(m):
    # the starter sales as text, plus an amount with a letter in front for one category of lines
    text = m.sales.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.when(F.col("quantity") > 45, F.concat(F.lit("x"), F.col("quantity"))).otherwise(F.col("quantity").cast("string")).alias("quantity"),
        F.col("revenue").cast("string").alias("revenue"),
    )
    good, rejects = clean.cast_with_rejects(text, "order_id BIGINT, quantity INT, revenue DOUBLE")
    kept = good.agg(
        F.lit("kept").alias("part"), F.count("*").alias("n_rows"), F.sum("quantity").alias("units"),
        F.max("revenue").alias("max_revenue"),
    )
    refused = rejects.agg(
        F.lit("rejected").alias("part"), F.count("*").alias("n_rows"),
        F.sum(F.substring("quantity", 2, 9).cast("int")).alias("units"),
        F.max(F.col("revenue").cast("double")).alias("max_revenue"),
    )
    return kept.unionByName(refused)


@job("line_metrics")
def _(m):
    items = model.items_enriched(m.items, m.products_some_cost)
    return items.select("order_id", "line_no", "product_id", "quantity", "total_revenue", "line_cost", "line_profit")


@job("profit_null_cost_zero")
def _(m):
    joined = model.join_sales_products(m.sales, m.products_some_cost)
    return joined.select(
        "order_id", "product_id", model.profit("zero").alias("profit_zero"), model.profit("skip").alias("profit_skip")
    )


@job("filter_status")
def _(m):
    return clean.by_status(m.order_facts, DELIVERED)


@job("filter_slicers")
def _(m):
    kept = clean.slice_rows(
        m.fct_sales, "1996-03-01", "1999-06-30", region="ASIA", category="PROMO", segment="BUILDING"
    )
    by_year = clean.slice_rows(kept, year=1997)
    return by_year.select("order_id", "line_no", "product_id", "order_date", "total_revenue")


@job("filter_drop_threshold")
def _(m):
    monthly = reports.monthly_orders(m.order_facts_enriched, DELIVERED)
    return timeseries.drops(monthly).select("month_start", "mom_growth_pct")


@job("filter_not_null")
def _(m):
    monthly = reports.monthly_sales(m.sales, m.order_facts)
    return monthly.filter(F.col("prev_month_revenue").isNotNull()).select("month_start", "revenue", "prev_month_revenue")


@job("select_subset")
def _(m):
    return m.orders.select("order_id", "order_date", "customer_id", "region", "order_status")


@job("rename_on_collision")
def _(m):
    # every order keeps its own status next to the segment of its customer under a new name
    scored = m.order_facts.select("customer_id", "order_id", F.col("order_status").alias("segment"))
    return rfm.join_customers(scored, m.customers).drop("email")


@job("rfm_segment_case")
def _(m):
    scored = rfm.rfm_qcut(rfm.rfm_base(m.order_facts_enriched, REFERENCE_DATE, DELIVERED))
    grid = scored.select(F.col("r_score").alias("r"), F.col("f_score").alias("f"), F.col("m_score").alias("m"))
    return grid.groupBy("r", "f", "m").agg(F.count("*").alias("n_rows")).withColumn(
        "segment", lookups.rfm_segment("r", "f", "m")
    )


@job("lookup_map")
def _(m):
    segments = JOBS["rfm_segment_case"](m).withColumnRenamed("segment", "rfm_segment")
    return rfm.with_crm_actions(segments).groupBy("rfm_segment", "crm_action", "priority").agg(
        F.sum("n_rows").alias("n_rows")
    )


# positions of three of the five test regions; the other two get the default
TEST_COORDINATES = {"AFRICA": (1.5, 20.25), "ASIA": (35.0, 100.5), "EUROPE": (50.75, 10.0)}


@job("lookup_map_default")
def _(m):
    return reports.region_map(m.fct_orders, TEST_COORDINATES)


@job("clip_lower")
def _(m):
    return model.customer_totals(m.order_facts_enriched).select("customer_id", "customer_tenure_days")


@job("zero_fill_metrics")
def _(m):
    # totals over delivered orders: some customers have none
    delivered = clean.by_status(m.order_facts_enriched, DELIVERED)
    return model.customers_enriched(m.customers, model.customer_totals(delivered)).select(
        "customer_id", "lifetime_value", "order_frequency", "avg_order_value", "total_profit", "customer_tenure_days"
    )


@job("flag_negative_mom")
def _(m):
    monthly = reports.monthly_units(m.sales, m.order_facts)
    flagged = timeseries.flag_below(timeseries.flag_below(monthly, -10, out="is_red"), 0, out="is_negative")
    return flagged.select("month_start", "is_red", "is_negative")


@job("sample_base")
def _(m):
    base = model.fact_sales_enriched(m.sales, m.named_orders, m.products)
    return ranking.top_k(base, 5, [F.asc(c) for c in ("order_id", "product_id", "quantity", "revenue")])


# -- quality --------------------------------------------------------------------------------


@job("check_not_null")
def _(m):
    return quality.check_not_null(
        m.payments, ["payment_id", "order_id", "payment_date", "payment_method", "payment_status", "amount"]
    )


@job("check_unique")
def _(m):
    return quality.check_unique(m.items, schemas.RAW_KEYS["order_items"])


@job("check_foreign_key")
def _(m):
    return quality.foreign_key_summary(
        {
            "items_orders": (m.items, m.order_facts, "order_id"),
            "items_products": (m.items, m.products, "product_id"),
            "orders_customers": (m.order_facts, m.customers, "customer_id"),
            "orders_items": (m.order_facts, m.items, "order_id"),
            "orders_delivered": (m.items, clean.by_status(m.order_facts, DELIVERED), "order_id"),
        }
    )


@job("check_predicate")
def _(m):
    return quality.check_predicates(
        m.sales,
        {
            "quantity_positive": F.col("quantity") > 0,
            "revenue_not_negative": F.col("revenue") >= 0,
            "quantity_at_most_40": F.col("quantity") <= 40,
        },
    )


@job("require_non_empty")
def _(m):
    joined = model.join_sales_orders(m.sales, m.order_facts)
    return quality.require_count(joined.agg(F.count("*").alias("n_rows")), "n_rows", "sales joined with orders")


@job("checks_while_writing")
def _(m):
    # counted by the tasks that write the tables: no pass of their own
    dear = {"quantity_at_most_40": F.col("quantity") <= 40, "cost_known": F.col("unit_cost").isNotNull()}
    watches = {
        "fct_payments": quality.Watch("fct_payments", ["payment_id", "payment_method"], {"amount_at_least_1000": F.col("amount") >= 1000}),
        "fct_sales": quality.Watch("fct_sales", ["order_id", "region"], dear),
    }
    sinks.write_tables({"fct_payments": m.payments, "fct_sales": m.fct_sales}, scratch_path(m.spark, "watched"), watches=watches)
    return quality.watched(m.spark, watches)


# -- joins ----------------------------------------------------------------------------------


@job("join_sales_orders")
def _(m):
    return model.join_sales_orders(m.sales, m.order_facts)


def _bucketed(m: TestModel, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lines and orders stored in the same buckets by order."""
    path = sinks.write_tables({"lines": lines}, scratch_path(m.spark, "lines"))["lines"]
    stored = m.spark.read.schema(lines.schema).parquet(path)
    n = sinks.bucket_count(stored.count(), rows_per_bucket=100_000)
    return tuple(
        sinks.write_bucketed(df, scratch_table(m.spark, name), "order_id", n) for name, df in (("lines", stored), ("orders", m.order_facts))
    )


@job("bucketed_sales_orders")
def _(m):
    return model.join_sales_orders(*_bucketed(m, m.sales))


@job("bucketed_items_filtered")
def _(m):
    items, orders = _bucketed(m, m.priced_items)
    return model.items_by_status(items, orders, DELIVERED).select("order_id", "line_no", "product_id", "quantity", "total_revenue")


@job("bucketed_fct_sales")
def _(m):
    items, orders = _bucketed(m, m.fct_order_items)
    return model.fct_sales(items, orders.join(m.customers.select("customer_id", "region"), "customer_id", "left"), m.customers)


@job("join_sales_products")
def _(m):
    return model.join_sales_products(m.sales, m.products)


@job("fact_sales_enriched")
def _(m):
    return model.fact_sales_enriched(m.sales, m.named_orders, m.products_some_cost)


@job("items_enriched")
def _(m):
    return m.fct_order_items


@job("orders_enriched")
def _(m):
    return m.fct_orders


@job("customers_enriched")
def _(m):
    return m.dim_customers


@job("fct_sales")
def _(m):
    return m.fct_sales


@job("etl_fct_orders")
def _(m):
    return model.build_star(clean.clean_tables(m.raw))["fct_orders"]


@job("etl_dim_customers")
def _(m):
    return model.build_star(clean.clean_tables(m.raw))["dim_customers"]


@job("interactions")
def _(m):
    return recommend.interactions(m.sales, m.order_facts, DELIVERED)


@job("cohort_assign")
def _(m):
    return cohorts.cohort_assign(m.order_facts, DELIVERED).select(
        "order_id", "customer_id", "order_month", "cohort_month", "cohort_index"
    )


@job("cohort_size_join")
def _(m):
    return cohorts.with_retention(cohorts.cohort_counts(m.order_facts, DELIVERED)).select(
        "cohort_month", "cohort_index", "cohort_size"
    )


@job("rfm_customer_join")
def _(m):
    base = rfm.rfm_base(m.order_facts_enriched, REFERENCE_DATE, DELIVERED)
    return rfm.join_customers(base, m.customers).drop("email")


@job("lookup_join_skip_missing")
def _(m):
    # sales without an order or product are skipped
    joined = m.sales.join(m.order_facts.drop("order_status"), "order_id").join(m.products_some_cost, "product_id")
    return joined.select(
        "order_id", "order_date", dates.month_start("order_date").alias("month_start"),
        F.month("order_date").alias("month_num"), "customer_id", "product_id", "product_name", "category",
        "quantity", "revenue", model.profit().alias("profit"),
    )


@job("related_lookup")
def _(m):
    return reports.total_cost(m.sales, m.products_some_cost)


@job("items_orders_filtered")
def _(m):
    return model.items_by_status(m.priced_items, m.order_facts, DELIVERED).select(
        "order_id", "line_no", "product_id", "quantity", "total_revenue"
    )


def _calendar(m: TestModel) -> DataFrame:
    return timeseries.date_dimension(timeseries.date_bounds(m.order_facts))


@job("date_dim_join")
def _(m):
    dated = timeseries.with_calendar(m.order_facts, _calendar(m))
    return dated.groupBy("year", "quarter", "is_weekend").agg(F.count("*").alias("orders"))


def _matrix(m: TestModel) -> DataFrame:
    return recommend.user_item(recommend.interactions(m.sales, m.order_facts, DELIVERED))


@job("item_pair_self_join")
def _(m):
    return recommend.item_pairs(_matrix(m)).select("product_id_a", "product_id_b", "dot")


@job("exclude_purchased")
def _(m):
    # what customers ordered in any status, without what they got delivered
    matrix = _matrix(m)
    ordered = recommend.interactions(m.sales, m.order_facts, None).select("customer_id", "product_id").distinct()
    return recommend.exclude_purchased(ordered, matrix)


@job("drop_month_drillthrough")
def _(m):
    monthly = reports.monthly_by_region(m.sales, m.orders)
    return reports.drill_through(monthly, reports.drop_months_of(monthly))


@job("drop_month_drillthrough_category")
def _(m):
    months = reports.sales_drop_months(m.sales, m.order_facts)
    return reports.drill_through(reports.monthly_by_category(m.sales, m.order_facts, m.products), months)


# -- aggregations ---------------------------------------------------------------------------


@job("order_value")
def _(m):
    return m.order_value


@job("customer_features")
def _(m):
    return m.dim_customers.drop("email", "signup_date", "city", "region")


@job("monthly_trend_delivered")
def _(m):
    return reports.monthly_trend(m.order_facts_enriched, DELIVERED)


@job("monthly_sales")
def _(m):
    return reports.monthly_sales(m.sales, m.order_facts)


@job("monthly_orders_advanced")
def _(m):
    return reports.monthly_orders(m.order_facts_enriched, DELIVERED)


@job("monthly_enriched_ps")
def _(m):
    return reports.monthly_units(m.sales, m.order_facts)


@job("profit_by_category")
def _(m):
    return reports.profit_by_category(model.items_enriched(m.items, m.products_some_cost))


@job("region_margin_sql")
def _(m):
    return reports.region_margin(m.sales, m.orders, m.products_some_cost)


@job("region_sales")
def _(m):
    return reports.region_sales(m.fct_orders)


@job("seasonality_profile")
def _(m):
    return reports.seasonality(m.sales, m.order_facts)


@job("seasonality_line_avg")
def _(m):
    return reports.seasonality_lines(m.sales, m.order_facts)


@job("top_products_sql")
def _(m):
    return reports.top_products(m.sales, m.products)


@job("top_products_delivered")
def _(m):
    return reports.top_products_by_status(m.priced_items, m.order_facts, m.products, DELIVERED)


@job("top_products_api")
def _(m):
    return reports.top_products_all(m.priced_items, m.products)


@job("top_product_names")
def _(m):
    return reports.top_product_names(m.priced_items, m.products)


@job("pivot_top_products")
def _(m):
    return reports.pivot_top_products(m.sales, m.orders, m.products, 1998, "EUROPE")


@job("customer_ltv")
def _(m):
    return reports.customer_ltv(m.sales, m.named_orders)


@job("top_customers_ps")
def _(m):
    return reports.top_customers(m.sales, m.named_orders)


@job("kpis")
def _(m):
    return reports.kpis(m.fct_orders, m.customers, DELIVERED)


@job("kpis_starter")
def _(m):
    return reports.kpis_starter(m.sales, m.order_facts, m.products_some_cost)


@job("measures")
def _(m):
    rows = m.orders.withColumn("year", F.year("order_date"))
    return reports.measures(m.sales, rows, m.products_some_cost, ["year", "region"])


@job("measures_by_customer")
def _(m):
    return reports.measures(m.sales, m.order_facts, m.products, ["customer_id"], ["customer_ltv", "total_orders"])


@job("measures_by_category")
def _(m):
    return reports.measures(m.sales, m.orders, m.products_some_cost, ["category", "region"])


@job("measures_enterprise")
def _(m):
    return reports.measures_enterprise(m.fct_orders.withColumn("year", F.year("order_date")), ["year", "region"])


@job("top_products_by_profit")
def _(m):
    return reports.top_products_by_status(m.priced_items, m.order_facts, m.products, DELIVERED, by="total_profit")


@job("rfm_base")
def _(m):
    return rfm.rfm_base(m.order_facts_enriched, REFERENCE_DATE, DELIVERED)


def _export(m: TestModel) -> DataFrame:
    return rfm.rfm_crm(m.order_facts_enriched, m.customers, REFERENCE_DATE, DELIVERED)


@job("rfm_summary")
def _(m):
    return rfm.rfm_summary(_export(m))


@job("cohort_retention")
def _(m):
    return cohorts.cohort_retention(m.order_facts, DELIVERED)


@job("cohort_retention_by_month")
def _(m):
    """All months but the last are stored first, the last one is added to them."""
    folder, orders = scratch_path(m.spark, "retention"), m.order_facts
    last = clean.by_status(orders, DELIVERED).agg(F.trunc(F.max("order_date"), "month")).first()[0]
    retention.build(orders.filter(F.col("order_date") < F.lit(last)), folder, DELIVERED)
    retention.add_month(orders, folder, last, DELIVERED)
    return retention.retention(m.spark, folder)


@job("cohort_first_curve")
def _(m):
    return cohorts.first_cohort(cohorts.cohort_retention(m.order_facts, DELIVERED))


@job("segment_summary")
def _(m):
    return reports.segment_summary(m.dim_customers)


@job("user_item_matrix")
def _(m):
    return _matrix(m)


@job("status_rates_by_region")
def _(m):
    return reports.status_rates(m.orders, RETURNED, CANCELLED)


@job("month_category_matrix")
def _(m):
    monthly = reports.monthly_by_category(m.sales, m.order_facts, m.products)
    return reports.pivot_revenue(monthly, ["month_start"], "category", CATEGORIES)


@job("pivot_month_region")
def _(m):
    monthly = reports.with_year_month(reports.monthly_by_region(m.sales, m.orders))
    return reports.pivot_revenue(monthly, ["year", "month_name"], "region", REGIONS)


@job("pivot_monthly_trend")
def _(m):
    return reports.pivot_monthly_trend(m.sales, m.order_facts)


@job("pivot_region_margin")
def _(m):
    return reports.pivot_region_margin(m.sales, m.orders, m.products)


@job("category_contribution")
def _(m):
    return reports.contribution(m.fct_order_items, few_rows=True)


@job("date_bounds")
def _(m):
    return timeseries.date_bounds(m.order_facts)


@job("monthly_by_dimension")
def _(m):
    return reports.monthly_by_dimension(m.sales, m.orders, m.products)


def _cube(m: TestModel) -> DataFrame:
    rows = cube.starter_rows(m.sales, m.orders, m.products)
    return cube.write(cube.month_cube(rows), scratch_path(m.spark, "cube"))


@job("month_cube")
def _(m):
    return _cube(m)


@job("cube_growth_by_region")
def _(m):
    return reports.growth_by(cube.by_month(_cube(m), "region").drop("units"), "region")


@job("cube_growth_by_category")
def _(m):
    return reports.growth_by(cube.by_month(_cube(m), "category").drop("units"), "category")


@job("cube_month_category_matrix")
def _(m):
    return reports.pivot_revenue(cube.by_month(_cube(m), "category"), ["month_start"], "category", CATEGORIES)


@job("cube_seasonality")
def _(m):
    return reports.seasonality_of(cube.by_month(_cube(m)))


@job("cube_drillthrough")
def _(m):
    cells = _cube(m)
    months = reports.drop_months_of(cube.by_month(cells))
    return reports.drill_through(cube.by_month(cells, "region").drop("units"), months)


# -- windows --------------------------------------------------------------------------------


def _product_months(m: TestModel) -> DataFrame:
    """Revenue per product and month: a product does not sell in every month."""
    dated = m.sales.join(m.order_facts.select("order_id", "order_date"), "order_id")
    return dated.groupBy("product_id", dates.month_start("order_date").alias("month_start")).agg(F.sum("revenue").alias("revenue"))


@job("mom_growth_lag")
def _(m):
    return timeseries.with_growth(_product_months(m), "revenue", by=["product_id"], previous="prev_revenue", digits=2)


@job("mom_growth_by_region")
def _(m):
    return reports.growth_by(reports.monthly_by_region(m.sales, m.orders), "region")


@job("mom_growth_by_category")
def _(m):
    return reports.growth_by(reports.monthly_by_category(m.sales, m.order_facts, m.products), "category")


@job("mom_growth_zero_filled")
def _(m):
    by = ["product_id"]
    filled = timeseries.resample_months(_product_months(m), "month_start", {"revenue": F.sum("revenue")}, by)
    return timeseries.with_growth(filled, "revenue", by=by, previous="prev_revenue")


@job("mom_growth_calendar")
def _(m):
    return timeseries.with_growth(_product_months(m), "revenue", by=["product_id"], mode="calendar", previous="prev_revenue")


@job("yoy_growth_calendar")
def _(m):
    return timeseries.with_growth(
        _product_months(m), "revenue", by=["product_id"], mode="calendar", months_back=12, previous="prev_revenue",
        out="yoy_growth_pct",
    )


@job("rfm_ntile")
def _(m):
    base = rfm.rfm_base(m.order_facts_enriched, REFERENCE_DATE, DELIVERED)
    return rfm.rfm_ntile(base).select("customer_id", "r_score", "f_score", "m_score")


@job("rfm_qcut")
def _(m):
    base = rfm.rfm_base(m.order_facts_enriched, REFERENCE_DATE, DELIVERED)
    return rfm.rfm_qcut(base).select("customer_id", "r_score", "f_score", "m_score")


@job("global_row_number")
def _(m):
    return ranking.global_row_number(m.order_facts, [F.asc("order_date"), F.asc("order_id")]).select("order_id", "rn", "n")


@job("revenue_share")
def _(m):
    return timeseries.with_share(model.product_totals(m.sales), "revenue", "revenue_share_pct")


@job("sales_drop_months")
def _(m):
    return reports.sales_drop_months(m.sales, m.order_facts)


@job("row_number_topk")
def _(m):
    return recommend.nearest_items(recommend.item_similarity(_matrix(m)))


@job("cohort_first_month")
def _(m):
    return cohorts.first_months(m.order_facts, DELIVERED)


# -- sorts and limits -----------------------------------------------------------------------


@job("order_by_single")
def _(m):
    return reports.monthly_totals(m.sales, m.order_facts).orderBy("month_start")


@job("order_by_multi")
def _(m):
    return m.order_facts_enriched.orderBy(
        F.asc("order_status"), F.desc_nulls_last("order_revenue"), F.asc("order_id")
    ).select("order_status", "order_revenue", "order_id")


@job("top_k")
def _(m):
    return ranking.top_k(m.payments, 50, [F.desc("amount"), F.asc("payment_id")])


@job("argmax_argmin_row")
def _(m):
    monthly = reports.monthly_totals(m.sales, m.order_facts)
    best = ranking.best_row(monthly, "revenue", "month_start").withColumn("which", F.lit("best"))
    return best.unionByName(ranking.worst_row(monthly, "revenue", "month_start").withColumn("which", F.lit("worst")))


@job("top_k_per_group")
def _(m):
    order = [F.desc_nulls_last("order_revenue"), F.asc("order_id")]
    return ranking.top_n_per(m.order_facts_enriched, ["customer_id"], order, 5).select(
        "customer_id", "order_id", "order_revenue", "rank"
    )


# -- set operations -------------------------------------------------------------------------


@job("row_count_audit")
def _(m):
    return quality.row_counts({"orders": m.order_facts, "products": m.products, "sales": m.sales})


@job("distinct_values")
def _(m):
    return quality.distinct_values(m.sales, ["order_id"])


# -- scalar functions -----------------------------------------------------------------------


@job("scalar_dates")
def _(m):
    d = F.col("order_date")
    low = F.lit("1995-01-01").cast("date")
    return m.order_facts.select(
        "order_id",
        dates.month_start(d).alias("month_start"),
        F.month(d).alias("month_num"),
        F.year(d).alias("year"),
        dates.month_label(d).alias("month_label"),
        dates.date_key(d).alias("date_key"),
        F.datediff(d, low).alias("days"),
        dates.whole_months(low, d).alias("months"),
        dates.quarter_label(d).alias("quarter"),
        dates.month_name(d).alias("month_name"),
        dates.day_name(d).alias("day_name"),
        dates.week_of_year(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        dates.is_weekend(d).alias("is_weekend"),
        F.add_months(dates.month_start(d), -1).alias("previous_month"),
    )


@job("scalar_numeric")
def _(m):
    rows = m.sales.join(m.products_some_cost.select("product_id", "unit_cost"), "product_id")
    spare = F.col("quantity") - 25
    return rows.select(
        "order_id",
        "product_id",
        F.round("revenue", 2).alias("revenue_half_up"),
        F.bround("revenue", 2).alias("revenue_half_even"),
        numbers.ratio("revenue", spare).alias("guarded_ratio"),
        numbers.or_zero(numbers.ratio("revenue", spare)).alias("ratio_or_zero"),
        F.coalesce("unit_cost", F.lit(0)).alias("cost_or_zero"),
        numbers.percent("quantity", F.lit(50)).alias("quantity_pct"),
        F.col("revenue").cast("int").alias("revenue_int"),
        numbers.min_max_index("quantity", F.lit(1), F.lit(50)).alias("quantity_index"),
    )


@job("scalar_text_case")
def _(m):
    size = F.when(F.col("quantity") >= 40, "large").when(F.col("quantity") >= 20, "medium").otherwise("small")
    return m.sales.select(
        "order_id",
        "product_id",
        F.concat(F.col("quantity").cast("string"), (F.col("product_id") % 5).cast("string")).alias("code"),
        size.alias("size"),
        lookups.look_up(size, {"large": 3, "medium": 2}).alias("weight"),
        lookups.look_up(size, {"large": 3, "medium": 2}, 1).alias("weight_or_one"),
    )


# -- time series, dimensions and models -----------------------------------------------------


@job("resample_month_start")
def _(m):
    return timeseries.resample_months(m.orders, "order_date", {"orders": F.count("order_id")}, by=["region"])


@job("date_dimension")
def _(m):
    return _calendar(m)


@job("item_similarity")
def _(m):
    return recommend.item_similarity(_matrix(m))


@job("recommendations")
def _(m):
    return recommend.recommend(_matrix(m))


def _revenue_months(m: TestModel, by: tuple[str, ...] = ()) -> DataFrame:
    orders = m.fct_orders if by else m.order_facts_enriched
    return timeseries.resample_months(
        clean.by_status(orders, DELIVERED), "order_date", {"revenue": F.sum("order_revenue")}, by
    )


def _cents(df: DataFrame) -> DataFrame:
    """Forecasts to the cent and indexes to 8 digits."""
    digits = {"forecast_revenue": 2, "forecast_index": 8}
    return df.withColumns({c: F.round(c, d) for c, d in digits.items() if c in df.columns})


@job("forecast_revenue")
def _(m):
    return _cents(forecast.with_forecast_index(forecast.forecast_revenue(_revenue_months(m))))


@job("forecast_by_region")
def _(m):
    by = ("region",)
    return _cents(forecast.with_forecast_index(forecast.forecast_revenue(_revenue_months(m, by), by=by), by))


def _customer_forecast(m: TestModel, value: str) -> DataFrame:
    delivered = clean.by_status(m.order_facts_enriched, DELIVERED)
    by = ["customer_id"]
    monthly = timeseries.resample_months(delivered, "order_date", {"revenue": F.sum(value)}, by)
    # a mean can end on half a cent: it goes up, whatever the last bits of the double say
    predicted = forecast.forecast_revenue(monthly, by=by)
    return predicted.withColumn("forecast_revenue", F.round(F.col("forecast_revenue") + 1e-6, 2))


@job("forecast_fallback_mean")
def _(m):
    # series of under one year, under two and more: ``method`` says which rule held
    return _customer_forecast(m, "order_revenue")


@job("forecast_trend_only")
def _(m):
    return _customer_forecast(m, "order_profit")


@job("forecast_index")
def _(m):
    year = forecast.with_forecast_index(forecast.forecast_revenue(_revenue_months(m), periods=12))
    return _cents(year).select("month", "forecast_index")


@job("rfm_crm_export")
def _(m):
    return _export(m)


@job("rfm_sql")
def _(m):
    return rfm.rfm_sql(m.order_facts_enriched, REFERENCE_DATE, DELIVERED)


# -- insight tables -------------------------------------------------------------------------


@job("insights")
def _(m):
    return insights.insights(
        reports.monthly_trend(m.order_facts_enriched, DELIVERED),
        reports.profit_by_category(m.fct_order_items),
        reports.region_sales(m.fct_orders),
        cohorts.cohort_retention(m.order_facts, DELIVERED),
    )


@job("forecast_insights")
def _(m):
    facts = insights.forecast_insights(forecast.forecast_revenue(_revenue_months(m)))
    return facts.withColumn("value", F.round("value", 2))


@job("top_rfm_segment")
def _(m):
    return rfm.top_rfm_segment(rfm.rfm_summary(_export(m)))


@job("drop_alerts")
def _(m):
    return reports.drop_alerts(m.sales, m.order_facts)
