"""The batch run: raw files, processed tables, reports.

Every stage reads what the stage before wrote. A table is computed once, however many later
tables and reports use it, and a lost executor costs one stage, not the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_start
from ..operators import clean, cohorts, forecast, insights, model, recommend, reports, rfm
from ..operators.quality import Watch, require_clean, require_rows, watched
from ..sources import files, sinks
from . import cube


def table_watches() -> dict[str, Watch]:
    """The checks of the processed tables: keys that must be there and ranges of measures."""
    lines = {"quantity positive": F.col("quantity") > 0, "total_revenue not negative": F.col("total_revenue") >= 0}
    return {
        "dim_products": Watch("dim_products", ["product_id"], {"unit_cost not negative": F.col("unit_cost") >= 0}),
        "fct_payments": Watch("fct_payments", ["payment_id", "order_id"], {"amount not negative": F.col("amount") >= 0}),
        "fct_order_items": Watch("fct_order_items", ["order_id", "product_id"], lines),
        "fct_orders": Watch("fct_orders", ["order_id", "order_date", "customer_id"], {"order_revenue not negative": F.col("order_revenue") >= 0}),
        "dim_customers": Watch("dim_customers", ["customer_id"], {"order_frequency not negative": F.col("order_frequency") >= 0}),
        "fct_sales": Watch("fct_sales", ["order_id", "order_date", "customer_id"], lines),
    }


def process(raw: dict[str, DataFrame], folder: str, fmt: str = "parquet", watches: dict[str, Watch] | None = None) -> dict[str, DataFrame]:
    """Clean the raw tables and write the six processed ones; returns them as read back.

    ``watches`` (as of ``table_watches``) count rows and violations of the tables as they are written.
    """
    # dealt by product, copies of a line meet as well, and the join with products needs no second shuffle of the lines
    tidy = clean.clean_tables(raw | {"order_items": raw["order_items"].repartition("product_id")})
    spark = tidy["orders"].sparkSession
    done: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        path = sinks.write_tables({name: df}, folder, fmt, watches=watches)[name]
        reader = spark.read.schema(df.schema)
        done[name] = (reader.option("header", True) if fmt == "csv" else reader).format(fmt).load(path)
        return done[name]

    products = store("dim_products", tidy["products"])
    store("fct_payments", tidy["payments"])
    items = store("fct_order_items", model.items_enriched(tidy["order_items"], products))
    orders = store("fct_orders", model.orders_enriched(tidy["orders"], model.order_value(items)))
    customers = store("dim_customers", model.customer_features(orders, tidy["customers"]))
    store("fct_sales", model.fct_sales(items, orders, customers))
    return done


def analyse(
    tables: dict[str, DataFrame],
    folder: str,
    status: str = "Delivered",
    reference_date: str = rfm.REFERENCE_DATE,
    top_n: int = 5,
    periods: int = 6,
) -> dict[str, str]:
    """Write every report below ``folder``; returns their paths.

    Recommendations and the CRM export grow with the customers and stay in as many files as
    Spark writes; the other reports are a few hundred rows and get one file each.
    """
    orders, sales, customers = tables["fct_orders"], tables["fct_sales"], tables["dim_customers"]
    spark = orders.sparkSession
    paths: dict[str, str] = {}

    def small(name: str, df: DataFrame) -> DataFrame:
        paths[name] = sinks.write_report(df, folder, name, single_file=True)
        return files.read_report(spark, folder, name)

    trend = reports.monthly_trend(orders, status)
    monthly = small("monthly_trend", trend.withColumnRenamed("month_start", "order_date").orderBy("order_date"))
    categories = small("profit_by_category", reports.profit_by_category(tables["fct_order_items"]).orderBy(F.desc_nulls_last("profit"), "category"))
    retention = cohorts.cohort_retention(orders, status).withColumnRenamed("customers", "customer_id")
    cohort_rows = small(
        "customer_retention_cohorts",
        retention.select("cohort_month", "cohort_index", "customer_id", "cohort_size", "retention_rate").orderBy(
            "cohort_month", "cohort_index"
        ),
    )
    paths["kpis"] = sinks.write_kpis(reports.kpis(orders, customers, status), f"{folder}/kpis.json")

    matrix = recommend.user_item(recommend.interactions(sales, orders, status))
    paths["recommendations"] = sinks.write_report(recommend.recommend(matrix, top_n), folder, "recommendations")

    # One pass over the lines for all month reports by region and category.
    cells = cube.write(cube.month_cube(cube.sales_rows(sales)), folder)
    by_region, by_category = cube.by_month(cells, "region"), cube.by_month(cells, "category")
    dropped = reports.drop_months_of(cube.by_month(cells))
    small("region_growth", reports.growth_by(by_region, "region").orderBy("region", "month_start"))
    small("category_growth", reports.growth_by(by_category, "category").orderBy("category", "month_start"))
    small("seasonality", reports.seasonality_of(cube.by_month(cells)).orderBy("month_num"))
    small("drop_months_by_region", reports.drill_through(by_region, dropped).orderBy("month_start", "region"))
    small("drop_months_by_category", reports.drill_through(by_category, dropped).orderBy("month_start", "category"))

    months = monthly.withColumn("month_start", month_start("order_date"))
    predicted = forecast.with_forecast_index(forecast.forecast_revenue(months, periods)).drop("method")
    future = small("sales_forecast", predicted.orderBy("month"))

    export = rfm.rfm_crm(orders, customers, reference_date, status, ordered=True)
    paths["crm_rfm_export"] = sinks.write_report(export, folder, "crm_rfm_export")
    scored = files.read_report(spark, folder, "crm_rfm_export")
    small("crm_rfm_summary", rfm.rfm_summary(scored).orderBy(F.desc("revenue"), "rfm_segment"))

    regions = reports.region_sales(orders)
    retained = cohort_rows.withColumnRenamed("customer_id", "customers")
    facts = insights.insights(months, categories, regions, retained).unionByName(insights.forecast_insights(future))
    paths["insights"] = sinks.write_report(facts, folder, "insights", single_file=True)
    return paths


def run_batch(spark: SparkSession, raw_folder: str, out_folder: str, strict: bool = False, **options: object) -> dict[str, str]:
    """Raw CSV files to processed tables and reports.

    The report ``checks`` lists rows and violations of the processed tables, counted while they were written; with
    ``strict`` a table without rows or with a violation ends the run there.
    """
    raw = files.read_raw(spark, raw_folder)
    require_rows(raw["order_items"], "order_items")
    watches = table_watches()
    tables = process(raw, f"{out_folder}/processed", watches=watches)
    checks = sinks.write_report(watched(spark, watches), f"{out_folder}/reports", "checks", single_file=True)
    if strict:
        require_clean(watches)
    return {"checks": checks} | analyse(tables, f"{out_folder}/reports", **options)
