"""Times the headline queries. Prints one JSON line; takes BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS.

Every query runs to the end over its whole tables into a sink that drops the rows. The best of
BENCH_RUNS runs counts, so that JVM warm-up is not measured.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerloom.plans import catalog
from ledgerloom.session import build_session, clean_scratch

HEADLINE = (
    "monthly_trend_delivered", "monthly_sales", "monthly_orders_advanced", "sales_drop_months",
    "mom_growth_by_category", "seasonality_profile", "profit_by_category", "region_sales",
    "region_margin_sql", "top_products_sql", "measures_by_category", "measures_enterprise", "top_products_delivered", "top_products_api",
    "customer_ltv", "kpis", "measures", "month_category_matrix", "dedupe_keep_first",
    "etl_fct_orders", "etl_dim_customers", "fct_sales", "fact_sales_enriched", "cohort_retention",
    "rfm_sql", "rfm_crm_export", "item_similarity", "recommendations", "forecast_revenue",
    "forecast_by_region", "insights", "check_foreign_key", "scan_raw", "sink_processed",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            catalog.run(name, spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
            clean_scratch(spark)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(os.path.normpath(folder)), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
