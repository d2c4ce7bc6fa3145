"""Declared schemas of the raw, processed, starter and report tables."""

from __future__ import annotations

RAW = {
    "customers": "customer_id STRING, customer_name STRING, email STRING, region STRING, "
                 "city STRING, signup_date DATE, segment STRING",
    "products": "product_id STRING, product_name STRING, category STRING, brand STRING, "
                "unit_price DECIMAL(12,2), unit_cost DECIMAL(12,2)",
    "orders": "order_id STRING, order_date DATE, customer_id STRING, region STRING, "
              "order_status STRING",
    "order_items": "order_id STRING, line_no INT, product_id STRING, quantity INT, "
                   "unit_selling_price DECIMAL(12,2), discount_pct DECIMAL(6,2), "
                   "line_revenue DECIMAL(14,2)",
    "payments": "payment_id STRING, order_id STRING, payment_date DATE, payment_method STRING, "
                "payment_status STRING, amount DECIMAL(14,2)",
}

# Keys of the raw tables: duplicates on them are dropped, the first row wins.
RAW_KEYS = {
    "customers": ("customer_id",),
    "products": ("product_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "line_no", "product_id"),
    "payments": ("payment_id",),
}

# Fixed values that replace nulls in the raw tables.
RAW_DEFAULTS = {
    "customers": {"city": "Unknown", "segment": "Consumer"},
    "products": {},
    "orders": {"region": "Unknown", "order_status": "Delivered"},
    "order_items": {"quantity": 1, "unit_selling_price": 0},
    "payments": {"payment_method": "Unknown", "payment_status": "Success"},
}

PROCESSED = {
    "dim_customers": RAW["customers"] + ", lifetime_value DECIMAL(34,2), order_frequency BIGINT, "
                     "avg_order_value DOUBLE, total_profit DECIMAL(34,2), first_order_date DATE, "
                     "last_order_date DATE, customer_tenure_days INT",
    "dim_products": RAW["products"],
    "fct_orders": RAW["orders"] + ", order_revenue DECIMAL(24,2), order_profit DECIMAL(24,2), "
                  "order_items_count BIGINT",
    "fct_order_items": RAW["order_items"] + ", total_revenue DECIMAL(14,2), unit_cost DECIMAL(12,2), "
                       "category STRING, brand STRING, product_name STRING, "
                       "line_cost DECIMAL(14,2), line_profit DECIMAL(14,2)",
    "fct_payments": RAW["payments"],
}
PROCESSED["fct_sales"] = PROCESSED["fct_order_items"] + (
    ", order_date DATE, customer_id STRING, region STRING, order_status STRING, "
    "segment STRING, city STRING, order_month STRING"
)

STARTER = {
    "orders": "order_id STRING, order_date DATE, customer_id STRING, customer_name STRING, region STRING",
    "products": "product_id STRING, product_name STRING, category STRING, "
                "unit_price DECIMAL(12,2), unit_cost DECIMAL(12,2)",
    "sales": "order_id STRING, product_id STRING, quantity INT, revenue DECIMAL(14,2)",
    "dim_date": "date_key INT, date DATE, year INT, quarter STRING, month_num INT, "
                "month_name STRING, week_of_year INT, day_of_month INT, day_name STRING, is_weekend INT",
}

REPORTS = {
    "monthly_trend": "order_date DATE, revenue DOUBLE, orders BIGINT, profit DOUBLE, mom_growth_pct DOUBLE",
    "profit_by_category": "category STRING, revenue DOUBLE, profit DOUBLE, profit_margin_pct DOUBLE",
    "customer_retention_cohorts": "cohort_month DATE, cohort_index INT, customer_id BIGINT, "
                                  "cohort_size BIGINT, retention_rate DOUBLE",
    "crm_rfm_summary": "rfm_segment STRING, customers BIGINT, revenue DOUBLE, avg_recency_days DOUBLE",
    "crm_rfm_export": "customer_id STRING, customer_name STRING, email STRING, region STRING, "
                      "customer_segment STRING, last_order_date DATE, recency_days INT, frequency BIGINT, "
                      "monetary DOUBLE, r_score INT, f_score INT, m_score INT, rfm_code STRING, "
                      "rfm_segment STRING, priority STRING, crm_action STRING",
    "recommendations": "customer_id STRING, recommended_product_id STRING, score DOUBLE",
    "checks": "table_name STRING, check_name STRING, n_rows BIGINT",
    "region_growth": "month_start DATE, region STRING, revenue DOUBLE, units BIGINT, prev_revenue DOUBLE, region_mom_growth_pct DOUBLE",
    "category_growth": "month_start DATE, category STRING, revenue DOUBLE, units BIGINT, prev_revenue DOUBLE, "
                       "category_mom_growth_pct DOUBLE",
    "seasonality": "month_num INT, avg_revenue DOUBLE, seasonal_share_pct DOUBLE",
    "drop_months_by_region": "month_start DATE, region STRING, revenue DOUBLE, units BIGINT",
    "drop_months_by_category": "month_start DATE, category STRING, revenue DOUBLE, units BIGINT",
    "sales_forecast": "month DATE, forecast_revenue DOUBLE, forecast_index DOUBLE",
}

KPIS = (
    "total_revenue DOUBLE, total_profit DOUBLE, profit_margin_pct DOUBLE, total_orders BIGINT, "
    "total_customers BIGINT, avg_order_value DOUBLE, active_regions BIGINT"
)
