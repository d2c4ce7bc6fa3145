"""One expected-result query per named job."""

from __future__ import annotations

from .model import SEGMENT, with_model

_MOM = "CAST(revenue - prev AS DOUBLE) / NULLIF(CAST(prev AS DOUBLE), 0) * 100.0"

# columns of enriched items, as doubles where they are money
_ITEM = """order_id, line_no, product_id, quantity, CAST(unit_selling_price AS DOUBLE) AS unit_selling_price,
    CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(line_revenue AS DOUBLE) AS line_revenue,
    CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(unit_cost AS DOUBLE) AS unit_cost, category, brand, product_name,
    CAST(line_cost AS DOUBLE) AS line_cost, CAST(line_profit AS DOUBLE) AS line_profit"""
_ORDER = """order_id, order_date, customer_id, region, order_status, CAST(order_revenue AS DOUBLE) AS order_revenue,
    CAST(order_profit AS DOUBLE) AS order_profit, order_items_count"""
_RAW_ITEM = """quantity, CAST(unit_selling_price AS DOUBLE) AS unit_selling_price,
    CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(line_revenue AS DOUBLE) AS line_revenue"""
_TREND = f"""SELECT month_start, CAST(revenue AS DOUBLE) AS revenue, orders, CAST(profit AS DOUBLE) AS profit,
    {_MOM} AS mom_growth_pct
    FROM (SELECT *, LAG(revenue) OVER (ORDER BY month_start) AS prev FROM m_trend)"""
_KPIS = """SELECT round_even(CAST(SUM(order_revenue) AS DOUBLE), 2) AS total_revenue,
    round_even(CAST(SUM(order_profit) AS DOUBLE), 2) AS total_profit,
    round_even(CAST(SUM(order_profit) AS DOUBLE) / CAST(SUM(order_revenue) AS DOUBLE) * 100.0, 2) AS profit_margin_pct,
    COUNT(DISTINCT order_id) AS total_orders,
    (SELECT COUNT(DISTINCT customer_id) FROM m_customers) AS total_customers,
    round_even(CAST(SUM(order_revenue) AS DOUBLE) / COUNT(DISTINCT order_id), 2) AS avg_order_value,
    (SELECT COUNT(DISTINCT region) FROM m_fct_sales) AS active_regions
    FROM m_fct_orders WHERE order_status = 'F'"""
_DIM = """customer_id, customer_name, email, region, city, signup_date, segment, lifetime_value, order_frequency,
    avg_order_value, total_profit, first_order_date, last_order_date, customer_tenure_days"""
_STAR_COUNTS = """
    SELECT 'dim_customers' AS table_name, COUNT(*) AS row_count FROM customer
    UNION ALL SELECT 'dim_products', COUNT(*) FROM part
    UNION ALL SELECT 'fct_orders', COUNT(*) FROM orders
    UNION ALL SELECT 'fct_order_items', COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)
    UNION ALL SELECT 'fct_payments', COUNT(*) FROM orders
    UNION ALL SELECT 'fct_sales', COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)"""
_BY_CATEGORY_SOME = """
    SELECT category, CAST(SUM(total_revenue) AS DOUBLE) AS revenue,
           CAST(COALESCE(SUM(line_profit), 0) AS DOUBLE) AS profit,
           CAST(COALESCE(SUM(line_profit), 0) AS DOUBLE) / CAST(SUM(total_revenue) AS DOUBLE) * 100.0 AS profit_margin_pct
    FROM m_fct_items_some_cost WHERE category IS NOT NULL GROUP BY category"""
_CATEGORIES = ("ECONOMY", "STANDARD", "PROMO", "LARGE", "SMALL", "MEDIUM")
_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def _pivot(column: str, values: tuple[str, ...]) -> str:
    return ", ".join(f"""CAST(SUM(CASE WHEN {column} = '{v}' THEN revenue END) AS DOUBLE) AS "{v}\"""" for v in values)


def _growth(source: str, partition: str = "", digits: int | None = None, out: str = "mom_growth_pct") -> str:
    """Growth on the row before."""
    growth = f"ROUND({_MOM}, {digits})" if digits is not None else _MOM
    return f"""SELECT * EXCLUDE (prev, revenue), CAST(revenue AS DOUBLE) AS revenue, CAST(prev AS DOUBLE) AS prev_revenue,
        {growth} AS {out}
        FROM (SELECT *, LAG(revenue) OVER ({partition} ORDER BY month_start) AS prev FROM {source})"""


def _calendar_growth(months: int, out: str) -> str:
    return f"""SELECT product_id, month_start, CAST(revenue AS DOUBLE) AS revenue, CAST(prev AS DOUBLE) AS prev_revenue, {_MOM} AS {out}
        FROM (SELECT a.product_id, a.month_start, a.revenue, b.revenue AS prev FROM m_product_months a
              LEFT JOIN m_product_months b ON b.product_id = a.product_id AND b.month_start = a.month_start - INTERVAL {months} MONTH)"""


QUERIES = {
    # sources and sinks
    "scan_raw": """
        SELECT 'customers' AS table_name, COUNT(*) AS n_rows, COUNT(DISTINCT customer_id) AS n_keys, CAST(NULL AS DOUBLE) AS amount
        FROM m_customers
        UNION ALL SELECT 'products', COUNT(*), COUNT(DISTINCT product_id), CAST(SUM(unit_price) AS DOUBLE) FROM m_products
        UNION ALL SELECT 'orders', COUNT(*), COUNT(DISTINCT order_id), NULL FROM m_orders
        UNION ALL SELECT 'order_items', COUNT(*), COUNT(DISTINCT (order_id, line_no, product_id)), CAST(SUM(line_revenue) AS DOUBLE)
        FROM m_raw_items
        UNION ALL SELECT 'payments', COUNT(*), COUNT(DISTINCT payment_id), CAST(SUM(amount) AS DOUBLE) FROM m_payments""",
    "scan_processed": f"""SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id)
        FROM (SELECT {_ORDER} FROM m_fct_orders)""",
    "scan_with_fallback": f"""SELECT * REPLACE (CAST(customer_id AS VARCHAR) AS customer_id)
        FROM (SELECT {_DIM} FROM m_dim_customers)""",
    "scan_reports": f"SELECT * RENAME (month_start AS order_date) FROM ({_TREND})",
    "sink_report_csv": """SELECT category, CAST(revenue AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS profit,
        profit_margin_pct FROM m_by_category""",
    "sink_kpi_json": _KPIS,
    "scan_kpi_json": _KPIS,
    "scan_optional": "SELECT * REPLACE (CAST(customer_id AS VARCHAR) AS customer_id) FROM m_customers",
    "bulk_load_csv": """SELECT CAST(product_id AS VARCHAR) AS product_id, product_name, category,
        CAST(unit_price AS DOUBLE) AS unit_price, CAST(unit_cost AS DOUBLE) AS unit_cost FROM m_products""",
    "scan_untyped_csv": """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS product_id, quantity,
        CAST(revenue AS DOUBLE) AS revenue FROM m_sales""",
    "sink_processed": _STAR_COUNTS,
    "sink_row_counts": _STAR_COUNTS,
    # cleaning, projections, filters
    "dedupe_keep_first": f"SELECT order_id, line_no, product_id, {_RAW_ITEM} FROM m_deduped_items",
    "fill_defaults": """SELECT payment_id, order_id, payment_date, COALESCE(payment_method, 'Unknown') AS payment_method,
        COALESCE(payment_status, 'Success') AS payment_status, CAST(amount AS DOUBLE) AS amount FROM m_payments""",
    "cast_types": """SELECT CASE WHEN quantity > 45 THEN 'rejected' ELSE 'kept' END AS part, COUNT(*) AS n_rows,
        CAST(SUM(quantity) AS BIGINT) AS units, CAST(MAX(revenue) AS DOUBLE) AS max_revenue FROM m_sales GROUP BY 1""",
    "line_metrics": """SELECT order_id, line_no, product_id, quantity, CAST(total_revenue AS DOUBLE) AS total_revenue,
        CAST(line_cost AS DOUBLE) AS line_cost, CAST(line_profit AS DOUBLE) AS line_profit FROM m_fct_items_some_cost""",
    "profit_null_cost_zero": """SELECT order_id, s.product_id,
        CAST(revenue - COALESCE(unit_cost, 0) * quantity AS DOUBLE) AS profit_zero,
        CAST(revenue - unit_cost * quantity AS DOUBLE) AS profit_skip
        FROM m_sales s JOIN m_products_some_cost p ON p.product_id = s.product_id""",
    "filter_status": """SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id,
        o_orderstatus AS order_status FROM orders WHERE o_orderstatus = 'F'""",
    "filter_slicers": """SELECT order_id, line_no, product_id, order_date, CAST(total_revenue AS DOUBLE) AS total_revenue
        FROM m_fct_sales WHERE order_date BETWEEN DATE '1996-03-01' AND DATE '1999-06-30' AND year(order_date) = 1997
        AND region = 'ASIA' AND category = 'PROMO' AND segment = 'BUILDING'""",
    "sales_slice": """SELECT order_id, line_no, product_id, order_date, CAST(total_revenue AS DOUBLE) AS total_revenue
        FROM m_fct_sales WHERE order_date BETWEEN DATE '1996-03-01' AND DATE '1999-06-30' AND year(order_date) = 1997
        AND region = 'ASIA' AND category = 'PROMO'""",
    "sales_drillthrough": """SELECT CAST(date_trunc('month', order_date) AS DATE) AS month_start, region, CAST(SUM(total_revenue) AS DOUBLE) AS revenue
        FROM m_fct_sales WHERE date_trunc('month', order_date) IN (SELECT month_start FROM m_dropped) GROUP BY ALL""",
    "sales_reload": f"SELECT {_ITEM}, order_date, customer_id, region, order_status, segment, city, order_month FROM m_fct_sales",
    "quarantine_rejects": """SELECT CASE WHEN order_id % 7 = 0 THEN 'open quote' WHEN order_id % 11 = 0 THEN 'number of columns'
        WHEN order_id % 13 = 0 THEN 'order_id: not bigint' ELSE 'good' END AS reason, COUNT(*) AS n_rows,
        CASE WHEN reason = 'good' THEN MAX(order_id) ELSE MAX(length(CAST(order_id AS VARCHAR)) + length(CAST(customer_id AS VARCHAR)) + 12
        + CASE WHEN order_id % 13 = 0 THEN 1 ELSE 0 END + CASE WHEN order_id % 7 = 0 THEN 1 WHEN order_id % 11 = 0 THEN 5 ELSE 0 END) END AS longest
        FROM m_orders GROUP BY reason""",
    "filter_drop_threshold": f"""SELECT month_start, ROUND({_MOM}, 2) AS mom_growth_pct
        FROM (SELECT *, LAG(revenue) OVER (ORDER BY month_start) AS prev FROM m_monthly_delivered)
        WHERE ROUND({_MOM}, 2) <= -10""",
    "filter_not_null": """SELECT month_start, CAST(revenue AS DOUBLE) AS revenue, CAST(prev AS DOUBLE) AS prev_month_revenue
        FROM (SELECT *, LAG(revenue) OVER (ORDER BY month_start) AS prev FROM m_monthly) WHERE prev IS NOT NULL""",
    "select_subset": "SELECT order_id, order_date, customer_id, region, order_status FROM m_orders",
    "rename_on_collision": """SELECT o.customer_id, order_id, order_status AS segment, customer_name, c.region,
        c.segment AS customer_segment FROM m_orders o LEFT JOIN m_customers c ON c.customer_id = o.customer_id""",
    "rfm_segment_case": f"""SELECT r_score AS r, f_score AS f, m_score AS m, n_rows, {SEGMENT} AS segment
        FROM m_grid g(r_score, f_score, m_score, n_rows)""",
    "lookup_map": f"""SELECT rfm_segment, crm_action, priority, CAST(SUM(n_rows) AS BIGINT) AS n_rows
        FROM (SELECT n_rows, {SEGMENT} AS rfm_segment FROM m_grid g(r_score, f_score, m_score, n_rows))
        JOIN m_segments USING (rfm_segment) GROUP BY ALL""",
    "lookup_map_default": """SELECT region, CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue,
        CAST(CASE region WHEN 'AFRICA' THEN 1.5 WHEN 'ASIA' THEN 35.0 WHEN 'EUROPE' THEN 50.75 ELSE 21.1458 END AS DOUBLE) AS lat,
        CAST(CASE region WHEN 'AFRICA' THEN 20.25 WHEN 'ASIA' THEN 100.5 WHEN 'EUROPE' THEN 10.0 ELSE 79.0882 END AS DOUBLE) AS lon
        FROM m_fct_sales WHERE region IS NOT NULL GROUP BY region""",
    "clip_lower": "SELECT customer_id, customer_tenure_days FROM m_customer_totals",
    "zero_fill_metrics": """SELECT c.customer_id, CAST(COALESCE(SUM(order_revenue), 0) AS DOUBLE) AS lifetime_value,
        COUNT(order_id) AS order_frequency,
        COALESCE(CAST(SUM(order_revenue) AS DOUBLE) / NULLIF(COUNT(order_revenue), 0), 0.0) AS avg_order_value,
        CAST(COALESCE(SUM(order_profit), 0) AS DOUBLE) AS total_profit,
        CAST(CASE WHEN MAX(order_date) - MIN(order_date) < 1 THEN 1 ELSE MAX(order_date) - MIN(order_date) END AS INTEGER)
            AS customer_tenure_days
        FROM m_customers c LEFT JOIN (SELECT * FROM m_fct_orders WHERE order_status = 'F') o
        ON o.customer_id = c.customer_id GROUP BY c.customer_id""",
    "flag_negative_mom": f"""SELECT month_start, COALESCE({_MOM} < -10, FALSE) AS is_red, COALESCE({_MOM} < 0, FALSE) AS is_negative
        FROM (SELECT *, LAG(revenue) OVER (ORDER BY month_start) AS prev FROM m_monthly)""",
    "sample_base": """SELECT order_id, order_date, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS order_date_key, customer_id,
        customer_name, region, product_id, product_name, category, quantity, CAST(revenue AS DOUBLE) AS revenue,
        CAST(unit_price AS DOUBLE) AS unit_price, CAST(unit_cost AS DOUBLE) AS unit_cost, CAST(profit AS DOUBLE) AS profit
        FROM m_base b ORDER BY order_id, product_id, quantity, b.revenue LIMIT 5""",
    # quality
    "check_not_null": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS violations FROM m_payments"
        for c in ("payment_id", "order_id", "payment_date", "payment_method", "payment_status", "amount")
    ),
    "check_unique": """SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, COUNT(*) AS n_rows
        FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""",
    "check_foreign_key": " UNION ALL ".join(
        f"""SELECT '{link}' AS link, COUNT(DISTINCT {key}) AS orphan_keys, COUNT(*) AS orphan_rows
            FROM {child} WHERE {key} NOT IN (SELECT {pkey} FROM {parent})"""
        for link, child, key, parent, pkey in (
            ("items_orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("items_products", "lineitem", "l_partkey", "part", "p_partkey"),
            ("orders_customers", "orders", "o_custkey", "customer", "c_custkey"),
            ("orders_items", "orders", "o_orderkey", "lineitem", "l_orderkey"),
            ("orders_delivered", "lineitem", "l_orderkey", "orders WHERE o_orderstatus = 'F'", "o_orderkey"),
        )
    ),
    "check_predicate": """SELECT 'quantity_positive' AS rule, COUNT(*) FILTER (NOT quantity > 0) AS violations FROM m_sales
        UNION ALL SELECT 'revenue_not_negative', COUNT(*) FILTER (NOT revenue >= 0) FROM m_sales
        UNION ALL SELECT 'quantity_at_most_40', COUNT(*) FILTER (NOT quantity <= 40) FROM m_sales""",
    "require_non_empty": "SELECT COUNT(*) AS n_rows FROM m_sales_orders",
    # joins
    "join_sales_orders": """SELECT s.order_id, product_id, quantity, CAST(revenue AS DOUBLE) AS revenue,
        CAST(o_orderdate AS DATE) AS order_date, o_custkey AS customer_id, o_orderstatus AS order_status
        FROM m_sales s JOIN orders ON o_orderkey = s.order_id""",
    "join_sales_products": """SELECT order_id, s.product_id, quantity, CAST(revenue AS DOUBLE) AS revenue, product_name,
        category, brand, CAST(unit_price AS DOUBLE) AS unit_price, CAST(unit_cost AS DOUBLE) AS unit_cost
        FROM m_sales s JOIN m_products p ON p.product_id = s.product_id""",
    "fact_sales_enriched": """SELECT order_id, order_date, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS order_date_key,
        customer_id, customer_name, region, product_id, product_name, category, quantity, CAST(revenue AS DOUBLE) AS revenue,
        CAST(unit_price AS DOUBLE) AS unit_price, CAST(unit_cost AS DOUBLE) AS unit_cost, CAST(profit AS DOUBLE) AS profit
        FROM m_base_some_cost""",
    "items_enriched": f"SELECT {_ITEM} FROM m_fct_items",
    "orders_enriched": f"SELECT {_ORDER} FROM m_fct_orders",
    "customers_enriched": f"SELECT {_DIM} FROM m_dim_customers",
    "fct_sales": f"SELECT {_ITEM}, order_date, customer_id, region, order_status, segment, city, order_month FROM m_fct_sales",
    "etl_fct_orders": """SELECT o.order_id, order_date, customer_id, COALESCE(region, 'Unknown') AS region,
        COALESCE(order_status, 'Delivered') AS order_status, CAST(order_revenue AS DOUBLE) AS order_revenue,
        CAST(order_profit AS DOUBLE) AS order_profit, order_items_count
        FROM m_orders o LEFT JOIN m_etl_order_value v ON v.order_id = o.order_id""",
    "etl_dim_customers": """SELECT c.*, CAST(COALESCE(SUM(order_revenue), 0) AS DOUBLE) AS lifetime_value,
        COUNT(o.order_id) AS order_frequency,
        COALESCE(CAST(SUM(order_revenue) AS DOUBLE) / NULLIF(COUNT(order_revenue), 0), 0.0) AS avg_order_value,
        CAST(COALESCE(SUM(order_profit), 0) AS DOUBLE) AS total_profit, MIN(order_date) AS first_order_date,
        MAX(order_date) AS last_order_date,
        CAST(CASE WHEN MAX(order_date) - MIN(order_date) < 1 THEN 1 ELSE MAX(order_date) - MIN(order_date) END AS INTEGER)
            AS customer_tenure_days
        FROM m_customers c LEFT JOIN m_orders o ON o.customer_id = c.customer_id
        LEFT JOIN m_etl_order_value v ON v.order_id = o.order_id GROUP BY ALL""",
    "interactions": """SELECT order_id, product_id, quantity, customer_id FROM m_sales_orders WHERE order_status = 'F'""",
    "cohort_assign": """SELECT order_id, customer_id, order_month, cohort_month,
        CAST(date_diff('month', cohort_month, order_month) AS INTEGER) AS cohort_index FROM m_cohort_orders""",
    "cohort_size_join": """WITH o AS (SELECT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS mo FROM m_orders
            WHERE order_status = 'F'),
        f AS (SELECT customer_id, MIN(mo) AS cohort_month FROM o GROUP BY 1),
        sizes AS (SELECT cohort_month, COUNT(*) AS cohort_size FROM f GROUP BY 1)
        SELECT DISTINCT cohort_month, CAST(date_diff('month', cohort_month, mo) AS INTEGER) AS cohort_index, cohort_size
        FROM o JOIN f USING (customer_id) JOIN sizes USING (cohort_month)""",
    "rfm_customer_join": """SELECT b.customer_id, last_order_date, frequency, CAST(monetary AS DOUBLE) AS monetary, recency_days,
        customer_name, c.region, c.segment AS customer_segment
        FROM m_rfm_base b LEFT JOIN m_customers c ON c.customer_id = b.customer_id""",
    "lookup_join_skip_missing": """SELECT s.order_id, order_date, month_start, CAST(month(order_date) AS INTEGER) AS month_num,
        customer_id, s.product_id, product_name, category, quantity, CAST(revenue AS DOUBLE) AS revenue,
        CAST(revenue - COALESCE(unit_cost, 0) * quantity AS DOUBLE) AS profit
        FROM m_sales_orders s JOIN m_products_some_cost p ON p.product_id = s.product_id""",
    "related_lookup": """SELECT s.product_id, CAST(SUM(quantity) AS BIGINT) AS units,
        CAST(SUM(quantity * COALESCE(unit_cost, 0)) AS DOUBLE) AS total_cost
        FROM m_sales s LEFT JOIN m_products_some_cost p ON p.product_id = s.product_id GROUP BY s.product_id""",
    "items_orders_filtered": """SELECT order_id, line_no, product_id, quantity,
        CAST(quantity * unit_selling_price AS DOUBLE) AS total_revenue
        FROM m_items JOIN orders ON o_orderkey = order_id WHERE o_orderstatus = 'F'""",
    "date_dim_join": """SELECT year, quarter, is_weekend, COUNT(*) AS orders
        FROM m_orders o JOIN m_calendar c ON c.date = o.order_date GROUP BY ALL""",
    "item_pair_self_join": """SELECT a.product_id AS product_id_a, b.product_id AS product_id_b,
        CAST(SUM(a.qty * b.qty) AS BIGINT) AS dot
        FROM m_matrix a JOIN m_matrix b ON a.customer_id = b.customer_id AND a.product_id < b.product_id GROUP BY ALL""",
    "exclude_purchased": """SELECT DISTINCT customer_id, product_id FROM m_sales_orders
        EXCEPT SELECT customer_id, product_id FROM m_sales_orders WHERE order_status = 'F'""",
    "drop_month_drillthrough": """SELECT month_start, region, CAST(revenue AS DOUBLE) AS revenue FROM m_monthly_region
        WHERE month_start IN (SELECT month_start FROM m_dropped)""",
    "drop_month_drillthrough_category": """SELECT month_start, category, CAST(revenue AS DOUBLE) AS revenue
        FROM m_monthly_category WHERE month_start IN (SELECT month_start FROM m_dropped)""",
    # aggregations
    "order_value": """SELECT order_id, CAST(order_revenue AS DOUBLE) AS order_revenue,
        CAST(order_profit AS DOUBLE) AS order_profit, order_items_count FROM m_order_value""",
    "customer_features": """SELECT customer_id, customer_name, segment, lifetime_value, order_frequency, avg_order_value,
        total_profit, first_order_date, last_order_date, customer_tenure_days FROM m_dim_customers""",
    "monthly_trend_delivered": _TREND,
    "monthly_sales": f"""SELECT month_start, CAST(month(month_start) AS INTEGER) AS month_num, CAST(revenue AS DOUBLE) AS revenue,
        CAST(units AS BIGINT) AS units_sold, orders, ROUND(CAST(revenue AS DOUBLE) / NULLIF(orders, 0), 2) AS aov,
        CAST(prev AS DOUBLE) AS prev_month_revenue, ROUND({_MOM}, 2) AS mom_growth_pct
        FROM (SELECT *, LAG(revenue) OVER (ORDER BY month_start) AS prev FROM m_monthly)""",
    "monthly_orders_advanced": f"""SELECT month_start, CAST(revenue AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS profit, orders,
        ROUND(CAST(revenue AS DOUBLE) / NULLIF(orders, 0), 2) AS avg_order_value,
        CAST(prev AS DOUBLE) AS prev_month_revenue, ROUND({_MOM}, 2) AS mom_growth_pct
        FROM (SELECT *, LAG(revenue) OVER (ORDER BY month_start) AS prev FROM m_monthly_delivered)""",
    "monthly_enriched_ps": f"""SELECT month_start, CAST(revenue AS DOUBLE) AS revenue, CAST(units AS BIGINT) AS units,
        {_MOM} AS mom_growth_pct FROM (SELECT *, LAG(revenue) OVER (ORDER BY month_start) AS prev FROM m_monthly)""",
    "profit_by_category": _BY_CATEGORY_SOME,
    "region_margin_sql": """SELECT region, CAST(SUM(revenue) AS DOUBLE) AS total_revenue, CAST(SUM(profit) AS DOUBLE) AS total_profit,
        ROUND(CAST(SUM(profit) AS DOUBLE) / NULLIF(CAST(SUM(revenue) AS DOUBLE), 0) * 100.0, 2) AS profit_margin_pct
        FROM m_base_some_cost GROUP BY region""",
    "region_sales": """SELECT region, CAST(revenue AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS profit,
        round_even(CAST(profit AS DOUBLE) / CAST(revenue AS DOUBLE) * 100.0, 2) AS margin_pct FROM m_region_sales""",
    "seasonality_profile": """SELECT month_num, ROUND(mean, 2) AS avg_revenue,
        ROUND(mean / SUM(mean) OVER () * 100.0, 2) AS seasonal_share_pct
        FROM (SELECT CAST(month(month_start) AS INTEGER) AS month_num, CAST(SUM(revenue) AS DOUBLE) / COUNT(*) AS mean
              FROM m_monthly GROUP BY 1)""",
    "seasonality_line_avg": """SELECT CAST(month(order_date) AS INTEGER) AS month_num,
        CAST(SUM(revenue) AS DOUBLE) / COUNT(*) AS avg_revenue FROM m_sales_orders GROUP BY 1""",
    "top_products_sql": """SELECT p.product_id, product_name, category, CAST(SUM(quantity) AS BIGINT) AS total_units,
        CAST(SUM(revenue) AS DOUBLE) AS total_revenue,
        ROUND(CAST(SUM(revenue) AS DOUBLE) / CAST(SUM(SUM(revenue)) OVER () AS DOUBLE) * 100.0, 2) AS revenue_share_pct
        FROM m_sales s JOIN m_products p ON p.product_id = s.product_id
        GROUP BY p.product_id, product_name, category ORDER BY SUM(revenue) DESC, p.product_id LIMIT 10""",
    "top_products_delivered": """SELECT product_id, product_name, category, CAST(SUM(quantity) AS BIGINT) AS units_sold,
        CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue, CAST(SUM(line_profit) AS DOUBLE) AS total_profit
        FROM m_fct_items JOIN orders ON o_orderkey = order_id WHERE o_orderstatus = 'F'
        GROUP BY product_id, product_name, category ORDER BY SUM(total_revenue) DESC, product_id LIMIT 20""",
    "top_products_api": """SELECT product_id, product_name, category, CAST(SUM(quantity) AS BIGINT) AS total_units,
        CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue, CAST(SUM(line_profit) AS DOUBLE) AS total_profit
        FROM m_fct_items GROUP BY product_id, product_name, category ORDER BY SUM(total_revenue) DESC, product_id LIMIT 10""",
    "top_product_names": """SELECT product_name, CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue,
        CAST(SUM(quantity) AS BIGINT) AS total_units
        FROM m_fct_items GROUP BY product_name ORDER BY SUM(total_revenue) DESC, product_name LIMIT 10""",
    "pivot_top_products": """SELECT product_name, CAST(SUM(revenue) AS DOUBLE) AS revenue, CAST(SUM(quantity) AS BIGINT) AS units
        FROM m_base WHERE year(order_date) = 1998 AND region = 'EUROPE'
        GROUP BY product_name ORDER BY SUM(revenue) DESC, product_name LIMIT 10""",
    "customer_ltv": """SELECT customer_id, COALESCE(MAX(customer_name), CAST(customer_id AS VARCHAR)) AS customer_name,
        COUNT(DISTINCT order_id) AS orders_count, CAST(SUM(quantity) AS BIGINT) AS lifetime_units,
        CAST(SUM(revenue) AS DOUBLE) AS lifetime_revenue,
        ROUND(CAST(SUM(revenue) AS DOUBLE) / COUNT(DISTINCT order_id), 2) AS avg_order_value
        FROM m_sales JOIN m_named_orders USING (order_id) GROUP BY customer_id
        ORDER BY SUM(revenue) DESC, customer_id LIMIT 20""",
    "top_customers_ps": """SELECT customer_id, customer_name, CAST(SUM(revenue) AS DOUBLE) AS lifetime_revenue,
        CAST(SUM(quantity) AS BIGINT) AS lifetime_units, COUNT(DISTINCT order_id) AS orders_count
        FROM m_sales JOIN m_named_orders USING (order_id) GROUP BY customer_id, customer_name
        ORDER BY SUM(revenue) DESC, customer_id, customer_name LIMIT 10""",
    "kpis": _KPIS,
    "kpis_starter": """SELECT CAST(SUM(revenue) AS DOUBLE) AS total_revenue, CAST(SUM(profit) AS DOUBLE) AS total_profit,
        CAST(SUM(quantity) AS BIGINT) AS total_units, (SELECT COUNT(DISTINCT o_orderkey) FROM orders) AS total_orders,
        CAST(SUM(revenue) AS DOUBLE) / (SELECT COUNT(DISTINCT o_orderkey) FROM orders) AS aov,
        CAST(SUM(profit) AS DOUBLE) / CAST(SUM(revenue) AS DOUBLE) * 100.0 AS margin_pct FROM m_base_some_cost""",
    "measures": """SELECT year, region, CAST(rev AS DOUBLE) AS total_revenue, CAST(units AS BIGINT) AS total_units,
        n AS total_orders, CAST(rev AS DOUBLE) / n AS aov, CAST(rev - prof AS DOUBLE) AS total_cost,
        CAST(prof AS DOUBLE) AS total_profit, CAST(prof AS DOUBLE) / CAST(rev AS DOUBLE) AS profit_margin,
        CAST(rev AS DOUBLE) AS customer_ltv
        FROM (SELECT CAST(year(order_date) AS INTEGER) AS year, region, COUNT(*) AS n FROM m_orders GROUP BY ALL)
        LEFT JOIN (SELECT CAST(year(order_date) AS INTEGER) AS year, region, SUM(revenue) AS rev, SUM(quantity) AS units,
                          SUM(profit) AS prof FROM m_base_some_cost GROUP BY ALL) USING (year, region)""",
    "measures_by_customer": """SELECT o.customer_id, COUNT(DISTINCT o.order_id) AS total_orders,
        CAST(SUM(revenue) AS DOUBLE) AS customer_ltv
        FROM m_orders o LEFT JOIN m_sales s ON s.order_id = o.order_id GROUP BY o.customer_id""",
    "measures_by_category": """SELECT category, region, CAST(SUM(revenue) AS DOUBLE) AS total_revenue,
        CAST(SUM(quantity) AS BIGINT) AS total_units, COUNT(DISTINCT order_id) AS total_orders,
        CAST(SUM(revenue) AS DOUBLE) / COUNT(DISTINCT order_id) AS aov, CAST(SUM(revenue - profit) AS DOUBLE) AS total_cost,
        CAST(SUM(profit) AS DOUBLE) AS total_profit, CAST(SUM(profit) AS DOUBLE) / CAST(SUM(revenue) AS DOUBLE) AS profit_margin,
        CAST(SUM(revenue) AS DOUBLE) AS customer_ltv
        FROM (SELECT s.*, category, revenue - COALESCE(unit_cost, 0) * quantity AS profit
              FROM m_sales_orders s JOIN m_products_some_cost p ON p.product_id = s.product_id) GROUP BY category, region""",
    "measures_enterprise": """SELECT CAST(year(order_date) AS INTEGER) AS year, region, CAST(SUM(order_revenue) AS DOUBLE) AS revenue,
        CAST(SUM(order_profit) AS DOUBLE) AS profit, COUNT(DISTINCT order_id) AS orders,
        CAST(SUM(order_profit) AS DOUBLE) / CAST(SUM(order_revenue) AS DOUBLE) AS margin,
        CAST(SUM(order_revenue) AS DOUBLE) / COUNT(DISTINCT order_id) AS aov FROM m_fct_orders GROUP BY ALL""",
    "top_products_by_profit": """SELECT product_id, product_name, category, CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue,
        CAST(SUM(quantity) AS BIGINT) AS units_sold, CAST(SUM(line_profit) AS DOUBLE) AS total_profit
        FROM m_fct_items JOIN m_orders USING (order_id) WHERE order_status = 'F' GROUP BY product_id, product_name, category
        ORDER BY SUM(line_profit) DESC, product_id LIMIT 20""",
    "rfm_base": "SELECT * REPLACE (CAST(monetary AS DOUBLE) AS monetary) FROM m_rfm_base",
    "rfm_summary": "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM m_rfm_summary",
    "cohort_retention": "SELECT * FROM m_retention",
    "cohort_retention_by_month": "SELECT * FROM m_retention",
    "cohort_first_curve": "SELECT * FROM m_retention WHERE cohort_month = (SELECT MIN(cohort_month) FROM m_retention)",
    "segment_summary": """SELECT segment, COUNT(customer_id) AS customers,
        CAST(SUM(CAST(lifetime_value AS DECIMAL(24,2))) AS DOUBLE) / COUNT(*) AS avg_ltv
        FROM m_dim_customers GROUP BY segment""",
    "user_item_matrix": "SELECT customer_id, product_id, CAST(qty AS BIGINT) AS qty FROM m_matrix",
    "status_rates_by_region": """SELECT region, COUNT(*) AS orders,
        CAST(COUNT(*) FILTER (order_status = 'P') AS DOUBLE) / COUNT(*) AS return_rate,
        CAST(COUNT(*) FILTER (order_status = 'O') AS DOUBLE) / COUNT(*) AS cancel_rate FROM m_orders GROUP BY region""",
    "month_category_matrix": f"SELECT month_start, {_pivot('category', _CATEGORIES)} FROM m_monthly_category GROUP BY month_start",
    "pivot_month_region": f"""SELECT CAST(year(month_start) AS INTEGER) AS year, monthname(month_start) AS month_name,
        {_pivot('region', _REGIONS)} FROM m_monthly_region GROUP BY 1, 2""",
    "pivot_monthly_trend": """SELECT CAST(year(month_start) AS INTEGER) AS year, monthname(month_start) AS month_name,
        CAST(revenue AS DOUBLE) AS revenue, CAST(units AS BIGINT) AS units, orders,
        CAST(revenue AS DOUBLE) / orders AS aov FROM m_monthly""",
    "pivot_region_margin": """SELECT region, CAST(SUM(revenue) AS DOUBLE) AS revenue, CAST(SUM(profit) AS DOUBLE) AS profit,
        CAST(SUM(profit) AS DOUBLE) / CAST(SUM(revenue) AS DOUBLE) AS margin FROM m_base GROUP BY region""",
    "category_contribution": """SELECT category, CAST(revenue AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS profit,
        CAST(revenue AS DOUBLE) / CAST(SUM(revenue) OVER () AS DOUBLE) * 100.0 AS revenue_share_pct, profit_margin_pct
        FROM m_by_category""",
    "date_bounds": "SELECT MIN(order_date) AS min_date, MAX(order_date) AS max_date FROM m_orders",
    "monthly_by_dimension": """SELECT month_start, region AS value_name, CAST(revenue AS DOUBLE) AS revenue, 'region' AS dimension
        FROM m_monthly_region
        UNION ALL SELECT month_start, category, CAST(revenue AS DOUBLE), 'category' FROM m_monthly_category""",
    # windows
    "mom_growth_lag": _growth("m_product_months", "PARTITION BY product_id", digits=2),
    "mom_growth_by_region": f"""SELECT * FROM (
        {_growth("m_monthly_region", "PARTITION BY region", 2, "region_mom_growth_pct")}) WHERE prev_revenue IS NOT NULL""",
    "mom_growth_by_category": f"""SELECT * FROM (
        {_growth("m_monthly_category", "PARTITION BY category", 2, "category_mom_growth_pct")}) WHERE prev_revenue IS NOT NULL""",
    "mom_growth_zero_filled": f"""WITH filled AS (
            SELECT c.product_id, CAST(c.month_start AS DATE) AS month_start, COALESCE(revenue, 0) AS revenue
            FROM (SELECT product_id, unnest(generate_series(MIN(month_start), MAX(month_start), INTERVAL 1 MONTH)) AS month_start
                  FROM m_product_months GROUP BY product_id) c
            LEFT JOIN m_product_months s ON s.product_id = c.product_id AND s.month_start = c.month_start)
        {_growth("filled", "PARTITION BY product_id")}""",
    "mom_growth_calendar": _calendar_growth(1, "mom_growth_pct"),
    "yoy_growth_calendar": _calendar_growth(12, "yoy_growth_pct"),
    "rfm_ntile": "SELECT customer_id, r_score, f_score, m_score FROM m_rfm_ntile",
    "rfm_qcut": "SELECT customer_id, r_score, f_score, m_score FROM m_rfm_qcut",
    "global_row_number": """SELECT o_orderkey AS order_id, ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS rn,
        COUNT(*) OVER () AS n FROM orders""",
    "revenue_share": """SELECT product_id, CAST(SUM(revenue) AS DOUBLE) AS revenue, CAST(SUM(quantity) AS BIGINT) AS units,
        CAST(SUM(revenue) AS DOUBLE) / CAST(SUM(SUM(revenue)) OVER () AS DOUBLE) * 100.0 AS revenue_share_pct
        FROM m_sales GROUP BY product_id""",
    "sales_drop_months": "SELECT * FROM m_dropped",
    "row_number_topk": "SELECT product_id, neighbour_id, similarity, rank FROM m_nearest",
    "cohort_first_month": "SELECT DISTINCT customer_id, cohort_month FROM m_cohort_orders",
    # sorts and limits
    "order_by_single": """SELECT month_start, CAST(revenue AS DOUBLE) AS revenue, CAST(units AS BIGINT) AS units_sold, orders
        FROM m_monthly ORDER BY month_start""",
    "order_by_multi": """SELECT order_status, CAST(order_revenue AS DOUBLE) AS order_revenue, order_id
        FROM m_fct_orders ORDER BY order_status, order_revenue DESC NULLS LAST, order_id""",
    "top_k": """SELECT payment_id, order_id, payment_date, payment_method, payment_status, CAST(amount AS DOUBLE) AS amount
        FROM m_payments ORDER BY amount DESC, payment_id LIMIT 50""",
    "argmax_argmin_row": """SELECT month_start, CAST(revenue AS DOUBLE) AS revenue, CAST(units AS BIGINT) AS units_sold, orders,
        CASE WHEN revenue = (SELECT MAX(revenue) FROM m_monthly) THEN 'best' ELSE 'worst' END AS which
        FROM m_monthly WHERE revenue = (SELECT MAX(revenue) FROM m_monthly) OR revenue = (SELECT MIN(revenue) FROM m_monthly)""",
    "top_k_per_group": """SELECT customer_id, order_id, CAST(order_revenue AS DOUBLE) AS order_revenue,
        CAST(ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY m_fct_orders.order_revenue DESC NULLS LAST, order_id) AS INTEGER) AS rank
        FROM m_fct_orders QUALIFY rank <= 5""",
    # set operations
    "row_count_audit": """SELECT 'orders' AS table_name, COUNT(*) AS row_count FROM orders
        UNION ALL SELECT 'products', COUNT(*) FROM part UNION ALL SELECT 'sales', COUNT(*) FROM lineitem""",
    "distinct_values": "SELECT DISTINCT l_orderkey AS order_id FROM lineitem",
    # scalar functions
    "scalar_dates": """SELECT order_id, CAST(date_trunc('month', order_date) AS DATE) AS month_start,
        CAST(month(order_date) AS INTEGER) AS month_num, CAST(year(order_date) AS INTEGER) AS year,
        strftime(order_date, '%Y-%m') AS month_label, CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
        CAST(order_date - DATE '1995-01-01' AS INTEGER) AS days,
        CAST(date_diff('month', DATE '1995-01-01', order_date) AS INTEGER) AS months,
        CONCAT('Q', quarter(order_date)) AS quarter, monthname(order_date) AS month_name, dayname(order_date) AS day_name,
        CAST(CASE WHEN month(order_date) = 12 AND week(order_date) = 1 THEN 53 ELSE week(order_date) END AS INTEGER) AS week_of_year,
        CAST(day(order_date) AS INTEGER) AS day_of_month, CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
        CAST(date_trunc('month', order_date) - INTERVAL 1 MONTH AS DATE) AS previous_month FROM m_orders""",
    "scalar_numeric": """SELECT order_id, s.product_id, CAST(ROUND(revenue, 2) AS DOUBLE) AS revenue_half_up,
        CAST(CASE WHEN abs(revenue * 100) % 1 = 0.5 THEN floor(revenue * 50 + 0.5) * 2 / 100 ELSE ROUND(revenue, 2) END AS DOUBLE)
            AS revenue_half_even,
        CAST(revenue AS DOUBLE) / NULLIF(CAST(quantity - 25 AS DOUBLE), 0) AS guarded_ratio,
        COALESCE(CAST(revenue AS DOUBLE) / NULLIF(CAST(quantity - 25 AS DOUBLE), 0), 0.0) AS ratio_or_zero,
        CAST(COALESCE(unit_cost, 0) AS DOUBLE) AS cost_or_zero, CAST(quantity AS DOUBLE) / 50.0 * 100.0 AS quantity_pct,
        CAST(trunc(revenue) AS INTEGER) AS revenue_int, CAST(quantity - 1 AS DOUBLE) / 49.0 AS quantity_index
        FROM m_sales s JOIN m_products_some_cost p ON p.product_id = s.product_id""",
    "scalar_text_case": """SELECT order_id, product_id, CONCAT(quantity, product_id % 5) AS code, size,
        CAST(CASE size WHEN 'large' THEN 3 WHEN 'medium' THEN 2 END AS INTEGER) AS weight,
        CAST(CASE size WHEN 'large' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END AS INTEGER) AS weight_or_one
        FROM (SELECT *, CASE WHEN quantity >= 40 THEN 'large' WHEN quantity >= 20 THEN 'medium' ELSE 'small' END AS size FROM m_sales)""",
    # time series, dimensions and models
    "resample_month_start": """SELECT c.region, CAST(c.month AS DATE) AS month_start, COUNT(o.order_id) AS orders
        FROM (SELECT region, unnest(generate_series(date_trunc('month', MIN(order_date)), date_trunc('month', MAX(order_date)),
                                                    INTERVAL 1 MONTH)) AS month FROM m_orders GROUP BY region) c
        LEFT JOIN m_orders o ON o.region = c.region AND date_trunc('month', o.order_date) = c.month GROUP BY ALL""",
    "date_dimension": "SELECT * FROM m_calendar",
    "item_similarity": "SELECT product_id, neighbour_id, similarity FROM m_similarity",
    "recommendations": """SELECT customer_id, product_id AS recommended_product_id,
        round_even(CAST(points AS DOUBLE) / 1000000000000, 4) AS score
        FROM (SELECT customer_id, n.neighbour_id AS product_id, SUM(CAST(round(similarity * 1000000000000) AS BIGINT)) AS points
              FROM m_matrix m JOIN m_nearest n ON n.product_id = m.product_id GROUP BY ALL) c
        ANTI JOIN m_matrix USING (customer_id, product_id)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY points DESC, product_id) <= 5""",
    "forecast_revenue": """SELECT month, ROUND(forecast_revenue, 2) AS forecast_revenue, method,
        ROUND((forecast_revenue - MIN(f.forecast_revenue) OVER ())
              / (MAX(f.forecast_revenue) OVER () - MIN(f.forecast_revenue) OVER ()), 8) AS forecast_index FROM m_forecast f""",
    "forecast_by_region": """SELECT region, month, ROUND(forecast_revenue, 2) AS forecast_revenue, method,
        ROUND((f.forecast_revenue - MIN(f.forecast_revenue) OVER (PARTITION BY region))
              / (MAX(f.forecast_revenue) OVER (PARTITION BY region) - MIN(f.forecast_revenue) OVER (PARTITION BY region)), 8)
            AS forecast_index FROM m_forecast_region f""",
    "forecast_fallback_mean": "SELECT customer_id, month, ROUND(forecast_revenue + 1e-6, 2) AS forecast_revenue, method FROM m_forecast_revenue",
    "forecast_trend_only": "SELECT customer_id, month, ROUND(forecast_revenue + 1e-6, 2) AS forecast_revenue, method FROM m_forecast_profit",
    "forecast_index": """SELECT month, ROUND((f.forecast_revenue - MIN(f.forecast_revenue) OVER ())
        / (MAX(f.forecast_revenue) OVER () - MIN(f.forecast_revenue) OVER ()), 8) AS forecast_index FROM m_forecast12 f""",
    "rfm_crm_export": "SELECT * FROM m_rfm_export",
    "rfm_sql": f"""SELECT customer_id, recency_days, frequency, CAST(monetary AS DOUBLE) AS monetary, r_score, f_score, m_score,
        CONCAT(r_score, f_score, m_score) AS rfm_code, {SEGMENT} AS segment FROM m_rfm_ntile""",
    # insight tables
    "insights": """
        (SELECT 'demand' AS section, 'peak_month' AS name, strftime(month_start, '%Y-%m') AS label, CAST(revenue AS DOUBLE) AS value
         FROM m_trend ORDER BY revenue DESC, month_start LIMIT 1)
        UNION ALL (SELECT 'demand', 'weak_month', strftime(month_start, '%Y-%m'), CAST(revenue AS DOUBLE)
         FROM m_trend ORDER BY revenue, month_start LIMIT 1)
        UNION ALL (SELECT 'category', 'most_profitable', category, CAST(profit AS DOUBLE)
         FROM m_by_category ORDER BY profit DESC, category LIMIT 1)
        UNION ALL (SELECT 'category', 'least_profitable', category, CAST(profit AS DOUBLE)
         FROM m_by_category ORDER BY profit, category LIMIT 1)
        UNION ALL (SELECT 'category', 'highest_margin', category, profit_margin_pct
         FROM m_by_category ORDER BY profit_margin_pct DESC, category LIMIT 1)
        UNION ALL (SELECT 'category', 'lowest_margin', category, profit_margin_pct
         FROM m_by_category ORDER BY profit_margin_pct, category LIMIT 1)
        UNION ALL (SELECT 'region', 'top_region', region, CAST(revenue AS DOUBLE)
         FROM m_region_sales ORDER BY revenue DESC, region LIMIT 1)
        UNION ALL (SELECT 'region', 'low_region', region, CAST(revenue AS DOUBLE)
         FROM m_region_sales ORDER BY revenue, region LIMIT 1)
        UNION ALL (SELECT 'region', 'top_region_margin', region, CAST(profit AS DOUBLE) / CAST(revenue AS DOUBLE) * 100.0
         FROM m_region_sales ORDER BY revenue DESC, region LIMIT 1)
        UNION ALL SELECT 'retention', CONCAT('month_', k), CAST(k AS VARCHAR),
            COALESCE((SELECT MAX(retention_rate) FROM m_retention WHERE cohort_index = k
                      AND cohort_month = (SELECT MIN(cohort_month) FROM m_retention)), 0.0) * 100.0
         FROM (VALUES (1), (3), (6)) v(k)""",
    "forecast_insights": """
        SELECT 'forecast' AS section, 'mean_forecast' AS name, CAST(NULL AS VARCHAR) AS label,
               ROUND(AVG(forecast_revenue), 2) AS value FROM m_forecast
        UNION ALL (SELECT 'forecast', 'peak_month', strftime(month, '%Y-%m'), ROUND(forecast_revenue, 2)
         FROM m_forecast f ORDER BY f.forecast_revenue DESC, month LIMIT 1)""",
    "top_rfm_segment": """SELECT rfm_segment, customers, CAST(revenue AS DOUBLE) AS revenue FROM m_rfm_summary s
        ORDER BY s.revenue DESC, rfm_segment LIMIT 1""",
    "drop_alerts": f"""SELECT month_start, ROUND({_MOM}, 2) AS mom_growth_pct
        FROM (SELECT *, LAG(revenue) OVER (ORDER BY month_start) AS prev FROM m_monthly) WHERE {_MOM} <= -10""",
}

QUERIES["checks_while_writing"] = """
    WITH p AS (SELECT * FROM m_payments), s AS (SELECT * FROM m_fct_sales)
    SELECT 'fct_payments' AS table_name, 'rows' AS check_name, COUNT(*) AS n_rows FROM p
    UNION ALL SELECT 'fct_payments', 'payment_id is null', COUNT(*) FILTER (payment_id IS NULL) FROM p
    UNION ALL SELECT 'fct_payments', 'payment_method is null', COUNT(*) FILTER (payment_method IS NULL) FROM p
    UNION ALL SELECT 'fct_payments', 'amount_at_least_1000', COUNT(*) FILTER (NOT amount >= 1000) FROM p
    UNION ALL SELECT 'fct_sales', 'rows', COUNT(*) FROM s
    UNION ALL SELECT 'fct_sales', 'order_id is null', COUNT(*) FILTER (order_id IS NULL) FROM s
    UNION ALL SELECT 'fct_sales', 'region is null', COUNT(*) FILTER (region IS NULL) FROM s
    UNION ALL SELECT 'fct_sales', 'quantity_at_most_40', COUNT(*) FILTER (NOT quantity <= 40) FROM s
    UNION ALL SELECT 'fct_sales', 'cost_known', COUNT(*) FILTER (unit_cost IS NULL) FROM s"""
QUERIES["month_cube"] = """
    WITH l AS (
        SELECT CAST(date_trunc('month', o.order_date) AS DATE) AS month_start, o.region, p.category,
               p.product_id IS NOT NULL AS has_product, s.revenue, s.quantity
        FROM m_sales s JOIN m_orders o ON o.order_id = s.order_id LEFT JOIN m_products p ON p.product_id = s.product_id)
    SELECT CASE GROUPING(region) * 2 + GROUPING(category) WHEN 3 THEN 'month' WHEN 1 THEN 'region' WHEN 2 THEN 'category' ELSE 'cell' END AS grain,
           month_start, region, category, has_product, CAST(SUM(revenue) AS DOUBLE) AS revenue, CAST(SUM(quantity) AS BIGINT) AS units
    FROM l GROUP BY GROUPING SETS ((month_start), (month_start, region), (month_start, category, has_product),
                                   (month_start, region, category, has_product))"""
# The same results, from stored buckets and from the stored cube.
QUERIES |= {
    "bucketed_sales_orders": QUERIES["join_sales_orders"],
    "bucketed_items_filtered": QUERIES["items_orders_filtered"],
    "bucketed_fct_sales": QUERIES["fct_sales"],
    "cube_growth_by_region": QUERIES["mom_growth_by_region"],
    "cube_growth_by_category": QUERIES["mom_growth_by_category"],
    "cube_month_category_matrix": QUERIES["month_category_matrix"],
    "cube_seasonality": QUERIES["seasonality_profile"],
    "cube_drillthrough": QUERIES["drop_month_drillthrough"],
}

ORACLES = {name: with_model(sql) for name, sql in QUERIES.items()}
