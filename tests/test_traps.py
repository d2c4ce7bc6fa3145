"""Small fixtures for rules that are easy to get wrong."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, lookups, numbers
from ledgerloom.operators import clean, cohorts, forecast, model, quality, ranking, reports, rfm, timeseries


def day(text):
    return dt.date.fromisoformat(text)


ORDERS = "order_id STRING, order_date DATE, customer_id STRING, region STRING, order_status STRING"
ITEMS = "order_id STRING, line_no INT, product_id STRING, quantity INT, unit_selling_price DECIMAL(12,2)"
PRODUCTS = "product_id STRING, product_name STRING, category STRING, brand STRING, unit_price DECIMAL(12,2), unit_cost DECIMAL(12,2)"
CUSTOMERS = "customer_id STRING, customer_name STRING, email STRING, region STRING, city STRING, signup_date DATE, segment STRING"


@pytest.fixture
def shop(rows):
    """Two statuses, an order without items, an item of an unknown product, a product without cost."""
    orders = rows.frame(
        [
            ("o1", day("2024-01-05"), "c1", "North", "Delivered"),
            ("o2", day("2024-01-20"), "c1", "North", "Returned"),
            ("o3", day("2024-03-02"), "c1", "South", "Cancelled"),
            ("o4", day("2024-03-09"), "c2", "South", "Delivered"),
            ("o5", day("2024-03-10"), "c3", None, "Delivered"),
        ],
        ORDERS,
    )
    items = rows.frame(
        [
            ("o1", 1, "p1", 2, D("10.00")),
            ("o1", 2, "p2", 1, D("5.00")),
            ("o2", 1, "p1", 1, D("10.00")),
            ("o3", 1, "p9", 3, D("1.00")),
            ("o5", 1, "p1", 1, D("9.50")),
        ],
        ITEMS,
    )
    products = rows.frame(
        [("p1", "Mug", "Home", "B", D("10.00"), D("6.00")), ("p2", "Pen", "Desk", "B", D("5.00"), None)], PRODUCTS
    )
    customers = rows.frame(
        [(c, c.upper(), None, "North", "X", None, "Consumer") for c in ("c1", "c2", "c3", "c4")], CUSTOMERS
    )
    star = model.build_star(
        {"orders": orders, "order_items": items, "products": products, "customers": customers, "payments": orders}
    )
    return star


def test_status_is_a_parameter_and_features_use_all(shop, rows):
    ltv = {r["customer_id"]: r for r in shop["dim_customers"].collect()}
    assert ltv["c1"]["lifetime_value"] == D("38.00") and ltv["c1"]["order_frequency"] == 3
    one = reports.kpis(shop["fct_orders"], shop["dim_customers"]).first()
    assert (one["total_revenue"], one["total_orders"], one["total_customers"]) == (34.5, 3, 4)
    every = reports.kpis(shop["fct_orders"], shop["dim_customers"], None).first()
    assert every["total_orders"] == 5


def test_empty_groups_sum_to_zero(shop):
    found = {r["customer_id"]: r for r in shop["dim_customers"].collect()}
    assert found["c2"]["lifetime_value"] == 0 and found["c2"]["order_frequency"] == 1  # its order has no items
    assert found["c2"]["avg_order_value"] == 0
    base = {r["customer_id"]: r for r in rfm.rfm_qcut(rfm.rfm_base(shop["fct_orders"])).collect()}
    assert base["c2"]["monetary"] == 0


def test_orders_without_items_keep_null_totals(shop):
    o4 = shop["fct_orders"].filter("order_id = 'o4'").first()
    assert o4["order_revenue"] is None and o4["order_items_count"] is None


def test_tenure_is_clipped_but_stays_null(shop):
    tenure = {r["customer_id"]: r["customer_tenure_days"] for r in shop["dim_customers"].collect()}
    assert tenure == {"c1": 57, "c2": 1, "c3": 1, "c4": None}


def test_null_keys_are_dropped_in_frame_jobs(shop):
    categories = {r["category"] for r in reports.profit_by_category(shop["fct_order_items"]).collect()}
    assert categories == {"Home", "Desk"}
    regions = {r["region"]: r["revenue"] for r in reports.region_sales(shop["fct_orders"]).collect()}
    assert regions == {"North": D("35.00"), "South": D("3.00")}
    assert reports.kpis(shop["fct_orders"], shop["dim_customers"]).first()["active_regions"] == 2


def test_null_cost_skip_and_zero(shop, rows):
    desk = reports.profit_by_category(shop["fct_order_items"]).filter("category = 'Desk'").first()
    assert desk["profit"] == 0 and desk["revenue"] == D("5.00")
    priced = rows.frame([(D("5.00"), None, 1)], "revenue DECIMAL(12,2), unit_cost DECIMAL(12,2), quantity INT")
    assert rows(priced.select(model.profit("zero"), model.profit("skip"))) == [(D("5.00"), None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_dedupe_keeps_first_by_given_order(rows, seed):
    df = rows.frame([("a", 3, "z"), ("a", 1, "y"), ("a", 1, "x"), ("b", None, "q"), (None, 1, "n")], "k STRING, v INT, w STRING")
    shuffled = df.orderBy(F.rand(seed)).repartition(4)
    assert rows(clean.dedupe(shuffled, ["k"]), "k") == [(None, 1, "n"), ("a", 1, "x"), ("b", None, "q")]


def test_fill_defaults_keeps_types(rows):
    df = rows.frame([(None, None, "x")], "quantity INT, unit_selling_price DECIMAL(12,2), city STRING")
    filled = clean.fill_defaults(df, {"quantity": 1, "unit_selling_price": 0, "city": "Unknown", "absent": 1})
    assert filled.dtypes == df.dtypes and rows(filled) == [(1, D("0.00"), "x")]


def test_cast_rejects(rows):
    df = rows.frame([("1", "2024-01-01"), ("x", "2024-01-01"), (None, None), ("2", "bad")], "n STRING, d STRING")
    good, bad = clean.cast_with_rejects(df, "n INT, d DATE")
    assert rows(good, "n") == [(None, None), (1, day("2024-01-01"))]
    assert rows(bad, "n") == [("2", "bad"), ("x", "2024-01-01")]


def test_three_meanings_of_previous_month(rows):
    df = rows.frame(
        [(day("2024-01-01"), 100), (day("2024-03-01"), 50), (day("2024-04-01"), 0), (day("2024-05-01"), 10)],
        "month_start DATE, revenue INT",
    )

    def growth(frame, **kw):
        return [r["mom_growth_pct"] for r in timeseries.with_growth(frame, "revenue", **kw).orderBy("month_start").collect()]

    assert growth(df) == [None, -50.0, -100.0, None]
    assert growth(df, mode="calendar") == [None, None, -100.0, None]
    filled = timeseries.resample_months(df, "month_start", {"revenue": F.sum("revenue")})
    assert [r["revenue"] for r in filled.orderBy("month_start").collect()] == [100, 0, 50, 0, 10]
    assert growth(filled) == [None, -100.0, None, -100.0, None]
    yoy = timeseries.with_growth(df, "revenue", mode="calendar", months_back=2, previous="before")
    assert [r["before"] for r in yoy.orderBy("month_start").collect()] == [None, 100, None, 50]
    with pytest.raises(ValueError):
        timeseries.with_growth(df, "revenue", mode="other")


def test_resample_per_group_spans_each_group(rows):
    df = rows.frame(
        [("a", day("2024-01-31")), ("a", day("2024-04-02")), ("b", day("2023-12-01")), ("b", None)], "g STRING, d DATE"
    )
    out = timeseries.resample_months(df, "d", {"n": F.count("*")}, by=["g"])
    assert [(g, str(m)[:7], n) for g, m, n in rows(out, "g", "month_start")] == [
        ("a", "2024-01", 1), ("a", "2024-02", 0), ("a", "2024-03", 0), ("a", "2024-04", 1), ("b", "2023-12", 1),
    ]


def test_zero_divisors(rows):
    df = rows.frame([(D("1.00"), D("0.00")), (D("0.00"), D("0.00"))], "a DECIMAL(9,2), b DECIMAL(9,2)")
    assert rows(df.select(numbers.ratio("a", "b"), numbers.percent("a", "b"))) == [(None, None)] * 2
    empty = rows.frame([], ORDERS + ", order_revenue DECIMAL(9,2), order_profit DECIMAL(9,2), order_items_count INT")
    one = reports.kpis(empty, rows.frame([], CUSTOMERS)).first()
    assert (one["profit_margin_pct"], one["avg_order_value"], one["total_revenue"], one["active_regions"]) == (0, 0, 0, 0)


def test_rounding_rules(rows):
    df = rows.frame([(D("0.125"), D("2.675"), 2.675)], "a DECIMAL(9,3), b DECIMAL(9,3), c DOUBLE")
    got = df.select(F.round("a", 2), F.bround("a", 2), F.round("b", 2), F.bround("b", 2), F.round("c", 2)).first()
    assert tuple(got) == (D("0.13"), D("0.12"), D("2.68"), D("2.68"), 2.68)


def _starter(rows, months):
    """One order per (month, revenue), each with one line of quantity 1."""
    orders = rows.frame([(str(i), day(m), "c", "C", "North") for i, (m, _) in enumerate(months)],
                        "order_id STRING, order_date DATE, customer_id STRING, customer_name STRING, region STRING")
    sales = rows.frame([(str(i), "p", 1, D(v)) for i, (_, v) in enumerate(months)],
                       "order_id STRING, product_id STRING, quantity INT, revenue DECIMAL(14,2)")
    return sales, orders


def test_drop_threshold_rounded_and_raw(rows):
    sales, orders = _starter(
        rows, [("2024-01-01", "1000.00"), ("2024-02-01", "900.00"), ("2024-03-01", "100000.00"), ("2024-04-01", "90004.00")]
    )
    dropped = [str(r["month_start"]) for r in reports.sales_drop_months(sales, orders).orderBy("month_start").collect()]
    assert dropped == ["2024-02-01", "2024-04-01"]  # -10 and -9.996, which rounds to -10.00
    alerts = [str(r["month_start"]) for r in reports.drop_alerts(sales, orders).collect()]
    assert alerts == ["2024-02-01"]
    flagged = timeseries.flag_below(reports.monthly_units(sales, orders), -10).filter("is_low")
    assert flagged.count() == 0  # strictly below


def test_two_seasonalities(rows):
    sales, orders = _starter(rows, [("2023-01-01", "10"), ("2023-01-02", "10"), ("2024-01-01", "40"), ("2024-02-01", "6")])
    assert rows(reports.seasonality(sales, orders).select("month_num", "avg_revenue"), "month_num") == [(1, 30.0), (2, 6.0)]
    assert rows(reports.seasonality_lines(sales, orders), "month_num") == [(1, 20.0), (2, 6.0)]


def test_orders_without_sales_count_only_where_they_should(rows):
    sales, orders = _starter(rows, [("2024-01-01", "10"), ("2024-01-02", "20")])
    sales = sales.filter("order_id = '0'")
    products = rows.frame([("p", "P", "Home", "B", D(1), D(4))], PRODUCTS)
    assert reports.monthly_sales(sales, orders).first()["aov"] == 10.0
    assert reports.kpis_starter(sales, orders, products).first()["aov"] == 5.0
    assert reports.measures(sales, orders, products, ["region"]).first()["aov"] == 5.0


def test_customer_without_name_shows_id(rows):
    sales, orders = _starter(rows, [("2024-01-01", "10")])
    unnamed = orders.withColumn("customer_name", F.lit(None).cast("string"))
    assert reports.customer_ltv(sales, unnamed).first()["customer_name"] == "c"


def test_week_of_year_at_year_end(rows):
    df = rows.frame([(day(d),) for d in ("2024-12-28", "2024-12-29", "2024-12-30", "2024-12-31", "2025-01-01", "2025-01-05",
                                         "2025-12-28", "2025-12-29", "2026-01-01", "2026-01-04", "2021-01-01")], "d DATE")
    weeks = [w for (w,) in rows(df.select(dates.week_of_year("d")))]
    assert weeks == [52, 52, 53, 53, 1, 1, 52, 53, 1, 1, 53]


def test_date_dimension_columns_and_default_range(rows):
    one = timeseries.date_dimension(rows.frame([(day("2024-02-29"), day("2024-02-29"))], "min_date DATE, max_date DATE"))
    assert tuple(one.first()) == (20240229, day("2024-02-29"), 2024, "Q1", 2, "February", 9, 29, "Thursday", 0)
    empty = timeseries.date_bounds(rows.frame([], "order_date DATE"))
    assert timeseries.date_dimension(empty).count() == 731


def test_every_rfm_score_has_the_first_matching_segment(rows):
    grid = rows.frame([(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)], "r INT, f INT, m INT")

    def expected(r, f, m):
        rules = [
            (min(r, f, m) >= 4, "Champions"),
            (r >= 4 and f >= 3, "Loyal Customers"),
            (r >= 3 and f >= 2 and m >= 2, "Potential Loyalists"),
            (r <= 2 and f >= 4, "At Risk"),
            (r == 1 and f <= 2, "Lost"),
        ]
        return next((name for hit, name in rules if hit), "Need Attention")

    got = rows(grid.select("r", "f", "m", lookups.rfm_segment("r", "f", "m")))
    assert all(s == expected(r, f, m) for r, f, m, s in got) and len({s for *_, s in got}) == 6
    acted = rfm.with_crm_actions(grid.withColumn("rfm_segment", lookups.rfm_segment("r", "f", "m")))
    assert acted.filter("crm_action IS NULL OR priority IS NULL").count() == 0


def test_lookup_with_and_without_default(rows):
    df = rows.frame([("North",), ("Nowhere",), (None,)], "region STRING")
    got = rows(df.select(lookups.region_latitude("region"), lookups.crm_action("region")))
    assert got == [(28.6139, None), (21.1458, None), (21.1458, None)]


def test_cohorts(rows):
    orders = rows.frame(
        [
            ("1", day("2024-01-05"), "a", None, "Delivered"), ("2", day("2024-01-25"), "a", None, "Delivered"),
            ("3", day("2024-03-05"), "a", None, "Delivered"), ("4", day("2024-01-09"), "b", None, "Delivered"),
            ("5", day("2024-02-09"), "b", None, "Returned"), ("6", day("2025-01-01"), "c", None, "Delivered"),
        ],
        ORDERS,
    )
    kept = cohorts.cohort_retention(orders).select("cohort_month", "cohort_index", "customers", "cohort_size", "retention_rate")
    assert [(str(a), *r) for a, *r in rows(kept, "cohort_month", "cohort_index")] == [
        ("2024-01-01", 0, 2, 2, 1.0), ("2024-01-01", 2, 1, 2, 0.5), ("2025-01-01", 0, 1, 1, 1.0),
    ]
    assert cohorts.first_cohort(kept).count() == 2
    assigned = cohorts.cohort_assign(orders).select("order_id", "cohort_index")
    assert rows(assigned, "order_id") == [("1", 0), ("2", 0), ("3", 2), ("4", 0), ("6", 0)]


@pytest.mark.parametrize("n, method", [(1, "mean"), (11, "mean"), (12, "trend"), (23, "trend"), (24, "trend+season"), (25, "trend+season")])
def test_forecast_branches(rows, n, method):
    start = 2020 * 12
    months = [(dt.date((start + i) // 12, (start + i) % 12 + 1, 1), D(100 + 10 * i)) for i in range(n)]
    df = rows.frame(months, "month_start DATE, revenue DECIMAL(20,2)")
    out = forecast.forecast_revenue(df, 3).orderBy("month").collect()
    assert [r["method"] for r in out] == [method] * 3
    first = start + n
    assert out[0]["month"] == dt.date(first // 12, first % 12 + 1, 1)
    line = [100 + 10 * (n + h) for h in range(3)]
    expected = [100 + 10 * (n - 1) / 2] * 3 if method == "mean" else line
    assert [r["forecast_revenue"] for r in out] == pytest.approx(expected)


def test_forecast_of_constant_series_and_partial_month(rows):
    months = [(dt.date(2020 + i // 12, i % 12 + 1, 1), D(50 if i < 24 else 1)) for i in range(25)]
    df = rows.frame(months, "month_start DATE, revenue DECIMAL(20,2)")
    out = forecast.with_forecast_index(forecast.forecast_revenue(df, 6, drop_partial_last=True)).orderBy("month").collect()
    assert [r["forecast_revenue"] for r in out] == pytest.approx([50.0] * 6)
    assert out[0]["month"] == dt.date(2022, 1, 1)
    flat = rows.frame([(7.0,), (7.0,)], "forecast_revenue DOUBLE")
    assert rows(forecast.with_forecast_index(flat).select("forecast_index")) == [(0.0,), (0.0,)]


def test_quality_checks(rows):
    df = rows.frame([(1, None), (1, 5), (2, -1), (None, 3)], "k INT, v INT")
    assert dict(rows(quality.check_not_null(df, ["k", "v"]))) == {"k": 1, "v": 1}
    assert rows(quality.check_unique(df, ["k"])) == [(1, 2)]
    assert dict(rows(quality.check_predicates(df, {"positive": F.col("v") > 0}))) == {"positive": 1}
    parent = rows.frame([(2,)], "k INT")
    assert rows(quality.check_foreign_key(df, parent, "k")) == [(1, 2)]
    assert quality.require_rows(df) is df
    with pytest.raises(ValueError):
        quality.require_rows(df.filter("k > 9"))


def test_counts_of_zero_fail_when_run(rows):
    df = rows.frame([(1,)], "k INT")
    counted = lambda d: quality.require_count(d.agg(F.count("*").alias("n")), "n", "the join")
    assert rows(counted(df)) == [(1,)]
    empty = counted(df.filter("k > 9"))  # nothing happens yet
    with pytest.raises(Exception, match="no rows in the join"):
        empty.collect()


def test_foreign_keys_counted_once_per_column(rows):
    child = rows.frame([(1, 7), (1, 8), (2, 7), (None, 9)], "k INT, v INT")
    links = {
        "a": (child, rows.frame([(1,), (1,)], "k INT"), "k"),
        "b": (child, rows.frame([(2,)], "k INT"), "k"),
        "c": (child, rows.frame([], "v INT"), "v"),
    }
    assert sorted(rows(quality.foreign_key_summary(links))) == [("a", 1, 1), ("b", 1, 2), ("c", 3, 4)]


def test_measures_of_a_product_column(rows):
    sales = rows.frame([("o1", "p", 1, D("5.00")), ("o1", "q", 2, D("8.00")), ("o2", "p", 1, D("5.00"))], "order_id STRING, product_id STRING, quantity INT, revenue DECIMAL(14,2)")
    products = rows.frame([("p", "mugs", D("2.00")), ("q", "pens", None)], "product_id STRING, category STRING, unit_cost DECIMAL(12,2)")
    orders = rows.frame([("o1", "N"), ("o2", "S"), ("o3", "S")], "order_id STRING, region STRING")
    by = reports.measures(sales, orders, products, ["category"], ["total_orders", "total_units", "total_profit"])
    assert rows(by, "category") == [("mugs", 2, 2, D("6.00")), ("pens", 2, 1, D("8.00"))] or rows(by, "category") == [
        ("mugs", 2, 2, D("6.0000")), ("pens", 2, 1, D("8.0000"))]
    both = reports.measures(sales, orders, products, ["region", "category"], ["total_orders"])
    assert rows(both, "region", "category") == [("N", "mugs", 1), ("N", "pens", 1), ("S", "mugs", 1)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_buckets_of_many_ties(spark, rows, partitions):
    """NTILE and quantile buckets of a frame of one value, of nulls, and of few rows."""
    for n in (1, 4, 5, 23):
        df = spark.range(0, n, 1, partitions).select("id", F.lit(3).alias("same"), F.when(F.col("id") > 2, -F.col("id")).alias("v"))
        out = rows(ranking.global_scores(df, "id", ["same", "v"], ranking.ntile_of), "id")
        sizes = [n // 5 + (k < n % 5) for k in range(5)]
        assert [sum(r[3] == k + 1 for r in out) for k in range(5)] == sizes
        assert [r[3] for r in out] == sorted(r[3] for r in out)  # ties by key
        place = sorted(out, key=lambda r: (r[2] is None, r[2] or 0, r[0]))
        assert [r[4] for r in place] == sorted(r[4] for r in out)


def test_slicers_and_display(rows):
    df = rows.frame([(day("2023-12-31"), "N"), (day("2024-01-01"), "N"), (day("2024-12-31"), "S")], "order_date DATE, region STRING")
    assert clean.slice_rows(df, year=2024).count() == 2
    assert clean.slice_rows(df, "2024-01-01", "2024-06-30", region="N").count() == 1
    assert clean.slice_rows(df, region=None).count() == 3
    assert df.select(numbers.display_number(F.lit(1234567.891))).first()[0] == "1,234,567.89"
