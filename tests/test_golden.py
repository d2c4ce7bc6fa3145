"""Published results, as literals: growth, retention, margins, forecast, insights."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import cohorts, forecast, insights, reports, rfm, timeseries
from ledgerloom.functions.numbers import percent

MONTHLY = [  # month, revenue, orders, profit, growth
    ("2024-01-01", 226462358.35, 3728, 61926987.76, None),
    ("2024-02-01", 239647144.2, 3543, 81113863.12, 5.8220650646156225),
    ("2024-03-01", 274065228.2, 4034, 93871422.35, 14.36198378866389),
    ("2024-04-01", 280986776.52, 4137, 96298909.21, 2.525511304538419),
    ("2024-05-01", 309515088.58, 4579, 106224089.01, 10.152902002478914),
    ("2024-06-01", 298763992.55, 4526, 101943138.65, -3.4735288929932606),
    ("2024-07-01", 262012600.87, 4214, 71716951.57, -12.301144915865137),
    ("2024-08-01", 295991422.74, 4478, 100109718.29, 12.96839226707991),
    ("2024-09-01", 301029987.48, 4588, 101999857.47, 1.7022671445536819),
    ("2024-10-01", 334784256.22, 5014, 114134604.2, 11.212925669819729),
    ("2024-11-01", 391761463.12, 5518, 144982464.25, 17.019081943494374),
    ("2024-12-01", 408046436.8, 5993, 149717302.61, 4.15685952117546),
    ("2025-01-01", 233456860.66, 3833, 64492969.53, -42.78669298258654),
    ("2025-02-01", 221143036.36, 3390, 75260219.46, -5.274560903966529),
    ("2025-03-01", 278340808.92, 4172, 94579200.62, 25.864604873602005),
    ("2025-04-01", 283004091.68, 4149, 97640625.95, 1.6753859335589816),
    ("2025-05-01", 298451108.98, 4533, 102061802.03, 5.458231083622045),
    ("2025-06-01", 304357449.68, 4409, 103420289.04, 1.9789977394239822),
    ("2025-07-01", 263660614.25, 4298, 72381789.77, -13.371394547032923),
    ("2025-08-01", 294864657.82, 4423, 101567911.29, 11.834927889689538),
    ("2025-09-01", 297929386.59, 4593, 101698637.3, 1.0393679570343206),
    ("2025-10-01", 355482789.37, 5230, 121618329.15, 19.31779991183045),
    ("2025-11-01", 390881900.59, 5559, 144497683.59, 9.9580379918633),
    ("2025-12-01", 429045348.98, 6041, 158062078.74, 9.76342172210989),
]
FORECAST = [  # month, revenue, index
    ("2026-01-01", 236496512.70564932, 0.149707822068065),
    ("2026-02-01", 224292457.0675277, 0.0),
    ("2026-03-01", 281797857.0049354, 0.7054219053943447),
    ("2026-04-01", 285859379.72275305, 0.755244828068109),
    ("2026-05-01", 300612093.7155707, 0.9362171824188081),
    ("2026-06-01", 305811615.3154716, 1.0),
]
CATEGORIES = [
    ("Electronics", 4692227352.48, 1625934342.31, 34.65165304598122),
    ("Sports", 1205754815.96, 399285638.47, 33.11499429111515),
    ("Home", 1094794008.98, 353426745.65, 32.28248809831188),
    ("Fashion", 710125831.0, 234256257.35, 32.9879927082951),
    ("Beauty", 294214542.88, 92345069.77, 31.386983412191277),
]
COHORTS = [  # first and second cohort, first months
    ("2024-01-01", 0, 3378, 3378, 1.0),
    ("2024-01-01", 1, 566, 3378, 0.167554766133807),
    ("2024-01-01", 2, 639, 3378, 0.1891651865008881),
    ("2024-01-01", 3, 662, 3378, 0.1959739490822972),
    ("2024-01-01", 6, 646, 3378, 0.19123741859088217),
    ("2024-02-01", 0, 2694, 2694, 1.0),
    ("2024-02-01", 1, 501, 2694, 0.18596881959910913),
]
SEGMENTS = [
    ("Champions", 3015, 1870408866.71, 23.845439469320066),
    ("Potential Loyalists", 4114, 1718331862.17, 62.36776859504132),
    ("Need Attention", 5271, 1245053831.08, 122.82640865110984),
    ("At Risk", 2052, 993476077.22, 179.9834307992203),
    ("Loyal Customers", 2756, 921978008.58, 24.9644412191582),
    ("Lost", 2698, 524436163.75, 345.3250555967383),
]


def date(text):
    return dt.date.fromisoformat(text)


@pytest.fixture
def monthly(rows):
    return rows.frame([(date(m), *r) for m, *r in MONTHLY], "month_start DATE, revenue DOUBLE, orders BIGINT, profit DOUBLE, golden DOUBLE")


def test_growth(monthly, rows):
    grown = timeseries.with_growth(monthly, "revenue")
    for now, golden in rows(grown.select("mom_growth_pct", "golden")):
        assert now == (pytest.approx(golden, rel=1e-12) if golden is not None else None)


def test_retention(rows):
    counts = rows.frame([(date(m), i, n) for m, i, n, *_ in COHORTS], "cohort_month DATE, cohort_index INT, customers BIGINT")
    got = rows(cohorts.with_retention(counts).select("cohort_month", "cohort_index", "customers", "cohort_size", "retention_rate"), "cohort_month", "cohort_index")
    assert got == [(date(m), *r) for m, *r in COHORTS]


def test_margin(rows):
    df = rows.frame(CATEGORIES, "category STRING, revenue DOUBLE, profit DOUBLE, golden DOUBLE")
    for got, golden in rows(df.select(percent("profit", "revenue"), "golden")):
        assert got == pytest.approx(golden, rel=1e-12)


def test_forecast(monthly, rows):
    got = rows(forecast.forecast_revenue(monthly).select("month", "forecast_revenue"), "month")
    assert [m for m, _ in got] == [date(m) for m, *_ in FORECAST]
    # the published numbers come from an iterative fit; the closed form stays within 0.6 %
    assert [v for _, v in got] == pytest.approx([v for _, v, _ in FORECAST], rel=0.006)


def test_forecast_index(rows):
    df = rows.frame([(date(m), v) for m, v, _ in FORECAST], "month DATE, forecast_revenue DOUBLE")
    got = rows(forecast.with_forecast_index(df).select("forecast_index", "month"), "month")
    assert [i for i, _ in got] == pytest.approx([i for *_, i in FORECAST], abs=1e-12)


def test_insights(monthly, rows):
    categories = rows.frame(CATEGORIES, "category STRING, revenue DOUBLE, profit DOUBLE, profit_margin_pct DOUBLE")
    regions = rows.frame([("South", 1919197180.79, 649648245.7), ("Unknown", 8241037.25, 1.0), ("East", 5e8, 2.0)], "region STRING, revenue DOUBLE, profit DOUBLE")
    retention = rows.frame([(date(m), *r) for m, *r in COHORTS], "cohort_month DATE, cohort_index INT, customers BIGINT, cohort_size BIGINT, retention_rate DOUBLE")
    facts = {r["name"]: (r["label"], round(r["value"], 2)) for r in insights.insights(monthly, categories, regions, retention).collect()}
    assert facts["peak_month"] == ("2025-12", 429045348.98)
    assert facts["weak_month"] == ("2025-02", 221143036.36)
    assert facts["most_profitable"] == ("Electronics", 1625934342.31)
    assert facts["lowest_margin"] == ("Beauty", 31.39)
    assert facts["top_region"] == ("South", 1919197180.79)
    assert facts["top_region_margin"] == ("South", 33.85)
    assert facts["low_region"] == ("Unknown", 8241037.25)
    assert (facts["month_1"][1], facts["month_3"][1], facts["month_6"][1]) == (16.76, 19.6, 19.12)
    future = rows.frame([(date(m), v) for m, v, _ in FORECAST], "month DATE, forecast_revenue DOUBLE")
    ahead = {r["name"]: (r["label"], round(r["value"], 2)) for r in insights.forecast_insights(future).collect()}
    assert ahead == {"mean_forecast": (None, 272478319.26), "peak_month": ("2026-06", 305811615.32)}


def test_totals_agree(monthly, rows):
    total = monthly.agg(F.sum("orders"), F.round(F.sum("revenue"), 2), F.round(F.sum("profit"), 2)).first()
    assert tuple(total) == (108982, 7273684809.51, 2461320844.96)
    orders = monthly.select(
        F.col("month_start").cast("string").alias("order_id"), F.lit("N").alias("region"), F.lit("Delivered").alias("order_status"),
        F.col("revenue").cast("decimal(14,2)").alias("order_revenue"), F.col("profit").cast("decimal(14,2)").alias("order_profit"),
        F.lit(1).alias("order_items_count"),
    )
    one = reports.kpis(orders, orders.select(F.col("order_id").alias("customer_id"))).first()
    assert (one["total_revenue"], one["total_profit"], one["profit_margin_pct"]) == (7273684809.51, 2461320844.96, 33.84)


def test_best_segment(rows):
    df = rows.frame(SEGMENTS, "rfm_segment STRING, customers BIGINT, revenue DOUBLE, avg_recency_days DOUBLE")
    assert rows(rfm.top_rfm_segment(df)) == [("Champions", 3015, 1870408866.71)]
    assert sum(r[1] for r in SEGMENTS) == 19906
