"""Retention from bitmaps of customers: equal to the plain counts, and months that are added."""

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import cohorts
from ledgerloom.plans import retention

COLUMNS = ["cohort_month", "cohort_index", "customers", "cohort_size", "retention_rate"]


@pytest.fixture(scope="module")
def orders(spark):
    """Ids around the edges of a bitmap, a month without orders, repeated, null and undelivered orders."""
    ids = [1, 2, 3, 32767, 32768, 32769, 65536, 65537, 10**12]
    rows = [(c, date(2023 + (m + 10) // 12, (m + 10) % 12 + 1, 1 + c % 28), "Delivered" if (c + m) % 7 else "Cancelled")
            for m in (0, 1, 2, 4, 5) for k, c in enumerate(ids) if (k * 5 + m * 3) % 4 or (k, m) == (0, 0)]
    rows += rows[:10] + [(None, date(2023, 11, 1), "Delivered"), (5, None, "Delivered"), (None, None, None)]
    return spark.createDataFrame(rows, "customer_id long, order_date date, order_status string")


def plain(orders):
    """The plain counts, which have a row of no month for orders without a date."""
    orders = orders.filter("order_date IS NOT NULL")
    return sorted(map(tuple, cohorts.cohort_retention(orders).select(*COLUMNS).collect()))


def kept(spark, path):
    return sorted(map(tuple, retention.retention(spark, path).select(*COLUMNS).collect()))


def months_of(orders):
    delivered = orders.filter("order_status = 'Delivered' AND order_date IS NOT NULL")
    return sorted(r[0] for r in delivered.select(F.trunc("order_date", "month")).distinct().collect())


def test_built_at_once(spark, orders, tmp_path):
    retention.build(orders, str(tmp_path))
    assert kept(spark, str(tmp_path)) == plain(orders) and len(plain(orders)) > 5


def test_added_month_by_month(spark, orders, tmp_path):
    path, months = str(tmp_path), months_of(orders)
    retention.build(orders.filter(F.col("order_date") < F.lit(months[1])), path)
    for month in months[1:]:
        before = {f: (f.stat().st_mtime_ns, f.read_bytes()) for f in Path(path).rglob("*.parquet")}
        # Only this month's orders are given, so nothing can come from earlier ones.
        retention.add_month(orders.filter(F.trunc("order_date", "month") == F.lit(month)), path, month)
        assert all(f.exists() and (f.stat().st_mtime_ns, f.read_bytes()) == old for f, old in before.items())
        until = F.trunc("order_date", "month") <= F.lit(month)
        assert kept(spark, path) == plain(orders.filter(until))


def test_last_month_again_and_earlier_ones(spark, orders, tmp_path):
    path, last = str(tmp_path), months_of(orders)[-1]
    retention.build(orders, path)
    more = orders.filter("order_date IS NOT NULL").union(spark.createDataFrame([(77, last, "Delivered")], orders.schema))
    for _ in range(2):
        retention.add_month(more, path, last)
        assert kept(spark, path) == plain(more)
    with pytest.raises(ValueError, match="build the tables anew"):
        retention.add_month(orders, path, date(2023, 12, 1))
    # A month without delivered orders adds nothing; a gap of months is fine.
    retention.add_month(orders, path, date(2031, 1, 1))
    assert kept(spark, path) == plain(more)


def test_no_orders(spark, orders, tmp_path):
    retention.build(orders.limit(0), str(tmp_path))
    assert kept(spark, str(tmp_path)) == []
    retention.add_month(orders, str(tmp_path), months_of(orders)[0])
    first = F.trunc("order_date", "month") == F.lit(months_of(orders)[0])
    assert kept(spark, str(tmp_path)) == plain(orders.filter(first))


def test_bitmaps_leave_map_tasks_as_one_row_a_month(orders):
    plan = cohorts.month_bitmaps(orders)._jdf.queryExecution().toString()
    assert "partial_bitmap_construct_agg" in plan and "Window" not in plan
