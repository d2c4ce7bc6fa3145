"""Every named query against its expected SQL. ORACLE_SF picks the scale."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from ledgerloom.plans import catalog

FOLDER = f"/root/testdata/{os.environ.get('ORACLE_SF', 'sf0.001')}"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in entry.queries() if n in catalog.JOBS or n in entry.oracle_sql()])
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.collect()
    else:
        assert differences(df, con, sql) is None


def test_results_come_in_order(spark):
    """Jobs whose order is their feature: the comparison above sorts both sides."""

    def got(name, *columns):
        return [tuple(r) for r in entry.queries()[name](spark, FOLDER).select(*columns).collect()]

    assert got("order_by_single", "month_start") == sorted(got("order_by_single", "month_start"))
    multi = got("order_by_multi", "order_status", "order_revenue", "order_id")
    assert multi == sorted(multi, key=lambda r: (r[0], r[1] is None, -(r[1] or 0), r[2]))
    best = got("rfm_sql", "monetary", "customer_id")
    assert best == sorted(best, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    for name, measure in (("top_products_delivered", "total_revenue"), ("top_products_by_profit", "total_profit")):
        top = got(name, measure, "product_id")
        assert top == sorted(top, key=lambda r: (-r[0], r[1]))


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["month_start", "revenue", "orders", "profit", "mom_growth_pct"]
    assert df.count() > 0
