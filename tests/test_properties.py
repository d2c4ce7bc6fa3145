"""Properties over generated data, checked against pandas, numpy or plain windows."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import ranking, recommend, timeseries
from ledgerloom.plans import catalog
from ledgerloom.sources.testdata import TestModel

FOLDER = "/root/testdata/sf0.001"
few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_quantile_bins_equal_pandas_cut_for_every_size(spark):
    sizes = list(range(2, 60)) + [99, 100, 101, 398]
    frame = spark.createDataFrame([(n,) for n in sizes], "n BIGINT").withColumn("rn", F.explode(F.sequence(F.lit(1), F.col("n"))))
    got = frame.withColumn("bin", ranking.quantile_bin_of(F.col("rn"), F.col("n"))).toPandas().sort_values(["n", "rn"])
    for n, part in got.groupby("n"):
        expected = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int)
        assert part["bin"].tolist() == expected.tolist(), n
    single = spark.createDataFrame([(1, 1)], "rn BIGINT, n BIGINT").select(ranking.quantile_bin_of(F.col("rn"), F.col("n")))
    assert single.first()[0] == 1


def test_ntile_rule_equals_window_ntile(spark):
    for n in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 23, 104):
        df = spark.range(1, n + 1).withColumnRenamed("id", "rn").withColumn("n", F.lit(n).cast("bigint"))
        both = df.select(ranking.ntile_of(F.col("rn"), F.col("n")).alias("a"), F.ntile(5).over(Window.orderBy("rn")).alias("b"))
        assert both.filter("a <> b").count() == 0, n


@few
@given(st.lists(st.integers(-3, 3) | st.none(), max_size=60), st.integers(1, 5))
def test_global_row_number_equals_plain_window(spark, values, parts):
    data = [(i, v) for i, v in enumerate(values)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "id INT, v INT").repartition(parts)
    order = [F.asc_nulls_last("v"), F.asc("id")]
    got = ranking.global_row_number(df, order)
    both = got.withColumn("plain", F.row_number().over(Window.orderBy(*order)))
    assert both.filter(F.col("rn") != F.col("plain")).count() == 0
    assert got.filter(F.col("n") != len(values)).count() == 0 and got.count() == len(values)


def test_global_row_number_over_many_partitions_and_one_hot_value(spark):
    df = spark.range(50000).select("id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("v"))
    conf = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = [F.asc("v"), F.asc("id")]
        got = ranking.global_row_number(df.repartition(5), order)
        assert got.select(F.spark_partition_id()).distinct().count() > 4
        both = got.withColumn("plain", F.row_number().over(Window.orderBy(*order)))
        assert both.filter(F.col("rn") != F.col("plain")).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", conf)


@pytest.mark.parametrize("rule", [ranking.ntile_of, ranking.quantile_bin_of])
@pytest.mark.parametrize("few, accuracy", [(100_000, 10_000), (10, 20), (10, 2)])
def test_selected_buckets_equal_numbered_ones(spark, monkeypatch, rule, few, accuracy):
    """With and without brackets, brackets too narrow to hit included; ids as numbers and as texts of unlike length."""
    monkeypatch.setattr(ranking, "FEW", few)
    monkeypatch.setattr(ranking, "ACCURACY", accuracy)
    n = 997
    df = spark.range(n).select(
        (F.col("id") * 7919 % n).alias("num"), (F.xxhash64("id") % 100_000 / 100).alias("wide"), F.lit(5).alias("same"),
        F.when(F.col("id") % 3 > 0, 1).when(F.col("id") % 5 > 0, F.col("id") % 4).alias("tied"),
    )
    df = df.withColumn("text", F.concat(F.lit("customer-"), F.col("num").cast("string"), F.when(F.col("num") % 2 == 0, "é-long-tail").otherwise("")))
    names = ["wide", "same", "tied"]
    for key in ("num", "text"):
        got = ranking.global_scores(df, key, names, rule)
        for c in names:
            order = Window.partitionBy().orderBy(F.asc_nulls_last(F.col(c).cast("decimal(38,6)")), F.asc(key))
            both = got.withColumn("rn", F.row_number().over(order)).withColumn("n", F.lit(n).cast("bigint"))
            assert both.filter(F.col(f"{c}_bucket") != rule(F.col("rn"), F.col("n"))).count() == 0, (key, c)


def brute_force(cells, top_n=5, neighbours=19):
    """Dense cosine recommender over {(customer, product): qty}."""
    customers = sorted({c for c, _ in cells})
    products = sorted({p for _, p in cells})
    x = np.zeros((len(customers), len(products)))
    for (c, p), q in cells.items():
        x[customers.index(c), products.index(p)] = q
    norm = np.sqrt((x * x).sum(axis=0))
    sim = (x.T @ x) / np.outer(norm, norm)
    out = set()
    for i, c in enumerate(customers):
        own = set(np.flatnonzero(x[i]))
        scores = {}
        for p in own:
            near = sorted((j for j in range(len(products)) if j != p and sim[p, j] > 0), key=lambda j: (-round(sim[p, j], 12), j))
            for j in near[:neighbours]:
                if j not in own:
                    scores[j] = scores.get(j, 0) + sim[p, j]
        for j in sorted(scores, key=lambda j: (-round(scores[j], 9), j))[:top_n]:
            out.add((c, products[j], round(scores[j], 3)))
    return out


@pytest.mark.parametrize("block, probed", [(2, 0), (256, 0), (4, 1), (256, 2)])
def test_recommendations_equal_brute_force(spark, monkeypatch, block, probed):
    monkeypatch.setattr(recommend, "BLOCK", block)
    monkeypatch.setattr(recommend, "probe_of", lambda *_: probed)
    rng = random.Random(5)
    cells = {(c, p): rng.randint(1, 9) for c in range(12) for p in rng.sample(range(30), rng.randint(1, 9))}
    cells.update({(99, p): rng.randint(1, 9) for p in range(28)})  # one customer with nearly everything
    matrix = spark.createDataFrame([(c, p, q) for (c, p), q in cells.items()], "customer_id INT, product_id INT, qty BIGINT")
    got = {(r[0], r[1], round(r[2], 3)) for r in recommend.recommend(matrix).collect()}
    expected = brute_force(cells)
    assert {(c, p) for c, p, _ in got} == {(c, p) for c, p, _ in expected}
    scores = {(c, p): s for c, p, s in expected}
    assert all(abs(s - scores[c, p]) < 0.002 for c, p, s in got)
    owned = matrix.withColumnRenamed("product_id", "recommended_product_id")
    assert recommend.recommend(matrix).join(owned, ["customer_id", "recommended_product_id"]).count() == 0


def test_floors_bound_the_nearest_neighbours(spark, monkeypatch):
    """Dense purchases: the probe takes place, its floors hold, most pairs are not ranked, the neighbours are the same."""
    matrix = spark.range(60 * 200).select((F.col("id") % 60).alias("customer_id"), F.expr("id div 60").alias("product_id"), (F.xxhash64("id") % 50).alias("qty"))
    matrix = matrix.filter("qty > 0")
    neighbours = 5
    assert recommend.probe_of(recommend._pair_count(matrix), 200, neighbours) == 16
    plain = recommend.nearest_items(recommend.item_similarity(matrix), neighbours)
    plain = plain.select("product_id", "neighbour_id", recommend.points(F.col("similarity")).alias("points"), "rank")
    near = recommend.nearest_neighbours(matrix, neighbours)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, near.select(*plain.columns).collect()))
    floors = recommend.similarity_floors(recommend._sized(matrix), neighbours, 4)
    last = plain.filter(F.col("rank") == neighbours)
    assert floors.count() == 200 and floors.join(last, "product_id").filter("floor > points").count() == 0
    scores = recommend.item_similarity(matrix).join(floors, "product_id")
    reached = scores.filter(recommend.points(F.col("similarity")) >= F.col("floor")).count()
    assert reached < scores.count() / 4
    assert recommend.probe_of(1000, 100, 19) == 0 and recommend.probe_of(0, 0, 19) == 0


@pytest.mark.parametrize("pairs", [1, 20, 10**6])
def test_hot_products_are_dealt_to_several_tasks(spark, monkeypatch, pairs):
    """Neighbours are the same whether a product's buyers meet in one task or in many, with large customers too."""
    monkeypatch.setattr(recommend, "BLOCK", 3)
    rng = random.Random(8)
    cells = {(c, p): rng.randint(1, 9) for c in range(30) for p in rng.sample(range(40), rng.randint(1, 6))}
    cells.update({(c, 99): rng.randint(1, 9) for c in range(30)})  # one product that everyone has
    matrix = spark.createDataFrame([(c, p, q) for (c, p), q in cells.items()], "customer_id INT, product_id INT, qty BIGINT")
    plain = recommend.nearest_items(recommend.item_similarity(matrix), 4)
    plain = plain.select("product_id", "neighbour_id", recommend.points(F.col("similarity")).alias("points"), "rank")
    monkeypatch.setattr(recommend, "PAIRS", pairs)
    near = recommend.nearest_neighbours(matrix, 4).select(*plain.columns)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, near.collect()))


def test_recommendations_shuffle_purchases_and_not_pairs(spark):
    """Whatever is dealt to tasks has one row per purchase at most: no exchange by two products, none of sums."""
    matrix = spark.range(400).select((F.col("id") % 20).alias("customer_id"), (F.col("id") % 37).alias("product_id"), (F.col("id") % 5 + 1).alias("qty"))
    text = recommend.recommend(matrix)._jdf.queryExecution().executedPlan().toString()
    dealt = set(re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text))
    assert dealt and not [keys for keys in dealt if len(re.findall(r"product|neighbour", keys)) > 1 or ("customer" in keys and "product" in keys)], dealt


def test_pair_tasks_follow_pairs_and_cores(spark):
    matrix = spark.createDataFrame([(1, 1, 1), (1, 2, 1)], "customer_id INT, product_id INT, qty BIGINT")
    assert recommend._pair_count(matrix) == 3
    assert recommend._pair_tasks(matrix, 3) == spark.sparkContext.defaultParallelism == 8
    assert recommend._pair_tasks(matrix, 50_000_000) == 50


def test_block_size_does_not_change_pairs(spark, monkeypatch):
    matrix = spark.range(300).select((F.col("id") % 2).alias("customer_id"), (F.col("id") % 90).alias("product_id"), (F.col("id") % 7 + 1).alias("qty"))
    matrix = recommend.user_item(matrix.withColumnRenamed("qty", "quantity"))
    found = []
    for block in (256, 7, 1):
        monkeypatch.setattr(recommend, "BLOCK", block)
        found.append(sorted(map(tuple, recommend.item_pairs(matrix).collect())))
    assert found[0] == found[1] == found[2] and found[0]


@pytest.mark.parametrize("cells", [[], [("a", "x", 1)], [("a", "x", 1), ("a", "y", 2)], [("a", "x", 1), ("b", "x", 1)]])
def test_recommender_with_too_little_data_is_empty(spark, cells):
    matrix = spark.createDataFrame(cells, "customer_id STRING, product_id STRING, qty BIGINT")
    out = recommend.recommend(matrix)
    assert out.columns == ["customer_id", "recommended_product_id", "score"] and out.count() == 0


def test_nineteen_neighbours_are_taken_before_owned_ones_are_dropped(spark):
    # customer a owns 25 products bought alike, customer b owns one of them and a rarer one
    cells = [("a", f"p{i:02d}", 1) for i in range(25)] + [("b", "p00", 1), ("b", "q", 1)]
    matrix = spark.createDataFrame(cells, "customer_id STRING, product_id STRING, qty BIGINT")
    near = recommend.nearest_items(recommend.item_similarity(matrix))
    assert near.groupBy("product_id").count().agg(F.max("count")).first()[0] == 19
    assert near.filter("product_id = neighbour_id").count() == 0
    # q is like p00 only, and p00 has 24 closer neighbours: q never reaches a through p00
    assert recommend.recommend(matrix).filter("customer_id = 'a'").count() == 0


class Shuffled(TestModel):
    """The same tables with their rows in random order over many partitions."""

    __test__ = False

    def table(self, name):
        return super().table(name).orderBy(F.rand(7)).repartition(13)


@pytest.mark.parametrize(
    "name", ["dedupe_keep_first", "monthly_trend_delivered", "top_products_sql", "rfm_crm_export", "recommendations", "forecast_by_region", "insights", "kpis"]
)
def test_results_do_not_depend_on_row_order(spark, name):
    plain = catalog.plain_types(catalog.JOBS[name](TestModel(spark, FOLDER))).collect()
    mixed = catalog.plain_types(catalog.JOBS[name](Shuffled(spark, FOLDER))).collect()
    assert sorted(map(str, plain)) == sorted(map(str, mixed))


def test_shares_add_up(spark):
    df = spark.range(1, 500).withColumn("v", F.col("id") * 3)
    for few_rows in (True, False):
        total = timeseries.with_share(df, "v", few_rows=few_rows).agg(F.sum("share_pct")).first()[0]
        assert total == pytest.approx(100)
