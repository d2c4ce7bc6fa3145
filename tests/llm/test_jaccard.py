import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from brute import SF
from ledgerloom.llm import graph, jaccard, queries, store


def linked(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.link_documents(df).collect()}


def text(rng, n, words=4000):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def edited(rng, w, share):
    return [f"e{rng.randrange(10**6)}" if rng.random() < share else x for x in w]


def test_small_table(spark, sf_rows):
    rows = queries.op2_jaccard_join(spark, SF).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute.components(sf_rows("documents", "doc_id", "text"))


@pytest.mark.parametrize("long_list", [2, 32])
def test_families_passages_and_borderline_copies(spark, monkeypatch, long_list):
    """Chains of edits around the limit, common passages in most texts, texts made of passages only."""
    monkeypatch.setattr(jaccard, "LONG", long_list)
    rng = random.Random(8)
    passages = [text(rng, 40) for _ in range(6)]
    docs = []
    for _ in range(12):
        w = text(rng, rng.choice((30, 80, 200)))
        for _ in range(rng.choice((1, 3, 6))):
            docs.append(w)
            w = edited(rng, w, rng.choice((0.01, 0.03, 0.05)))
    docs = [d + rng.choice(passages) if rng.random() < 0.6 else d for d in docs]
    docs += [sum(rng.sample(passages, rng.choice((2, 3))), []) for _ in range(12)]
    docs += [passages[0][:k] for k in (20, 25, 30, 35, 40)]
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    rng.shuffle(rows)
    want = brute.components(rows)
    assert len({v[1] for v in want.values()}) < len(rows) - 10
    assert linked(spark, rows) == want


def test_small_sets_link_by_common_subsets(spark):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        w = [f"t{k % 7}" for k in range(rng.randrange(1, 16))]
        if rng.random() < 0.5:
            w[rng.randrange(len(w))] = f"x{rng.randrange(3)}"
        rows.append((i, " ".join(w)))
    assert linked(spark, rows) == brute.components(rows)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 200), st.integers(1, 200))
def test_bounds(n, m):
    least = next(k for k in range(0, 400) if 100 * k >= 75 * (n + m - k))
    assert jaccard.needed(n, m) == least
    if least <= min(n, m):  # a link is possible
        assert jaccard.prefix(n) >= n - least + 1
        if max(n, m) <= jaccard.TINY:
            assert least in jaccard.subset_sizes(n) and least in jaccard.subset_sizes(m)


def test_edge_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one\ttwo "), (6, "one"), (7, "a b c d e"), (9, "A b C d E"), (8, "a b c d e f"),
        (10, "x " * 40_000), (11, "X x"), (4, "One two"), (None, "a b c d e"), (None, "only null"), (2, "one two"),
    ]
    df = spark.createDataFrame([(*r, 0, "y") for r in rows], "doc_id long, text string, n_shingles int, sid string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.link_documents(df).collect()), key=str)
    want = [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 2), (5, 1, 2), (6, 1, 6), (7, 1, 7), (9, 1, 7), (8, 2, 8), (10, 1, 10), (11, 1, 11),
            (4, 1, 2), (None, 1, 7), (None, 1, None), (2, 1, 2)]
    assert got == sorted(want, key=str)
    kept = [(r["doc_id"], r["text"]) for r in jaccard.keep_first(df).collect()]
    assert sorted(kept, key=str) == sorted([rows[i] for i in (0, 1, 2, 14, 5, 6, 8, 9, 10, 13)], key=str)
    assert jaccard.keep_first(df).dtypes == df.dtypes
    assert jaccard.link_documents(df.limit(0)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(7, 7), (None, 3), (300, -4), (-4, 300)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["label"] for r in graph.components(df).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {5: 5} | {i: 5 for i in range(200, 260)} | {300: -4, -4: -4}


def test_components_take_two_shuffles_a_round(spark):
    pick = random.Random(8)
    links = [(pick.randrange(400), pick.randrange(400)) for _ in range(350)] * 2 + [(None, 3), (5, 5)] + [(900, 900 + k) for k in range(1, 60)]
    parent = {x: x for e in links if None not in e for x in e}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in links:
        if a is not None:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    df = spark.createDataFrame(links, "a long, b long")
    got = sorted(tuple(r) for r in graph.components(df).collect())
    assert got == sorted((x, root(x)) for x in {x for a, b in links if a is not None and a != b for x in (a, b)})
    plan = graph.round_of_stars(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_checkpoints_leave_no_shuffle_files(spark):
    def files():
        local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {x for x in local.getAllBlocks().mkString("\n").split("\n") if x.startswith("shuffle_")}

    before = files()
    df = store.kept(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert sorted(r["count"] for r in df.collect()) == [142] * 1 + [143] * 6


def test_near_copies_in_long_lists_are_not_all_paired(spark, monkeypatch):
    """Copies with a changed word each: most pairs are just below the limit, and no shingle of the text has a short list."""
    pick = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    docs = [(k, " ".join(base[:at] + [f"x{k}"] + base[at + 1 :])) for k, at in enumerate(pick.choices(range(60), k=160))]
    docs += [(1000 + k, " ".join([*base[:30], *(f"y{k}-{j}" for j in range(6))])) for k in range(80)]
    asked = []
    measure = jaccard.measure
    monkeypatch.setattr(jaccard, "measure", lambda d, s, pairs: asked.append(pairs.distinct().count()) or measure(d, s, pairs))
    assert linked(spark, docs) == brute.components(docs)
    assert sum(asked) < 10 * len(docs)
