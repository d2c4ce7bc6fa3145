import pytest
from pyspark.sql import functions as F

from brute import SF
from ledgerloom.llm import classifier


def test_held_out_accuracy(spark):
    folder = SF.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    told = classifier.classify(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id")
    good = lambda aspect: F.avg(((F.col(f"p_{aspect}") > 0.5) == (F.col(aspect) == 1)).cast("int"))
    clean = F.avg(F.when((F.col("quality") == 1) & (F.col("toxic") == 0), F.col("kept").cast("int")))
    row = told.agg(good("quality").alias("q"), good("toxic").alias("t"), clean.alias("clean"), F.count("*").alias("n")).first()
    assert row["n"] > 1500 and row["q"] > 0.97 and row["t"] > 0.95 and row["clean"] > 0.98


def told(spark, groups):
    rows = [(i * 1000 + k, h, p, e, e) for i, (h, p, e, n) in enumerate(groups) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, host string, path string, e_quality double, e_toxic double")


def test_sparse_sites_shrink_and_large_ones_do_not(spark):
    groups = [("big", "a", 0.9, 400), ("bad", "a", 0.1, 400), ("mid", "a", 0.5, 400), ("one", "a", 0.1, 1), ("mid", "b", 0.1, 60), (None, None, 0.5, 3)]
    out = classifier.shrunk(told(spark, groups)).groupBy("host", "path").agg(F.first("p_quality").alias("p"), F.count("*").alias("n")).collect()
    p = {(r["host"], r["path"]): r["p"] for r in out}
    assert {(r["host"], r["path"]): r["n"] for r in out} == {(h, q): n for h, q, _, n in groups}
    assert p["big", "a"] > 0.97 and p["bad", "a"] < 0.03  # the site adds to the document
    assert abs(p["one", "a"] - 0.1) < 0.06  # a single document says nothing about its site
    assert p["bad", "a"] < p["mid", "b"] < p["one", "a"] + 0.05  # a bad path of a middling host


def test_edge_rows(spark):
    docs = [(1, None, None, None), (2, "", "a", "x"), (None, "good text here", "a", None), (3, "w " * 50_000, None, "x"), (3, "w " * 50_000, None, "x")]
    df = spark.createDataFrame([(*d, 7) for d in docs], "doc_id long, text string, source string, lang string, p_quality int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(2, 1, 0), (3, 0, 1), (3, 1, 0), (None, 1, 1), (1, None, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        out = classifier.classify(df, labels).collect()
        assert len(out) == len(docs) and all(0 <= r["p_quality"] <= 1 and 0 <= r["p_toxic"] <= 1 for r in out)
    assert all(r["e_quality"] == 0.5 for r in classifier.classify(df, none).collect())
    assert classifier.classify(df.limit(0), some).count() == 0


@pytest.mark.parametrize("text, bit", [("AB!! CD!!", 1 | 8), ("a|b", 2 | 64), ("é1", 32 | 4)])
def test_shapes(text, bit):
    kinds = classifier.SHAPE[list(text.split()[0].encode())]
    total = 0
    for k in kinds:
        total |= int(k)
    assert total == bit


def test_a_repeated_id_is_learnt_from_once(spark, monkeypatch):
    learnt, fit = [], classifier.fit
    monkeypatch.setattr(classifier, "fit", lambda label, *how: learnt.append(len(label)) or fit(label, *how))
    docs = spark.createDataFrame([(1, f"a text no {i} of the same id") for i in range(50)] + [(2, "another text")] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    assert classifier.evidence(docs, labels).count() == 53 and learnt == [2, 2]
