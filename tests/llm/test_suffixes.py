import random

import numpy as np
import pytest

import brute
from brute import SF
from ledgerloom.llm import queries, suffixes


def cut(spark, rows, size=200):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffixes.cut_repeats(df, size)
    return sorted((tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_small_table(spark, sf_rows):
    got = [tuple(r) for r in queries.op7_suffix_dedup(spark, SF).collect()]
    assert sorted(got) == sorted(brute.repeats(sf_rows("documents", "doc_id", "text")))


@pytest.mark.parametrize("hot", [2, 4096])
def test_overlaps_copies_and_common_passages(spark, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "BLOCK", 20_000)
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdeéß€") for _ in range(rng.randrange(1, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(45) for _ in range(4)] + ["ab" * 150, "z" * 450, text(20)]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(0, 30)) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(passages))
        if rng.random() < 0.3:
            parts.append(rng.choice(passages))
        rows.append((i, " ".join(parts)))
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    rows += [(200 + i, rows[i][1][: len(rows[i][1]) // 2] + "#" + rows[i][1][len(rows[i][1]) // 2 :]) for i in range(10)]
    rows += [(300, "q" * 199), (301, "q" * 199), (302, "r" * 200), (303, "r" * 200), (304, "s" * 200), (305, "t" * 201)]
    want = brute.repeats(rows)
    assert sum(r[2] > 0 for r in want) > 40
    assert cut(spark, rows) == sorted(want, key=str)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "short"), (None, "n" * 300), (4, "y" * 150 + "n" * 250), (4, "y" * 150 + "n" * 250), (5, "ab" * 30_000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, runs int, digest string")
    out = suffixes.cut_repeats(df)
    got = sorted((tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)
    assert got == sorted(brute.repeats(rows), key=str)
    assert "digest" in out.columns and {r["digest"] for r in out.collect()} == {"x"}
    assert suffixes.cut_repeats(df.limit(0)).count() == 0


def test_difference_cover_and_block_sort():
    assert suffixes.shifts().max() < suffixes.COVER
    rng = np.random.default_rng(1)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    text[1000:1400] = text[100:500]
    text[2000:2300] = text[250:550]
    size = 200
    at = np.arange(len(text) - size + 1)
    seen = {}
    for i in at:
        seen.setdefault(text[i : i + size].tobytes(), []).append(i)
    want = np.array([len(seen[text[i : i + size].tobytes()]) > 1 for i in at])
    assert want.sum() > 500 and (suffixes.repeated(text, at, size) == want).all()
