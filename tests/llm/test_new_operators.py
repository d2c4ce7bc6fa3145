import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import BLANK, SF, sha
from ledgerloom.llm import minhash, periodic, queries, resample, shingles
from ledgerloom.llm.batches import utf8

FOLDED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHES = ["row", "own", "id", "label", "kept", "keys", "sid", "rank", "score", "digest", "copies", "first", "runs", "n_words", "collapsed", "a.b"]
ODD = [None, "", " \n\t ", "\n", "a", "x" * 5000, "é" * 300, "word " * 30_000, "ab cd ef " * 40, "A b C", "€  \x85 \xa0", "l\n" * 5000]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, repeated rows, null ids, and extra columns whose names the operators use inside."""
    rows = [(i, t) for i, t in enumerate(ODD)] + [(0, None), (7, ODD[7]), (7, ODD[7]), (None, "null id here"), (None, "null id here"), (5, "other text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit(c).alias(c) for c in CLASHES])


# --- near duplicates


def shingle_set(text, size=4):
    w = BLANK.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def linked_groups(rows):
    """(doc_id, shingles, smallest reachable id) by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted((doc, len(sets[i]), least[find(i)] if sets[i] else doc) for i, (doc, _) in enumerate(rows))


def edited(rng, words, share):
    return " ".join(rng.choice("abcdefgh") * 3 + str(rng.random()) if rng.random() < share else w for w in words)


def test_near_copies_on_the_small_table(spark, sf_rows):
    rows = sf_rows("documents", "doc_id", "text")
    got = [tuple(r) for r in queries.op11_minhash_dedup(spark, SF).collect()]
    assert sorted(r[:3] for r in got) == linked_groups(rows)
    assert all(kept == (doc == component) for doc, _, component, kept in got)


def test_near_copies_in_groups_of_all_similarities(spark, monkeypatch):
    """Groups whose members lie around the limit, large enough for the core; keys that are split; copies; chains."""
    monkeypatch.setattr(minhash, "STRAYS", 2)
    rng = random.Random(7)
    texts = []
    for size, n in ((90, 120), (60, 40), (12, 60), (300, 60)):
        base = [f"w{rng.randrange(5000)}" for _ in range(size)]
        texts += [edited(rng, base, rng.choice([0, 0.02, 0.04, 0.06, 0.1, 0.2])) for _ in range(n)]
        texts += [" ".join(base[: int(size * rng.uniform(0.6, 1))]) for _ in range(10)]
    shared = " ".join(f"s{i}" for i in range(40))  # a passage that unlike documents share
    texts += [shared + " " + " ".join(f"o{rng.randrange(10**6)}" for _ in range(rng.randint(5, 60))) for _ in range(60)]
    chain = [f"c{i}" for i in range(100)]
    for i in range(0, 60, 3):  # each links to the next only
        texts.append(" ".join(chain[i:] + [f"d{k}" for k in range(i)]))
    texts += [texts[0]] * 30 + ["one two", "ONE  two", "one two three", "", None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in minhash.link_documents(df).select("doc_id", "n_shingles", "component_id").collect())
    assert got == linked_groups(rows)
    left = {r["doc_id"] for r in minhash.drop_copies(df).collect()}
    assert left == {doc for doc, _, component in got if doc == component}


def test_near_copies_of_odd_rows(spark, odd):
    got = minhash.link_documents(odd).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert len(got) == odd.count()
    assert sum(r["doc_id"] is None and r["n_shingles"] == 1 and r["component_id"] is None and r["kept"] for r in got) == 2
    assert all(r["kept"] and r["n_shingles"] == 0 for r in got if r["doc_id"] in (1, 2, 3))
    out = minhash.drop_copies(odd)
    assert out.columns == odd.columns and out.where("doc_id = 7").count() == 3
    assert minhash.drop_copies(odd.limit(0)).collect() == [] == minhash.link_documents(odd.limit(0)).collect()


def test_minima_and_keys(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 50, dtype=np.uint64)
    low = minhash.minima(np.concatenate([x, x[:20]]), np.array([0, 50]))
    k = 17
    assert low[k, 0] == min(int(minhash.A[k]) * int(v) + int(minhash.B[k]) & (2**64 - 1) for v in x)
    assert low[k, 1] == min(int(minhash.A[k]) * int(v) + int(minhash.B[k]) & (2**64 - 1) for v in x[:20])
    keys = minhash.band_keys(low)
    same = (low[:, 0] == low[:, 1]).reshape(minhash.BANDS, minhash.ROWS).all(axis=1)
    assert keys.shape == (2, minhash.BANDS) and ((keys[0] == keys[1]) == same).all() and len(set(keys[0])) == minhash.BANDS


# --- periodic runs


def plain_runs(w, least=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def runs_of_texts(texts, least=12):
    raw = [" ".join(t).encode() for t in texts]
    ends = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return [(n, [tuple(map(int, r)) for r in runs]) for _, n, runs in periodic.text_runs(np.frombuffer(b"".join(raw), np.uint8), ends, least)]


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 5)):
            n, kind = rng.randint(0, 110), rng.random()
            if kind < 0.4:
                w = [rng.choice("ab") for _ in range(n)]
            elif kind < 0.8:
                unit = [rng.choice("abc") for _ in range(rng.randint(1, 20))]
                w = [unit[i % len(unit)] for i in range(n)]
                for _ in range(rng.randint(0, 3) if n else 0):
                    w[rng.randrange(n)] = "x"
            else:
                a, b = "a", "ab"
                while len(b) < n:
                    a, b = b, b + a
                w = list(b[:n])
            texts.append(w)
        least = rng.choice([12, 12, 2, 4, 5, 20])
        assert runs_of_texts(texts, least) == [(len(w), plain_runs(w, least)) for w in texts]


@pytest.mark.parametrize("unit", [1, 2, 1000])
def test_runs_of_a_long_text(unit):
    (told,) = runs_of_texts([[f"w{i % unit}" for i in range(300_000)]])
    assert told == (300_000, [(0, 300_000, unit)])


def test_run_query_on_the_small_table(spark, sf_rows):
    want = []
    for doc, text in sf_rows("documents", "doc_id", "text"):
        w = BLANK.findall(text or "")
        n, h = len(w), zlib.crc32(str(doc).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = runs_of_texts([w])[0][1] if n > 1500 else plain_runs(w)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        want.append((doc, len(runs), *told, sha(listed), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    got = queries.op12_periodic_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want)) and any(r[1] for r in want)


def test_runs_of_odd_rows(spark, odd):
    got = periodic.mark_runs(odd)
    assert [c for c in odd.columns if c not in periodic.ADDED] == [c for c in got.columns if c not in periodic.ADDED]
    rows = got.collect()
    assert len(rows) == odd.count() and all(r["n_words"] == 0 and r["runs"] == [] and r["collapsed"] == "" for r in rows if r["doc_id"] in (1, 2, 3))
    assert all([tuple(x) for x in r["runs"]] == [(0, 30_000, 1)] and r["collapsed"] == "word" for r in rows if r["doc_id"] == 7)
    assert periodic.mark_runs(odd.limit(0)).collect() == []
    looped = odd.select("doc_id", periodic.looped(F.col("doc_id"), F.col("text")).alias("text"))
    assert looped.count() == len(periodic.runs_digest(periodic.mark_runs(looped)).collect())


# --- importance resampling


def plain_features(text, size):
    w = FOLDED.findall((text or "").translate(LOWER))
    return [" ".join(w[i : i + n]) for n in range(1, size + 1) for i in range(len(w) - n + 1)]


def plain_scores(docs, target, size=1, buckets=10_000, seed="2024"):
    def hashed(text):
        return [zlib.crc32(g.encode()) % buckets for g in plain_features(text, size)]

    own, aim = Counter(b for _, t in docs for b in hashed(t)), Counter(b for t in target for b in hashed(t))
    all_own, all_aim = sum(own.values()), sum(aim.values())
    out = []
    for doc, text in docs:
        f = hashed(text)
        gain = [math.floor(1000 * math.log((aim[b] + 1) * (all_own + buckets) / ((own[b] + 1) * (all_aim + buckets)))) for b in f]
        weight = sum(gain) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    return out


@pytest.mark.parametrize("size, buckets", [(1, 10_000), (2, 500), (3, 10_000)])
def test_scores_equal_brute_force(spark, sf_rows, size, buckets):
    """Cross-line n-grams, hot lines and lines of fewer words than an n-gram included."""
    docs = sf_rows("documents", "doc_id", "text")[:80]
    docs += [(10_000 + i, f"same line here\none\n\ntwo {i}\nsame line here") for i in range(40)] + [(20_000, "A-b\r\nÉa b\n3"), (20_001, "\n\n")]
    target = [t for (t,) in sf_rows("benchmark", "text")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = resample.score(df, spark.createDataFrame([(t,) for t in target], "text string"), size, buckets)
    got = [tuple(r) for r in got.select("doc_id", "n_features", "weight", "score").collect()]
    assert sorted(got) == sorted(plain_scores(docs, target, size, buckets))


def test_draw_takes_the_best(spark, monkeypatch):
    monkeypatch.setattr(resample, "SPREAD", 7)
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(10, 60)))) for i in range(300)]
    docs += [(500, docs[0][1] + " a a a a a a a a a a a a a a a a a a a a")] * 90  # copies over the end of the draw or not
    target = ["a b c a a b"]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("a.b", F.lit(2))
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (3, 10, 40, 100):
        scored = resample.score(df, aim)
        told = resample.rank(scored, 20, percent).collect()
        want = [r for r in plain_scores(docs, target) if r[1] >= 20]
        want = sorted(want, key=lambda r: (-r[3], r[0]))[: len(want) * percent // 100]
        drawn = sorted((r for r in told if r["rank"]), key=lambda r: r["rank"])
        assert len(told) == len(docs) and [r["rank"] for r in drawn] == list(range(1, len(want) + 1))
        assert [(r["doc_id"], r["score"]) for r in drawn] == [(r[0], r[3]) for r in want]
        out = resample.draw(df, aim, 20, percent)
        assert out.columns == df.columns and sorted(r["doc_id"] for r in out.collect()) == sorted(r[0] for r in want)


def test_scores_of_odd_rows(spark, odd):
    aim = odd.select("text")
    got = resample.rank(resample.score(odd, aim)).collect()
    assert len(got) == odd.count() and all(r["weight"] == 0 == r["n_features"] for r in got if r["doc_id"] in (1, 2, 3))
    want = plain_scores([(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()], [r["text"] for r in aim.collect()])
    assert sorted(map(repr, ((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got))) == sorted(map(repr, want))
    assert resample.rank(resample.score(odd.limit(0), aim)).collect() == []
    assert len(resample.rank(resample.score(odd, aim.limit(0))).collect()) == odd.count()
    assert resample.draw(odd, aim, 1, 100).columns == odd.columns and resample.draw(odd.limit(0), aim).collect() == []


def test_crossing_counts_what_lines_do_not(spark):
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choice(["a", "b", " ", "\n", "\n", "-"]) for _ in range(rng.randint(0, 30))).encode()
        lines = [resample.words(x) for x in text.split(b"\n")]
        for size in (1, 2, 3, 5):
            split = Counter(g for w in lines for g in resample.grams(w, size)) + Counter(resample.crossing(lines, size))
            assert split == Counter(resample.grams(resample.words(text), size))
