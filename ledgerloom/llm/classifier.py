"""A quality classifier with hierarchical empirical Bayes over hosts and paths.

Each document's text gives evidence: a logistic regression over hashed words, word shapes and
proportions, fitted to a bounded sample of labelled documents. Means of that evidence are then shrunk, paths towards
their host and hosts towards the whole, by strengths estimated from how much hosts (and paths within
hosts) differ. A document's odds are its own times its path's, relative to the whole's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.batches import pieces, utf8
from ledgerloom.llm.language import FOLD
from ledgerloom.llm.shingles import BLANK, mixed, word_hashes, word_starts
from ledgerloom.llm.store import kept

#: Features are hashed into 2 ** FEATURES numbers.
FEATURES = 18
ASPECTS = ("quality", "toxic")
#: Kinds of bytes that a word's shape is made of: capital, small letter, digit, exclamation mark, common mark, beyond ASCII, other.
SHAPE = np.array([1 if 65 <= b <= 90 else 2 if 97 <= b <= 122 else 4 if 48 <= b <= 57 else 8 if b == 33 else 16 if chr(b) in ",.;:'\"?-()" else 32 if b >= 128 else 64 for b in range(256)], np.uint8)
#: Parts in which documents meet the table of paths.
PARTS = 16


def features(raw: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct feature numbers): its words in lower case, its word shapes, and its proportions."""
    top = np.uint64(64 - FEATURES)
    for lo, hi in pieces(ends):
        words, at = word_hashes(raw, ends, lo, hi, FOLD)
        words = (words >> top).astype(np.int64)
        text = raw[ends[lo] : ends[hi]]
        starts = ends[lo : hi + 1] - ends[lo]
        begin, solid = word_starts(text, starts, BLANK)
        kinds = np.where(solid, SHAPE[text], 0).astype(np.uint8)
        shapes = np.bitwise_or.reduceat(kinds, begin) if len(begin) else np.zeros(0, np.uint8)
        shape_at = np.searchsorted(begin, starts)
        for i in range(hi - lo):
            own, form = words[at[i] : at[i + 1]], shapes[shape_at[i] : shape_at[i + 1]]
            n, size = len(form), int(starts[i + 1] - starts[i])
            if not n:
                yield lo + i, np.zeros(0, np.int64)
                continue
            share = np.bincount(form, minlength=128)
            unique = np.unique(own)
            facts = [(1, n.bit_length()), (2, 20 * len(unique) // max(1, len(own))), (3, min(20, size // n))]
            facts += [(10 + k, int(20 * c / n)) for k, c in enumerate(share) if c]
            coded = mixed(np.array([a * 1000 + b + 1 for a, b in facts], np.uint64)) >> top
            yield lo + i, np.unique(np.concatenate([unique, coded.astype(np.int64)]))


def _learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, ends = utf8(batch.column("text"))
        own = [f.astype(np.int32) for _, f in features(raw, ends)]
        yield pa.RecordBatch.from_arrays([*(batch.column(a) for a in ASPECTS), pa.array(own, pa.list_(pa.int32()))], [*ASPECTS, "f"])


def telling(label: np.ndarray, f: np.ndarray, at: np.ndarray, surely: float) -> np.ndarray:
    """Whether each feature's log-odds ratio between the labels is ``surely`` deviations from 0."""
    own = np.repeat(label, np.diff(at)) > 0
    yes, no = (np.bincount(f[own == side], minlength=1 << FEATURES) + 0.5 for side in (True, False))
    n, m = (label > 0).sum() + 1, (label <= 0).sum() + 1
    ratio = np.log(yes / (n - yes + 0.5)) - np.log(no / (m - no + 0.5))
    return np.abs(ratio) > surely * np.sqrt(1 / yes + 1 / no)


def fit(label: np.ndarray, f: np.ndarray, at: np.ndarray, surely: float = 3.0, rounds: int = 20, rate: float = 0.3, pull: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic regression; row i has the features ``f[at[i]:at[i + 1]]``.

    Features that do not tell the labels apart by themselves weigh 0. Adaptive gradient steps over
    blocks of 256 rows in the given order, so a rerun gives the same.
    """
    w, g = np.zeros(1 << FEATURES), np.full(1 << FEATURES, 1e-2)
    b, gb = 0.0, 1e-2
    use = telling(label, f, at, surely)[f]
    row = np.repeat(np.arange(len(label)), np.diff(at))[use]
    f = f[use]
    at = np.searchsorted(row, np.arange(len(label) + 1))
    for _ in range(rounds):
        for lo in range(0, len(label), 256):
            hi = min(lo + 256, len(label))
            own, of = f[at[lo] : at[hi]], row[at[lo] : at[hi]] - lo
            z = np.bincount(of, w[own], hi - lo) + b
            miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[lo:hi]
            used, back = np.unique(own, return_inverse=True)
            step = np.bincount(back, miss[of], len(used)) / 16 + pull * w[used]
            g[used] += step**2
            w[used] -= rate * step / np.sqrt(g[used])
            step = miss.sum() / 16
            gb += step**2
            b -= rate * step / gb**0.5
    return w.astype(np.float32), float(b)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            raw, ends = utf8(batch.column("text"))
            out = np.zeros((batch.num_rows, len(ASPECTS)))
            for row, own in features(raw, ends):
                for k, (w, b) in enumerate(models):
                    z = float(w[own].sum(dtype=np.float64)) + b
                    out[row, k] = 1 / (1 + np.exp(-min(max(z, -12.0), 12.0)))
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), *(pa.array(out[:, k]) for k in range(2))], [*names, *(f"e_{a}" for a in ASPECTS)]
            )

    return run


def evidence(docs: DataFrame, labels: DataFrame, most_labels: int = 20_000) -> DataFrame:
    """The columns of ``docs`` but text, with e_quality and e_toxic: probabilities from the text alone.

    ``docs`` has doc_id and text. Learns from at most ``most_labels`` labelled ids, the smallest by
    hash; they and their feature numbers pass through the driver, where the regression is fitted.
    Of a repeated id it learns from one text, the smallest by hash, so that no more rows than ids get there.
    Without any labels all evidence is 0.5. An id labelled more than once counts with its worst
    labels; rows without a label in either aspect are left out.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic"))
    known = kept(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_labels))
    learn = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(known), "doc_id")
    learn = learn.groupBy("doc_id", *ASPECTS).agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text"))["text"].alias("text"))
    table = learn.select("text", *ASPECTS).mapInArrow(_learnt, "quality int, toxic int, f array<int>").orderBy(F.xxhash64("f"), "f", *ASPECTS).toArrow()
    lists = table.column("f").combine_chunks()
    f, at = lists.values.to_numpy().astype(np.int64), lists.offsets.to_numpy().astype(np.int64)
    models = [fit(table.column(a).to_numpy().astype(float), f, at) for a in ASPECTS]
    shared = docs.sparkSession.sparkContext.broadcast(models)
    schema = ", ".join(f"`{x.name}` {x.dataType.simpleString()}" for x in docs.schema.fields if x.name != "text")
    return docs.mapInArrow(_score(shared), schema + ", " + ", ".join(f"e_{a} double" for a in ASPECTS))


def logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p) - F.log(1 - p)


def strength(groups: DataFrame, n: str, mean: str, around: Column) -> float:
    """How many documents the mean of what is above counts for, from how far group means lie from it.

    Moments: the groups' spread beyond what their sizes explain, as that of a beta distribution.
    """
    own = F.col(n) * (F.col(mean) - around) ** 2
    row = groups.agg(
        F.sum(own).alias("far"), F.count("*").alias("k"), F.sum(n).alias("n"), F.sum(F.col(n) * around * (1 - around)).alias("v"),
    ).first()
    if not row["n"] or not row["v"]:
        return 1.0
    chance = row["v"] / row["n"]
    between = max((row["far"] - row["k"] * chance * 0.05) / row["n"], chance * 1e-4)
    return float(min(max(chance / between - 1, 1.0), 10_000.0))


def shrunk(told: DataFrame) -> DataFrame:
    """``told`` (host, path, e_quality, e_toxic and more) with p_quality and p_toxic.

    Sums over paths, hosts and all are partial sums first. A document's own evidence is taken out of
    its path's before the two meet. Null hosts and paths are groups of their own.
    """
    told = kept(told)
    keys = {k: F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for k in ("host", "path")}
    told = told.withColumns({f"_{k}": v for k, v in keys.items()})
    paths = kept(told.groupBy("_host", "_path").agg(F.count("*").alias("n"), *[F.sum(f"e_{a}").alias(f"s_{a}") for a in ASPECTS]))
    hosts = kept(paths.groupBy("_host").agg(F.sum("n").alias("h_n"), *[F.sum(f"s_{a}").alias(f"h_{a}") for a in ASPECTS]))
    total = hosts.agg(F.sum("h_n").alias("n"), *[F.sum(f"h_{a}").alias(a) for a in ASPECTS]).first()
    mean = {a: min(max((total[a] or 0.0) / (total["n"] or 1), 1e-4), 1 - 1e-4) for a in ASPECTS}
    for a in ASPECTS:
        k = strength(hosts.withColumn("m", F.col(f"h_{a}") / F.col("h_n")), "h_n", "m", F.lit(mean[a]))
        hosts = hosts.withColumn(f"m_{a}", (F.col(f"h_{a}") + k * mean[a]) / (F.col("h_n") + k))
    paths = kept(paths.join(hosts.select("_host", *[f"m_{a}" for a in ASPECTS]), "_host"))
    power = {a: strength(paths.withColumn("m", F.col(f"s_{a}") / F.col("n")), "n", "m", F.col(f"m_{a}")) for a in ASPECTS}
    parted = paths.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    met = told.withColumn("_part", F.pmod(F.xxhash64("doc_id", *[f"e_{a}" for a in ASPECTS]), F.lit(PARTS)).cast("int"))
    met = met.join(parted, ["_host", "_path", "_part"])
    out = [c for c in told.columns if c not in ("_host", "_path")]
    for a in ASPECTS:
        rest = (F.col(f"s_{a}") - F.col(f"e_{a}") + power[a] * F.col(f"m_{a}")) / (F.col("n") - 1 + power[a])
        odds = logit(F.col(f"e_{a}")) + logit(rest) - float(np.log(mean[a] / (1 - mean[a])))
        met = met.withColumn(f"p_{a}", 1 / (1 + F.exp(-odds)))
    return met.select(*out, *[f"p_{a}" for a in ASPECTS])


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", least_quality: float = 0.5,
             most_toxic: float = 0.5, **how) -> DataFrame:
    """(doc_id, host, path, e_quality, e_toxic, p_quality, p_toxic, kept) of every row of ``docs``.

    kept: p_quality is at least ``least_quality`` and p_toxic below ``most_toxic``. Null and blank
    texts have no features, so their evidence is the regression's offset alone. Null ids,
    repeated ids and repeated rows are fine; other columns are ignored. No documents, no rows.
    """
    rows = docs.select("doc_id", F.col(host).alias("host"), F.col(path).alias("path"), "text")
    out = shrunk(evidence(rows, labels, **how))
    good = (F.col("p_quality") >= least_quality) & (F.col("p_toxic") < most_toxic)
    return out.withColumn("kept", good)
