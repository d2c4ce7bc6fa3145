"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The documents of a source, in a random but fixed order, are one stream of words, cut into blocks of
equal size. A source's target is an exact quota of blocks, whole passes over the stream first and
then part of one more. The quotas of all sources are split between the two halves of the output
shards by a multivariate-hypergeometric draw, again and again, down to single shards. Each shard
takes its own stretch of every source's permuted blocks, so shards are disjoint, and shuffles locally.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.native import words
from ledgerloom.llm.store import kept

PIECES = "array<struct<shard:long,place:long,copy:int,start:long,words:long>>"
#: About so many rows are summed or ordered by one task at each level of the running word counts.
FAN = 4096


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight; none above ``most`` times its size, the excess shared again."""
    out = [0.0] * len(sizes)
    free = set(range(len(sizes)))
    rest = float(total)
    while free:
        weight = sum(weights[i] for i in sorted(free))
        share = {i: rest * weights[i] / weight for i in free}
        full = [i for i in sorted(free) if share[i] > most * sizes[i]]
        if not full:
            for i in free:
                out[i] = share[i]
            break
        for i in full:
            out[i] = float(most * sizes[i])
            rest -= out[i]
            free.discard(i)
        rest = max(rest, 0.0)
    return out


@dataclass(frozen=True)
class Source:
    """One source: its words, target, words to a block, blocks in its stream, and quota of blocks."""

    name: str | None
    docs: int
    size: int
    target: float
    block: int
    blocks: int
    quota: int


@dataclass(frozen=True)
class Mix:
    """The whole plan: sources in code-point order, null last; quotas are split over ``shards``."""

    sources: tuple[Source, ...]
    shards: int
    seed: int


def plan_mix(totals: list[tuple[str | None, int, int]], weights: tuple[float, ...], share: float, most: float,
             block_words: int, least_blocks: int, shard_blocks: int, seed: int) -> Mix:
    """The plan for sources given as (name, documents, words)."""
    rows = sorted(totals, key=lambda r: (r[0] is None, (r[0] or "").encode("utf-8", "surrogatepass")))
    sizes = [r[2] for r in rows]
    want = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], share * sum(sizes), most)
    sources = []
    for (name, docs, size), target in zip(rows, want):
        block = max(1, min(block_words, size // least_blocks))
        sources.append(Source(name, docs, size, target, block, -(-size // block), round(target / block)))
    shards = max(1, -(-sum(s.quota for s in sources) // shard_blocks))
    return Mix(tuple(sources), shards, seed)


def _draw(rng: np.random.Generator, good: int, bad: int, take: int) -> int:
    """How many of ``take`` drawn from good + bad are good."""
    if not good or not take:
        return 0
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, take))
    n = good + bad  # too many for the exact sampler: the normal limit, inside the possible range
    mean, var = take * good / n, take * good / n * bad / n * (n - take) / max(1, n - 1)
    return int(min(max(round(rng.normal(mean, var**0.5)), take - bad, 0), good, take))


def left_quota(mix: Mix, lo: int, hi: int, quota: tuple[int, ...]) -> tuple[int, ...]:
    """What the first half of the shards [lo, hi) gets of a node's quotas."""
    rng = np.random.Generator(np.random.Philox(key=[(mix.seed << 32) ^ lo, hi]))
    mid, left = (lo + hi) // 2, sum(quota)
    take, out = left * (mid - lo) // (hi - lo), []
    for q in quota:
        left -= q
        got = _draw(rng, q, left, take)
        out.append(got)
        take -= got
    return tuple(out)


def place_slots(mix: Mix, source: np.ndarray, slot: np.ndarray, seen: dict) -> tuple[np.ndarray, np.ndarray]:
    """(shard, place in it) of slots of sources, walking down the tree; slots are below the quotas.

    ``seen`` keeps the draws of nodes already visited, up to a number of entries.
    """
    shard, place = np.zeros(len(slot), np.int64), np.zeros(len(slot), np.int64)
    todo = [(0, mix.shards, tuple(s.quota for s in mix.sources), np.arange(len(slot)), slot.astype(np.int64))]
    while todo:
        lo, hi, quota, rows, at = todo.pop()
        if not len(rows):
            continue
        if hi - lo == 1:
            before = np.concatenate([[0], np.cumsum(quota)])
            shard[rows], place[rows] = lo, before[source[rows]] + at
            continue
        left = seen.get((lo, hi))
        if left is None:
            left = left_quota(mix, lo, hi, quota)
            if len(seen) < 100_000:
                seen[lo, hi] = left
        mine = np.array(left)[source[rows]]
        low = at < mine
        mid = (lo + hi) // 2
        todo.append((lo, mid, left, rows[low], at[low]))
        todo.append((mid, hi, tuple(q - x for q, x in zip(quota, left)), rows[~low], (at - mine)[~low]))
    return shard, place


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A permutation of 0..n-1 for each key: a four-round Feistel network, walked until below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = x.astype(np.uint64), np.arange(len(x))
    while len(todo):
        a, b, h, m, k = out[todo] >> half[todo], out[todo] & mask[todo], half[todo], mask[todo], key[todo]
        for r in range(4):
            a, b = b, a ^ (_mixed(b + k * np.uint64(2 * r + 3) + np.uint64(r)) & m)
        out[todo] = (a << h) | b
        todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def cut_pieces(mix: Mix, source: np.ndarray, start: np.ndarray, size: np.ndarray, seen: dict) -> tuple[np.ndarray, ...]:
    """(document, shard, place, copy, first word, words) of all that the mix takes of the documents.

    ``start`` is a document's place in the stream of its source.
    """
    block, blocks, quota = (np.array([getattr(s, f) for s in mix.sources], np.int64) for f in ("block", "blocks", "quota"))
    some = np.flatnonzero(size > 0)
    first, last = start[some] // block[source[some]], (start[some] + size[some] - 1) // block[source[some]]
    n = last - first + 1
    doc = np.repeat(some, n)
    b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    out = []
    of, begin = source[doc], start[doc]
    lo = np.maximum(b * block[of], begin)
    hi = np.minimum((b + 1) * block[of], begin + size[doc])
    copy = 0
    while len(doc):
        reach = copy * blocks[of] < quota[of]
        doc, b, of, begin, lo, hi = (x[reach] for x in (doc, b, of, begin, lo, hi))
        if not len(doc):
            break
        key = _mixed(np.uint64(mix.seed) + of.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(copy) * np.uint64(7919) + np.uint64(1))
        slot = copy * blocks[of] + permute(b, blocks[of], key)
        taken = slot < quota[of]
        shard, place = place_slots(mix, of[taken], slot[taken], seen)
        out.append((doc[taken], shard, place, np.full(taken.sum(), copy), (lo - begin)[taken], (hi - lo)[taken]))
        copy += 1
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    joined = [np.concatenate(c) for c in zip(*out)]
    by = np.lexsort((joined[4], joined[3], joined[0]))
    return tuple(c[by] for c in joined)


def _cut(mix: Mix):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            n = batch.num_rows
            source, start, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_s", "_start", "size"))
            doc, *fields = cut_pieces(mix, source.astype(np.int64), start.astype(np.int64), size.astype(np.int64), seen)
            offsets = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
            values = pa.StructArray.from_arrays(
                [pa.array(f, k) for f, k in zip(fields, kinds)], names=["shard", "place", "copy", "start", "words"]
            )
            names = [c for c in batch.schema.names if c != "_start"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.ListArray.from_arrays(pa.array(offsets), values)], [*names, "pieces"]
            )

    return run


def _fraction(h: Column) -> Column:
    """A hash as a number from 0 up to but not 1."""
    return F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.0, most: float = 3.0,
                  block_words: int = 1024, least_blocks: int = 1000, shard_blocks: int = 4096, seed: int = 17,
                  max_sources: int = 100_000) -> DataFrame:
    """One row per document: doc_id, source, hash, size, source_size, target, pieces, taken.

    Sources in code-point order, null last, weigh ``weights`` in turn and share ``share`` of all
    words; none takes more than ``most`` times its words. ``pieces`` lists what the mix takes of the
    document: shard, place of the block in the shard, copy, first word and number of words. A block
    may hold several documents and a document several blocks, so targets are met to a block. Small
    sources have smaller blocks: at least ``least_blocks`` of them where there are as many words.

    Null and empty texts have size 0 and no pieces. Null and repeated ids are fine; equal rows are
    told apart only by what they take, so the rows of a rerun are the same. An empty table gives no
    rows. The plan has one row per source and is checked against ``max_sources`` before it is sent
    to the tasks; everything per document, bucket or block stays in Spark.
    """
    spark = docs.sparkSession
    text_hash = F.xxhash64(F.lit(seed), "doc_id", "text")
    sized = docs.select("doc_id", "source", text_hash.alias("hash"), F.size(words(F.col("text"))).cast("long").alias("size"))
    sized = kept(sized)
    totals = sized.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("size"))
    rows = totals.limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    mix = plan_mix([(r["source"], r["docs"], r["size"]) for r in rows], weights, share, most, block_words, least_blocks, shard_blocks, seed)
    known = [(i, s.name, s.size, s.target, max(1, -(-s.docs // FAN))) for i, s in enumerate(mix.sources)]
    table = spark.createDataFrame(known, "_s int, _name string, source_size long, target double, _buckets long")
    placed = sized.join(F.broadcast(table), F.col("source").eqNullSafe(F.col("_name"))).drop("_name")
    placed = placed.withColumn("_bucket", F.floor(_fraction(F.col("hash")) * F.col("_buckets")).cast("long"))

    # Words before each group of buckets, each bucket in its group, and each document in its bucket.
    buckets = placed.groupBy("_s", "_bucket").agg(F.sum("size").alias("n"))
    buckets = buckets.withColumn("_group", F.floor(F.col("_bucket") / FAN).cast("long"))
    groups = buckets.groupBy("_s", "_group").agg(F.sum("n").alias("n"))
    groups = groups.select("_s", "_group", F.coalesce(F.sum("n").over(_rows("_s", order=["_group"])), F.lit(0)).alias("_g"))
    buckets = buckets.select("_s", "_group", "_bucket", F.coalesce(F.sum("n").over(_rows("_s", "_group", order=["_bucket"])), F.lit(0)).alias("_b"))
    starts = buckets.join(groups, ["_s", "_group"]).select("_s", "_bucket", (F.col("_g") + F.col("_b")).alias("_from"))
    own = F.coalesce(F.sum("size").over(_rows("_s", "_bucket", order=["hash", "doc_id"])), F.lit(0))
    placed = placed.withColumn("_own", own).join(starts, ["_s", "_bucket"])
    placed = placed.select("doc_id", "source", "hash", "size", "source_size", "target", "_s", (F.col("_own") + F.col("_from")).alias("_start"))
    cut = placed.mapInArrow(_cut(mix), "doc_id {}, source string, hash long, size long, source_size long, target double, _s int, pieces {}".format(
        docs.schema["doc_id"].dataType.simpleString(), PIECES))
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    return cut.drop("_s").withColumn("taken", taken)


def _rows(*by: str, order: list[str]):
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def mixed_texts(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: shard, place, doc_id, source, copy, first_word, n_words, text, shuffled in each shard.

    ``text`` is the whole text where all of it is taken at once, otherwise its words from
    ``first_word`` on, parted by blanks.
    """
    plan = mix_documents(docs, **how)
    seed = how.get("seed", 17)
    twin = Window.partitionBy("doc_id", "hash").orderBy("doc_id")
    texts = docs.select("doc_id", F.xxhash64(F.lit(seed), "doc_id", "text").alias("hash"), "text").withColumn("_twin", F.row_number().over(twin))
    texts = texts.select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash"), "_twin", "text")
    plan = plan.where(F.size("pieces") > 0).withColumn("_no", F.row_number().over(twin))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")) & (F.col("_no") == F.col("_twin"))
    rows = plan.join(texts, same).select("doc_id", "source", "size", "text", F.explode("pieces").alias("p"))
    part = F.array_join(F.slice(words(F.col("text")), (F.col("p.start") + 1).cast("int"), F.col("p.words").cast("int")), " ")
    rows = rows.select(
        F.col("p.shard").alias("shard"), F.col("p.place").alias("place"), "doc_id", "source", F.col("p.copy").alias("copy"),
        F.col("p.start").alias("first_word"), F.col("p.words").alias("n_words"),
        F.when(F.col("p.words") == F.col("size"), F.col("text")).otherwise(part).alias("text"),
    )
    local = F.xxhash64(F.lit(seed), "shard", "place")
    return rows.repartition("shard").sortWithinPartitions("shard", local, "first_word", "doc_id")
