"""Runs of periodic words by dyadic square catching.

When a block of 2^k words is complete, a catcher is set on it: it compares each stretch of 2^k words that
ends with an appended word to its block, at distances from 2^(k+1) - 1 to 2^(k+2) - 2. Every square whose period
lies in that range holds a whole block in its first half, so one of the catchers of that size sees
it. Catches of neighbouring blocks at one distance belong to the same square and merge; comparing ever
shorter suffixes and prefixes on both sides of them gives the run. The comparisons of all catchers of a size,
in all texts of a batch, are array operations on hashes of 2^k words, which come from those of 2^(k-1).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.batches import pieces, utf8
from ledgerloom.llm.native import let, words
from ledgerloom.llm.shingles import STEP, mixed, word_hashes

SAME = np.arange(256, dtype=np.uint8)
RUNS = "array<struct<start:long,length:long,period:long>>"
ADDED = ("n_words", "runs", "collapsed")


def caught(block: np.ndarray, size: int, nearest: int, furthest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first block, last block, distance) of maximal rows of blocks that recur at one distance.

    ``block`` has the hash of the ``size`` words from each place on.
    """
    count = max(0, -(-(len(block) - nearest) // size))
    padded = np.append(block, np.zeros(furthest + size, np.uint64))
    later = np.lib.stride_tricks.sliding_window_view(padded[nearest:], furthest - nearest + 1)[::size][:count]
    number, q = np.nonzero(later == block[: count * size : size][:count, None])
    order = np.lexsort((number, q))
    number, q = number[order], q[order] + nearest
    first = np.ones(len(q), bool)
    first[1:] = (q[1:] != q[:-1]) | (number[1:] != number[:-1] + 1)
    last = np.append(first[1:], True) if len(q) else first
    return number[first], number[last], q[first]


def runs_of(word: np.ndarray, lengths: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs in texts that follow one another, the longest text first.

    ``word`` has a hash for each word, differing between texts, ``lengths`` the words of each text. A run
    has ``least`` words and two periods at least. Memory: a number for each word and size of blocks.
    """
    ends = np.concatenate([[0], np.cumsum(lengths)])
    levels, found = [word], []
    while True:
        k = len(levels) - 1
        size = 1 << k
        small = k == 1 and least >= 5  # then the shortest periods, too, repeat a block of two words
        nearest, furthest = 1 if small else 2 * size - 1, 4 * size - 2
        n = int(ends[np.searchsorted(-lengths, -max(least, 2 * nearest), side="right")])
        if k and n < 2 * size:
            break
        if k:
            half = levels[-2]
            levels[-1] = mixed(half[: n - size + 1] * STEP + half[size // 2 : n - size // 2 + 1])
        if k or least < 5:
            a, b, q = caught(levels[-1], size, nearest, furthest)
            may = (b - a + 3) * size - 2 >= np.maximum(least - q, q)
            start, end, q = a[may] * size, (b[may] + 1) * size, q[may]
            for j in range(k - 1, -1, -1):
                step, h = 1 << j, levels[j]
                back = start - step
                start = np.where((back >= 0) & (h[np.maximum(back, 0)] == h[np.maximum(back, 0) + q]), back, start)
                there = end + q
                ahead = (there < len(h)) & (h[np.minimum(end, len(h) - 1)] == h[np.minimum(there, len(h) - 1)])
                end = np.where(ahead, end + step, end)
            end = end + q
            long = end - start >= np.maximum(least, 2 * q)
            found.append(np.stack([start[long], end[long], q[long]]))
        levels.append(None)
    start, end, q = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    # A multiple of a run's period gives the same stretch: the smallest period counts.
    order = np.lexsort((q, end, start))
    start, end, q = start[order], end[order], q[order]
    new = np.ones(len(q), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, q = start[new], end[new], q[new]
    order = np.lexsort((q, start))
    return start[order], end[order], q[order]


def text_runs(raw: np.ndarray, ends: np.ndarray, least: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, number of words, runs as rows of start, length, period) of every text."""
    for lo, hi in pieces(ends):
        h, at = word_hashes(raw, ends, lo, hi, SAME)
        counts = np.diff(at)
        order = np.argsort(-counts, kind="stable")
        lengths = counts[order]
        begin = np.concatenate([[0], np.cumsum(lengths)])
        take = np.arange(begin[-1]) + np.repeat(at[:-1][order] - begin[:-1], lengths)
        salt = np.repeat(np.arange(1, hi - lo + 1).astype(np.uint64) * STEP, lengths)
        start, end, q = runs_of(mixed(h[take] + salt), lengths, least)
        of = np.searchsorted(begin, start, side="right") - 1
        cut = np.searchsorted(of, np.arange(hi - lo + 1))
        place = np.empty(hi - lo, np.int64)
        place[order] = np.arange(hi - lo)
        for i in range(hi - lo):
            p = int(place[i])
            own = slice(cut[p], cut[p + 1])
            yield lo + i, int(counts[i]), np.stack([start[own] - begin[p], (end - start)[own], q[own]], axis=1)


def _mark(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = utf8(batch.column("text"))
            counts, sizes, flat, collapsed = [], [], [], []
            for row, n, runs in text_runs(raw, ends, least):
                w = raw[ends[row] : ends[row + 1]].tobytes().split()
                if len(runs):
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
                    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
                    w = [w[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]
                counts.append(n), sizes.append(len(runs)), flat.append(runs), collapsed.append(b" ".join(w))
            flat = np.concatenate(flat) if flat else np.zeros((0, 3), np.int64)
            fields = pa.StructArray.from_arrays([pa.array(c) for c in np.ascontiguousarray(flat.T)], ["start", "length", "period"])
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("own"), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(offsets, fields), pa.array(collapsed, pa.binary()).cast(pa.string())],
                ["own", "n_words", "runs", "collapsed"],
            )

    return run


def mark_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """``docs`` with n_words, runs (start, length, period; by start, then period) and collapsed.

    A run is a maximal stretch of words that repeats with its smallest period, at least twice, and
    has ``least`` words. ``collapsed`` has the words, joined by a blank, that no run holds after its first
    period. Words are runs of non-blank characters; equal words are told by 64-bit hashes. Null,
    empty and blank texts have no words; rows are judged one by one, so repeated rows and ids, null
    ids and ties change nothing; other columns stay, whatever their names (older n_words, runs and
    collapsed are replaced). There is no shuffle. A text of n words takes time n log n however it
    repeats; an empty table gives an empty one.
    """
    old = [F.col(f"`{c}`") for c in docs.columns if c not in ADDED]
    rows = docs.select(F.struct(*old).alias("own"), F.col("text"))
    schema = T.StructType([rows.schema["own"], *T.StructType.fromDDL(f"n_words long, runs {RUNS}, collapsed string")])
    told = rows.mapInArrow(_mark(least), schema)
    return told.select("own.*", "n_words", "runs", "collapsed")


def looped(doc_id: Column, text: Column) -> Column:
    """The text, for a tenth of all ids with a tail that repeats words: what the query op12 works on.

    With h the CRC-32 of the decimal id and g = h div 10, each word from number a = g mod n on becomes
    word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8), where h mod 10 = 0 and there are n > 0 words.
    """
    h = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        a = F.pmod(g, F.size(w)).cast("int")
        p = (1 + F.floor((F.size(w) - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        return F.array_join(F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, a + F.pmod(i - a, p)))), " ")

    return F.when(F.coalesce(h % 10 == 0, F.lit(False)) & F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")), let(words(text), repeated)).otherwise(text)


def runs_digest(marked: DataFrame) -> DataFrame:
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    marked = marked.select("doc_id", "runs", "collapsed", best.alias("best"), listed.alias("listed"))
    return marked.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.encode("listed", "UTF-8"), 256).alias("runs_sha256"), F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )
