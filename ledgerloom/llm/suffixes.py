"""Removal of repeated 200-byte strings by blockwise suffix sorting with a difference cover.

1. Each 200-byte string is held by its anchor, the 32-byte substring with the smallest hash. Equal
   strings have equal anchors in the same place, so a string can repeat only if its anchor does.
   Anchors are counted, and text around anchors found once stays where it is.
2. The stretches of text held by repeated anchors are dealt out by anchor. A task takes them block by
   block (whole anchor groups, a few megabytes) and sorts the suffixes of a block one bucket at a
   time: by their first and last bytes of a window of COVER bytes, and where those tie, by ranks of
   the sample positions of a difference cover, which are worked out once per block. For any two
   positions the cover has a shift that brings both to sample positions, and the rank there stands
   for all the bytes between. So no suffix is ever spelt out, and a bucket's work fits in memory.
3. Anchors found very often would make blocks too large. Their strings are counted by hash instead,
   with partial counts before the shuffle and a join in parts.
4. Runs of repeated strings go back to their texts and are cut out.

Byte strings are told apart by 64-bit hashes of several parts (128 bits in step 3).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.batches import pieces, utf8
from ledgerloom.llm.bits import bit_filter, passes
from ledgerloom.llm.native import digest, set_aside
from ledgerloom.llm.shingles import BYTE, mixed
from ledgerloom.llm.store import kept

#: Bytes of an anchor.
ANCHOR = 32
#: An anchor found more often is counted by hash. So many stretches of text make 4.7 MB at most, which a
#: task can sort as one block.
HOT = 16_384
#: Bytes of text in a block of several anchors, and the number of buckets its suffixes are sorted in.
BLOCK = 2 << 20
BUCKETS = 8
#: A difference cover. Every number below 57 is a difference of two of these, modulo 57.
COVER = 57
SAMPLE = (0, 1, 3, 13, 32, 36, 43, 52)
#: Parts in which hot strings meet their occurrences.
PARTS = 32


def shifts() -> np.ndarray:
    """For residues i and j, a shift that brings both into the sample."""
    out = np.full((COVER, COVER), -1, np.int64)
    for d in range(COVER):
        hit = np.array([(i + d) % COVER in SAMPLE for i in range(COVER)])
        out[np.outer(hit, hit) & (out < 0)] = d
    assert out.min() >= 0
    return out


class Rolling:
    """Hashes of all substrings of a byte array, each from two prefix sums."""

    def __init__(self, text: np.ndarray, base: int = 0x9E3779B97F4A7C17):
        n = len(text)
        self.back = np.empty(n + 1, np.uint64)
        self.back[0] = 1
        np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64), out=self.back[1:])
        power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), base, np.uint64)]))[:n]
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE[text] * power, out=self.sums[1:])

    def of(self, at: np.ndarray, size: int) -> np.ndarray:
        return mixed((self.sums[at + size] - self.sums[at]) * self.back[at])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.back[:n])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    n = len(x) - width + 1
    filled = np.concatenate([x, np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    before = np.minimum.accumulate(filled, axis=1).ravel()
    after = np.minimum.accumulate(filled[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def anchors(text: np.ndarray, starts: np.ndarray, size: int, roll: Rolling) -> tuple[np.ndarray, ...]:
    """(hash of the anchor, first string, strings) for each run of strings with one anchor.

    ``starts`` are the texts' beginnings in ``text`` and its end; strings do not cross them.
    """
    if len(text) < size:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64))
    small = roll.all(ANCHOR)
    packed = (small & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(small), dtype=np.uint64)
    least = sliding_least(packed, size - ANCHOR + 1)
    fits = np.zeros(len(text) + 1, np.int32)
    long = np.diff(starts) >= size
    fits[starts[:-1][long]] += 1
    fits[starts[1:][long] - size + 1] -= 1
    where = np.flatnonzero(np.cumsum(fits)[: len(least)] > 0)
    if not len(where):
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64))
    anchor = (least[where] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.ones(len(where), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (where[1:] != where[:-1] + 1)
    at = np.flatnonzero(new)
    return small[anchor[at]], where[at], np.diff(np.append(at, len(where)))


def _new_texts(batch: pa.RecordBatch, seen: set) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """(bytes, offsets, digests) of pieces of a batch, each text once per task."""
    ids = batch.column("digest").to_pylist()
    fresh = [not (i in seen or seen.add(i)) for i in ids]
    part = batch.filter(pa.array(fresh, pa.bool_()))
    if not part.num_rows:
        return
    raw, ends = utf8(part.column("text"))
    ids = part.column("digest").to_pylist()
    for lo, hi in pieces(ends):
        yield raw[ends[lo] : ends[hi]], ends[lo : hi + 1] - ends[lo], ids[lo:hi]


def _anchor_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for text, starts, _ in _new_texts(batch, seen):
                h, _, _ = anchors(text, starts, size, Rolling(text))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["anchor"])

    return run


def _stretches(size: int, live, hot, want_hot: bool):
    """Text held by repeated anchors: (anchor, digest, start, text), or strings of hot ones (h, g, digest, start)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            for text, starts, ids in _new_texts(batch, seen):
                roll = Rolling(text)
                h, first, n = anchors(text, starts, size, roll)
                key = h.view(np.int64)
                often = passes(hot.value, key) if hot is not None else np.zeros(len(key), bool)
                take = often if want_hot else passes(live.value, key) & ~often
                key, first, n = key[take], first[take], n[take]
                of = np.searchsorted(starts, first, side="right") - 1
                if want_hot:
                    at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                    doc = np.repeat(of, n)
                    other = Rolling(text, 0xD6E8FEB86659FD93)
                    for lo in range(0, len(at), 200_000):
                        p, d = at[lo : lo + 200_000], doc[lo : lo + 200_000]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(roll.of(p, size).view(np.int64)), pa.array(other.of(p, size).view(np.int64)),
                             pa.array([ids[i] for i in d], pa.binary()), pa.array(p - starts[d])], ["h", "g", "digest", "start"],
                        )
                    continue
                bounds = np.stack([first, first + n + size - 1], axis=1)
                for lo in range(0, len(key), 20_000):
                    some = slice(lo, lo + 20_000)
                    spelt = [text[a:b].tobytes() for a, b in bounds[some]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key[some]), pa.array([ids[i] for i in of[some]], pa.binary()),
                         pa.array(first[some] - starts[of[some]]), pa.array(spelt, pa.binary())], ["anchor", "digest", "start", "text"],
                    )

    return run


def repeated(text: np.ndarray, strings: np.ndarray, size: int) -> np.ndarray:
    """Whether each string (given by its place in ``text``) equals another of them."""
    roll = Rolling(text)
    shift = shifts()
    middle = size - COVER + 1
    inside = np.arange(max(0, len(text) - middle + 1))
    inside = inside[np.isin(inside % COVER, SAMPLE)]
    rank = np.zeros(len(text), np.int32)
    rank[inside] = np.unique(roll.of(inside, middle), return_inverse=True)[1]
    key = mixed(roll.of(strings, COVER) + roll.of(strings + size - COVER, COVER) * np.uint64(3))
    out = np.zeros(len(strings), bool)
    bucket = (key >> np.uint64(32)) % np.uint64(BUCKETS)
    for b in range(BUCKETS):
        own = np.flatnonzero(bucket == b)
        own = own[np.argsort(key[own], kind="stable")]
        while len(own):
            k = key[own]
            new = np.ones(len(own), bool)
            new[1:] = k[1:] != k[:-1]
            head = np.flatnonzero(new)
            size_of = np.diff(np.append(head, len(own)))
            leader = np.repeat(own[head], size_of)
            p, q = strings[own], strings[leader]
            d = shift[p % COVER, q % COVER]
            equal = rank[p + d] == rank[q + d]
            met = np.add.reduceat(equal, head)  # the leader equals itself
            out[own[equal & np.repeat(met > 1, size_of)]] = True
            own = own[~equal]  # the others of a tie are sorted out among themselves
    return out


def _sorted_blocks(size: int):
    """Runs (digest, start, n) of repeated strings, from stretches sorted by anchor."""

    def solve(rows: list[tuple[bytes, int, bytes]]) -> pa.RecordBatch | None:
        text = np.frombuffer(b"".join(t for *_, t in rows), np.uint8)
        length = np.array([len(t) for *_, t in rows])
        begin = np.cumsum(length) - length
        n = length - size + 1
        of = np.repeat(np.arange(len(rows)), n)
        strings = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
        hit = np.flatnonzero(repeated(text, strings, size))
        if not len(hit):
            return None
        new = np.ones(len(hit), bool)
        new[1:] = (hit[1:] != hit[:-1] + 1) | (of[hit[1:]] != of[hit[:-1]])
        head = np.flatnonzero(new)
        who = of[hit[head]]
        start = strings[hit[head]] - begin[who] + np.array([s for _, s, _ in rows])[who]
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[i][0] for i in who], pa.binary()), pa.array(start, pa.int64()), pa.array(np.diff(np.append(head, len(hit))))],
            ["digest", "start", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, last, group = [], 0, None, []
        for batch in batches:
            for anchor, *row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "start", "text"))):
                if anchor != last:
                    if len(group) > 1:
                        rows += group
                        held += sum(len(r[2]) for r in group)
                        if held > BLOCK:
                            if (out := solve(rows)) is not None:
                                yield out
                            rows, held = [], 0
                    group, last = [], anchor
                group.append(tuple(row))
        if len(group) > 1:
            rows += group
        if rows and (out := solve(rows)) is not None:
            yield out

    return run


def repeated_runs(docs: DataFrame, size: int) -> DataFrame:
    """(digest, start, n): n strings in a row, from byte ``start``, that occur elsewhere too.

    Each text counts once per task here; copies of whole texts are for the caller.
    """
    texts = docs.select(digest(F.col("text")).alias("digest"), "text").where(F.octet_length("text") >= size)
    counted = texts.mapInArrow(_anchor_rows(size), "anchor long").groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    counted = kept(counted)
    live = bit_filter(counted.select("anchor"))
    often = counted.where(F.col("n") > HOT).select("anchor")
    any_hot = not often.isEmpty()
    hot = bit_filter(often) if any_hot else None
    rows = texts.mapInArrow(_stretches(size, live, hot, False), "anchor long, digest binary, start long, text binary")
    rows = rows.repartition("anchor").sortWithinPartitions("anchor")
    runs = rows.mapInArrow(_sorted_blocks(size), "digest binary, start long, n long")
    if any_hot:
        strings = texts.mapInArrow(_stretches(size, live, hot, True), "h long, g long, digest binary, start long")
        twice = strings.groupBy("h", "g").agg(F.count("*").alias("c")).where("c > 1").drop("c")
        twice = twice.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        parted = strings.withColumn("part", F.pmod(F.xxhash64("digest", "start"), F.lit(PARTS)).cast("int"))
        runs = runs.union(parted.join(twice, ["h", "g", "part"]).select("digest", "start", F.lit(1).cast("long")))
    return runs


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, n_removed, n_spans, sha, spans = [], [], [], [], []
            for text, copied, runs in zip(batch.column("text"), batch.column("copied"), batch.column("runs")):
                raw = np.frombuffer((text.as_py() or "").encode("utf-8", "surrogatepass"), np.uint8)
                edge = np.zeros(len(raw) + 1, np.int32)
                if copied.as_py() and len(raw) >= size:
                    edge[0] = 1
                elif runs.is_valid:
                    found = runs.as_py()
                    np.add.at(edge, [r["start"] for r in found], 1)
                    np.add.at(edge, [r["start"] + r["n"] + size - 1 for r in found], -1)
                gone = np.cumsum(edge)[:-1] > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                n_bytes.append(len(raw)), n_removed.append(int(gone.sum())), n_spans.append(len(turn) // 2)
                spans.append([{"start": a, "end": b} for a, b in zip(turn[::2].tolist(), turn[1::2].tolist())])
                sha.append(hashlib.sha256(raw[~gone].tobytes()).hexdigest())
            old = [c for c in batch.schema.names if c not in ("copied", "runs")]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in old), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(sha, pa.string()), pa.array(spans, kind)],
                [*old, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return run


ADDED = ("copied", "runs", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def cut_repeats(docs: DataFrame, size: int = 200) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans, kept_sha256 and spans, the removed [start, end) in bytes.

    Removed is each byte in a string of ``size`` bytes that also starts anywhere else, in the same
    document too; strings lie within one text and are judged on the whole input. Null texts count as
    empty, and texts shorter than ``size`` lose nothing. Repeated ids and repeated rows are rows like
    any other, so both lose what they share. Columns of the same names are replaced, all others stay, whatever
    their names. An empty table gives an empty one.
    """
    docs, columns = set_aside(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ADDED]), "text")
    runs = repeated_runs(docs, size)
    per_text = runs.groupBy("digest").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    copied = docs.select(digest(F.col("text")).alias("digest")).groupBy("digest").agg(F.count("*").alias("c")).where("c > 1")
    told = per_text.join(copied.select("digest", F.lit(True).alias("copied")), "digest", "full")
    told = kept(told.select(F.col("digest").alias("of"), F.coalesce("copied", F.lit(False)).alias("copied"), F.when(F.col("copied").isNull(), F.col("runs")).alias("runs")))
    rows = docs.select("*", digest(F.col("text")).alias("digest")).join(told, F.col("digest") == F.col("of"), "left").drop("digest", "of")
    rows = rows.withColumn("copied", F.coalesce("copied", F.lit(False)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    more = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    cut = rows.mapInArrow(_cut(size), f"{schema}, {more}")
    return cut.select(*columns, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
