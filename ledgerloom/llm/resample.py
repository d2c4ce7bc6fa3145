"""Importance resampling towards a target text: hashed n-gram features, counted once for each distinct line.

Separator newlines cut texts into lines. Equal lines of all texts become one row with the number of
their occurrences; the features of a distinct line are counted once and multiplied by it. N-grams
that reach over a line's end are counted from the texts and added. A document's weight is the mean,
over its features, of how much more often their buckets occur in the target than here; documents are drawn
without replacement by weight plus Gumbel noise, which depends on the id only.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.native import digest
from ledgerloom.llm.store import kept

#: Byte by byte: letters to lower case, all that parts words to a blank, line feeds too.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Distinct features or lines that a task remembers before it starts anew.
MEMORY = 200_000
#: Scores to a block when places are counted, and copies of a row that are spread out at once.
BLOCK, SPREAD = 256, 10_000


def words(line: bytes) -> list[bytes]:
    return line.translate(FOLD).split()


def grams(w: list[bytes], size: int) -> list[bytes]:
    """All runs of 1 to ``size`` words, joined by a blank."""
    out = list(w)
    for n in range(2, size + 1):
        out += [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]
    return out


def crossing(lines: list[list[bytes]], size: int) -> list[bytes]:
    """The runs of 2 to ``size`` words that begin in one line and end in another."""
    w = [x for line in lines for x in line]
    of = [k for k, line in enumerate(lines) for _ in line]
    return [
        b" ".join(w[i : i + n]) for n in range(2, size + 1) for i in range(len(w) - n + 1) if of[i] != of[i + n - 1]
    ]


def _text(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def _count(size: int, buckets: int, over_lines: bool):
    """Rows (bucket, n) of (line, times), or with ``over_lines`` of the n-grams that cross lines of (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        seen: Counter[bytes] = Counter()

        def settle() -> None:
            for gram, n in seen.items():
                total[crc32(gram) % buckets] += n
            seen.clear()

        for batch in batches:
            times = None if over_lines else batch.column(1).to_pylist()
            for row, value in enumerate(batch.column(0)):
                text = _text(value)
                if over_lines:
                    seen.update(crossing([words(x) for x in text.split(b"\n")], size))
                elif times[row] == 1:
                    seen.update(grams(words(text), size))
                else:
                    for gram, n in Counter(grams(words(text), size)).items():
                        seen[gram] += n * times[row]
                if len(seen) > MEMORY:
                    settle()
        settle()
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, size: int, buckets: int) -> np.ndarray:
    """How many features of all ``text`` fall in each bucket; at most ``buckets`` numbers reach the driver."""
    texts = texts.select("text").where(F.col("text").isNotNull())
    lines = texts.select(F.explode(F.split("text", "\n", -1)).alias("line")).where("line <> ''")
    lines = lines.groupBy("line").agg(F.count("*").alias("times"))
    found = lines.mapInArrow(_count(size, buckets, False), "bucket long, n long")
    if size > 1:
        found = found.union(texts.mapInArrow(_count(size, buckets, True), "bucket long, n long"))
    told = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(buckets, np.int64)
    counts[told.column("bucket").to_numpy()] = told.column("n").to_numpy()
    return counts


def gains(own: np.ndarray, target: np.ndarray) -> list[int]:
    """floor(1000 ln(share of the bucket in the target / share here)), both counts raised by one."""
    m, all_own, all_target = len(own), float(own.sum()), float(target.sum())
    return [
        math.floor(1000 * math.log(float(t + 1) * (all_own + m) / (float(s + 1) * (all_target + m))))
        for s, t in zip(own.tolist(), target.tolist())
    ]


def _weigh(gain: list[int], size: int):
    """(doc_id, digest, n_words, n_features, weight) of (doc_id, digest, text)."""
    buckets = len(gain)

    class Known(dict):
        def __missing__(self, gram: bytes) -> int:
            if len(self) >= MEMORY:
                self.clear()
            self[gram] = gain[crc32(gram) % buckets]
            return self[gram]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known()
        lines: dict[bytes, tuple[int, int, int]] = {}  # (words, features, sum of gains) of short lines
        for batch in batches:
            out = np.zeros((3, batch.num_rows), np.int64)
            for row, value in enumerate(batch.column("text")):
                cut = _text(value).split(b"\n")
                n_words = n_features = total = 0
                for line in cut:
                    told = lines.get(line)
                    if told is None:
                        w = words(line)
                        own = grams(w, size)
                        told = len(w), len(own), sum(map(known.__getitem__, own))
                        if len(line) < 1000:
                            if len(lines) >= MEMORY // 4:
                                lines.clear()
                            lines[line] = told
                    n_words, n_features, total = n_words + told[0], n_features + told[1], total + told[2]
                if size > 1 and len(cut) > 1:
                    own = crossing([words(x) for x in cut], size)
                    n_features, total = n_features + len(own), total + sum(map(known.__getitem__, own))
                out[:, row] = n_words, n_features, total // n_features if n_features else 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("digest"), *map(pa.array, out)],
                ["doc_id", "digest", "n_words", "n_features", "weight"],
            )

    return run


def noise(doc_id: Column, seed: str) -> Column:
    """Gumbel noise in thousandths, from the seed and the id alone."""
    told = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(told, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def score(docs: DataFrame, target: DataFrame, size: int = 1, buckets: int = 10_000, seed: str = "2024") -> DataFrame:
    """(doc_id, digest, n_words, n_features, weight, score) of each row of ``docs``; both tables have ``text``.

    Written once to the shared folder. Null, empty and wordless texts have no features and weight 0;
    a null id has the noise of an empty id; repeated rows and ids get a row each. Extra columns are
    ignored, whatever their names. An empty table gives an empty one; an empty target has no features.
    Very long texts are worked on line by line; one text is in memory at a time.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    gain = gains(bucket_counts(docs, size, buckets), bucket_counts(target, size, buckets))
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"), "text")
    told = rows.mapInArrow(_weigh(gain, size), f"doc_id {kind}, digest binary, n_words long, n_features long, weight long")
    return kept(told.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))


def places(scored: DataFrame, least_words: int, percent: int) -> tuple[DataFrame, int, int]:
    """(groups of equal rows with ``first`` place and ``copies``, number to draw, lowest score that may be drawn).

    Places are counted without a sort of all rows: rows to a score, scores to a block of scores, blocks.
    A score lies within some 130,000 values whatever the input, so the table of scores is small. Within a score
    the smaller id comes first, null last; equal rows are one group, so that copies gather nowhere.
    """
    may = scored.where(F.col("n_words") >= least_words)
    levels = kept(may.groupBy("score").agg(F.count("*").alias("n")).withColumn("block", F.floor(F.col("score") / BLOCK)))
    many = (levels.agg(F.sum("n")).first()[0] or 0) * percent // 100
    blocks = levels.groupBy("block").agg(F.sum("n").alias("n"))
    above = F.sum("n").over(Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("block", F.coalesce(above, F.lit(0)).alias("above"))
    within = F.sum("n").over(Window.partitionBy("block").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))
    before = F.col("above") + F.coalesce(within, F.lit(0))
    levels = levels.join(F.broadcast(blocks), "block").select("score", before.alias("before")).where(F.col("before") < many)
    lowest = levels.agg(F.min("score")).first()[0]
    lowest = (1 << 62) if lowest is None else lowest
    same = ["doc_id", "digest", "n_words", "n_features", "weight", "score"]
    groups = may.where(F.col("score") >= lowest).groupBy(*same).agg(F.count("*").alias("copies"))
    groups = groups.join(F.broadcast(levels), "score")
    order = [F.asc_nulls_last("doc_id"), F.asc("digest")]
    earlier = F.sum("copies").over(Window.partitionBy("score").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    first = F.col("before") + F.coalesce(earlier, F.lit(0)) + 1
    return groups.select(*same, "copies", first.alias("first")), many, lowest


def rank(scored: DataFrame, least_words: int = 20, percent: int = 10) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... of the drawn rows, null for all others.

    Of the rows with ``least_words`` words or more, ``percent`` percent (rounded down) are drawn: the
    highest scores, ties to the smaller id.
    """
    groups, many, lowest = places(scored, least_words, percent)
    out = (F.col("n_words") < least_words) | (F.col("score") < lowest)
    rest = scored.where(out).select("*", F.lit(None).cast("long").alias("rank"))
    at = groups.select("*", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(SPREAD))).alias("from"))
    to = F.least(F.col("copies"), F.col("from") + SPREAD) - 1
    at = at.select("*", F.explode(F.sequence(F.col("from"), to)).alias("copy"))
    place = F.col("first") + F.col("copy")
    return rest.union(at.select(*scored.columns, F.when(place <= many, place).alias("rank")))


def draw(docs: DataFrame, target: DataFrame, least_words: int = 20, percent: int = 10, **how) -> DataFrame:
    """The drawn documents with all their columns, whatever their names; of equal rows as many as were drawn.

    Rows are told apart by id and text. See ``score`` for odd rows.
    """
    groups, many, _ = places(score(docs, target, **how), least_words, percent)
    share = F.greatest(F.lit(0), F.least("copies", many - F.col("first") + 1))
    groups = kept(groups.select("doc_id", "digest", "copies", share.alias("drawn")).where("drawn > 0"))
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own = groups.select(F.col("doc_id").alias("id"), F.col("digest").alias("own"), "drawn", "copies")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("digest").eqNullSafe(F.col("own"))
    out = rows.join(own.where("drawn = copies"), same, "left_semi").select("row.*")
    for last in groups.where("drawn < copies").collect():  # one group at most: the one at the end of the draw
        cut = rows.where(F.col("doc_id").eqNullSafe(F.lit(last["doc_id"])) & F.col("digest").eqNullSafe(F.lit(last["digest"])))
        out = out.union(cut.limit(last["drawn"]).select("row.*"))
    return out
