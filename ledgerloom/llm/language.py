"""Language identification by prediction by partial matching over bytes.

Every language has a variable-order context tree: counts of each byte after each run of up to
``order`` bytes. A byte that a context has not seen costs an escape, and the next shorter context is
asked (method C: a context seen n times with d different bytes escapes with d / (n + d); the empty
context escapes to 1 / 256). The statistics are frozen before texts are scored, so a byte's code
length depends on the last ``order + 1`` bytes only and can be looked up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.batches import PIECE, pieces, utf8
from ledgerloom.llm.native import set_aside
from ledgerloom.llm.store import kept

#: Letters to lower case; digits, marks and blanks become one byte; bytes beyond ASCII stay.
FOLD = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)
UNKNOWN = "und"
#: Bytes of text, over the number of languages, that are scored at once by a model in parts: each is read anew for them.
PARTS_PIECE = 32 << 20


def grams(raw: np.ndarray, ends: np.ndarray, lo: int, hi: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of rows lo..hi with the ``order`` bytes before it as one number, and row offsets.

    A text is taken to follow ``order`` blanks, and a run of blanks counts once.
    """
    starts = ends[lo:hi] - ends[lo]
    sizes = np.diff(ends[lo : hi + 1])
    text = FOLD[raw[ends[lo] : ends[hi]]]
    owner = np.repeat(np.arange(hi - lo), sizes)
    keep = np.ones(len(text), bool)
    keep[1:] = (text[1:] != 32) | (text[:-1] != 32)
    keep[starts[sizes > 0]] = True
    text, owner = text[keep], owner[keep]
    sizes = np.bincount(owner, minlength=hi - lo)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    padded = np.full(len(text) + order * (hi - lo), 32, np.uint8)
    at = np.arange(len(text)) + order * (owner + 1)
    padded[at] = text
    kind = np.uint32 if order <= 3 else np.uint64
    out = np.zeros(len(text), kind)
    for k in range(order, -1, -1):
        out = (out << kind(8)) | padded[at - k]
    return out, offsets


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = utf8(batch.column("text"))
            names, codes = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object), return_inverse=True)
            for lo, hi in pieces(ends, 8 << 20):
                g, offsets = grams(raw, ends, lo, hi, order)
                of = np.repeat(codes[lo:hi], np.diff(offsets))
                for k in np.unique(codes[lo:hi]):
                    seen, n = np.unique(g[of == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[k]] * len(seen), pa.string()), pa.array(seen.astype(np.int64)), pa.array(n)],
                        ["lang", "gram", "n"],
                    )

    return run


def count_grams(docs: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n): how often each run of ``order + 1`` bytes occurs in the texts of a language."""
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text")
    counted = known.mapInArrow(_count(order), "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Frozen code lengths, in nats, for every language (columns) and known gram (rows) of each length."""

    langs: list[str]
    order: int
    keys: list[np.ndarray]  # of grams of 1, 2, ... bytes, sorted
    costs: list[np.ndarray]
    contexts: list[np.ndarray]  # of 0, 1, ... bytes, sorted
    escapes: list[np.ndarray]
    slots: np.ndarray  # where a long gram's row may be found at once

    BITS = 21

    def slot(self, gram: np.ndarray) -> np.ndarray:
        return (gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)

    def lengths(self, gram: np.ndarray, k: int) -> np.ndarray:
        """Code lengths of grams' last bytes given the ``k`` bytes before, known grams or not."""
        if k < 0:
            return np.full((len(gram), len(self.langs)), np.log(256), np.float32)
        gram = gram & np.uint64((1 << 8 * (k + 1)) - 1)
        row = np.minimum(np.searchsorted(self.keys[k], gram), len(self.keys[k]) - 1)
        known = self.keys[k][row] == gram
        out = self.costs[k][row]
        if not known.all():
            rest = gram[~known]
            context = rest >> np.uint64(8)
            at = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            escape = np.where((self.contexts[k][at] == context)[:, None], self.escapes[k][at], 0)
            out[~known] = self.lengths(rest, k - 1) + escape
        return out

    def score(self, gram: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each text in each language."""
        row = self.slots[self.slot(gram)]
        missed = np.flatnonzero(self.keys[-1][row] != gram)
        cost = self.costs[-1][row]
        if len(missed):
            odd, back = np.unique(gram[missed].astype(np.uint64), return_inverse=True)
            cost[missed] = self.lengths(odd, self.order)[back]
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        full = np.diff(offsets) > 0
        if full.any():
            out[full] = np.add.reduceat(cost, offsets[:-1][full], axis=0, dtype=np.float64)
        return out


@dataclass
class Parts:
    """A model too large for one table: part i, a broadcast one, has the contexts whose near bytes are from ``starts[i]`` on."""

    langs: list[str]
    order: int
    starts: np.ndarray
    parts: list

    def score(self, gram: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of each text in each language; one part is in memory at a time."""
        part = np.searchsorted(self.starts, near(gram), "right") - 1
        by = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[by], np.arange(len(self.parts) + 1))
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        for i, shared in enumerate(self.parts):
            own = by[cuts[i] : cuts[i + 1]]
            if not len(own):
                continue
            out += Model(**shared.value).score(gram[own], np.searchsorted(row[own], np.arange(len(offsets))))
            vars(shared).pop("_value", None)
        return out


def near(gram: np.ndarray) -> np.ndarray:
    """The two bytes before a gram's last one."""
    return (gram.astype(np.uint64) >> np.uint64(8)) & np.uint64(0xFFFF)


def freeze(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray, order: int, below: Model | None = None) -> Model:
    """The model of counted grams; ``lang`` holds positions in ``langs``.

    ``below`` has what is known of shorter grams; without it, it is taken from ``gram`` too.
    """
    keys, costs, contexts, escapes = (list(x) for x in (below.keys, below.costs, below.contexts, below.escapes)) if below else ([], [], [], [])
    for k in range(len(keys), order + 1):
        g = gram & np.uint64((1 << 8 * (k + 1)) - 1)
        key, row = np.unique(g, return_inverse=True)
        count = np.zeros((len(key), len(langs)))
        np.add.at(count, (row, lang), n)
        context, of = np.unique(key >> np.uint64(8), return_inverse=True)
        total, kinds = (np.zeros((len(context), len(langs))) for _ in range(2))
        np.add.at(total, of, count)
        np.add.at(kinds, of, count > 0)
        seen = total > 0
        escape = np.where(seen, np.log(np.where(seen, total + kinds, 1)) - np.log(np.where(seen, kinds, 1)), 0)
        shorter = (
            costs[-1][np.searchsorted(keys[-1], key & np.uint64((1 << 8 * k) - 1))]
            if k
            else np.full((len(key), len(langs)), np.log(256))
        )
        own = np.log(np.where(seen, total + kinds, 1))[of] - np.log(np.where(count > 0, count, 1))
        keys.append(key)
        costs.append(np.where(count > 0, own, shorter + escape[of]).astype(np.float32))
        contexts.append(context)
        escapes.append(escape.astype(np.float32))
    model = Model(langs, order, keys, costs, contexts, escapes, np.zeros(1 << Model.BITS, np.int32))
    often = np.zeros(len(keys[-1]))
    np.add.at(often, np.searchsorted(keys[-1], gram), n)
    by = np.argsort(often, kind="stable")  # of grams that share a slot, the most frequent is written last
    model.slots[model.slot(keys[-1][by])] = by
    if order <= 3:
        model.keys[-1] = model.keys[-1].astype(np.uint64)
    return model


def train(docs: DataFrame, order: int = 3, max_rows: int = 4_000_000) -> Model | Parts | None:
    """The model of all rows with a text and a lang; None if there is none.

    Counts come from every text. The frozen table goes to all tasks, so its size is checked: a table of
    more than ``max_rows`` rows, or numbers (a gram has one for each language), goes in parts of at most so
    many. The contexts that share their two near bytes stay together; of them there are 65,536 at most,
    with 256 ** (order - 1) grams each. Code lengths are the same.
    """
    counted = kept(count_grams(docs, order))
    names = sorted(r["lang"] for r in counted.select("lang").distinct().collect())
    if not names:
        return None
    place = {name: i for i, name in enumerate(names)}

    def table(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        got = rows.select("lang", "gram", "n").toArrow()
        lang = np.array([place[x] for x in got.column("lang").to_pylist()])
        return lang, got.column("gram").to_numpy().astype(np.uint64), got.column("n").to_numpy().astype(np.float64)

    context = F.shiftrightunsigned("gram", 8).bitwiseAND(0xFFFF)
    sizes = counted.groupBy(context.alias("near")).agg(F.count("*").alias("n"), F.count_distinct("gram").alias("grams")).collect()
    sizes = sorted((r["near"], max(r["n"], r["grams"] * len(names))) for r in sizes)
    if order < 2 or sum(n for _, n in sizes) <= max_rows:
        return freeze(names, *table(counted), order)
    starts, held = [0], 0
    for value, n in sizes:
        if held and held + n > max_rows:
            starts.append(value)
            held = 0
        held += n
    short = counted.groupBy("lang", F.col("gram").bitwiseAND(0xFFFF).alias("gram")).agg(F.sum("n").alias("n"))
    below = freeze(names, *table(short), 1)
    parts = []
    for lo, hi in zip(starts, [*starts[1:], 1 << 16]):
        own = freeze(names, *table(counted.where((context >= lo) & (context < hi))), order, below)
        parts.append(docs.sparkSession.sparkContext.broadcast(vars(own)))
    return Parts(names, order, np.array(starts, np.uint64), parts)


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared if isinstance(shared, Parts) else Model(**shared.value)
        names = np.array(model.langs, dtype=object)
        limit = max(PIECE, PARTS_PIECE // len(names)) if isinstance(model, Parts) else PIECE
        for batch in batches:
            raw, ends = utf8(batch.column("text"))
            lang, score = [], []
            for lo, hi in pieces(ends, limit):
                length = model.score(*grams(raw, ends, lo, hi, model.order))
                best = length.argmin(axis=1)
                lang.append(names[best])
                score.append(1 / np.exp(length.min(axis=1, keepdims=True) - length).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(lang) if lang else [], pa.string()),
                 pa.array(np.concatenate(score) if score else [], pa.float64())],
                [*batch.schema.names, "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, model: Model | Parts | None) -> DataFrame:
    """``docs`` with lang_pred and score, the posterior of the language under equal priors.

    Only ``text`` is read. Null text, a text without any letter, and an empty model give ``und``
    with score 0. Equal code lengths go to the smaller name. Older lang_pred and score are replaced,
    other columns stay, whatever their names.
    """
    docs, columns = set_aside(docs.drop("lang_pred", "score"), "text")
    if model is None:
        return docs.select(*columns, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = model if isinstance(model, Parts) else docs.sparkSession.sparkContext.broadcast(vars(model))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    scored = docs.mapInArrow(_predict(shared), schema + ", lang_pred string, score double")
    known = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    lang, score = F.when(known, F.col("lang_pred")).otherwise(UNKNOWN), F.when(known, F.col("score")).otherwise(0.0)
    return scored.select(*columns, lang.alias("lang_pred"), score.alias("score"))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
