"""Benchmark decontamination with one Aho-Corasick automaton over the normalised benchmark texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.native import set_aside

#: Words, in a text as it stands: runs of ASCII letters and digits and of all characters beyond ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Byte by byte: letters to lower case, all that parts words to a blank.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
ADDED = ("n_words", "found", "n_hit", "items", "spans", "contaminated")
FOUND = "array<struct<word:int,words:int,item:string>>"


def folded(text: str) -> list[bytes]:
    """The normalised words of a text as UTF-8 bytes."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


def windows(text: str | None, size: int) -> list[tuple[bytes, ...]]:
    """All runs of ``size`` words; the whole text if it has fewer words, nothing if it has none."""
    w = folded(text or "")
    if not w:
        return []
    return [tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))]


def build(items: list[tuple[str, str | None]], size: int):
    """The automaton of all windows of the items, or None if there is no window."""
    import ahocorasick

    owners: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        for w in windows(text, size):
            owners.setdefault(w, set()).add(item)
    if not owners:
        return None
    auto = ahocorasick.Automaton()
    for w, who in owners.items():
        key = " " + b" ".join(w).decode("latin-1") + " "
        auto.add_word(key, (len(key), len(w), sorted(who)))
    auto.make_automaton()
    return auto


def scan_text(auto, text: str) -> tuple[int, list[tuple[int, int, str]]]:
    """(number of words, [(first word, words, item) of every occurrence])."""
    w = folded(text)
    if not w or auto is None:
        return len(w), []
    line = " " + b" ".join(w).decode("latin-1") + " "
    out, at, word = [], 0, 0
    for end, (length, n, who) in auto.iter(line):
        start = end - length + 1
        if start < at:
            word -= line.count(" ", start, at)
        else:
            word += line.count(" ", at, start)
        at = start
        out += [(word, n, item) for item in who]
    return len(w), out


def _scan(items: list[tuple[str, str | None]], size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = build(items, size)
        for batch in batches:
            texts, before = batch.column("text"), batch.column("found")
            counts, found = [], []
            for text, old in zip(texts, before):
                text = text.as_py()
                n, hits = scan_text(auto, text) if text else (0, [])
                counts.append(n)
                found.append((old.as_py() if old.is_valid else []) + [{"word": a, "words": b, "item": c} for a, b, c in hits])
            cols = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] not in ("n_words", "found")]
            names = [c for c in batch.schema.names if c not in ("n_words", "found")]
            kind = pa.list_(pa.struct([("word", pa.int32()), ("words", pa.int32()), ("item", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(counts, pa.int64()), pa.array(found, kind)], [*names, "n_words", "found"]
            )

    return run


def item_chunks(benchmark: DataFrame, chunk_chars: int, max_chars: int) -> list[list[tuple[str, str | None]]]:
    """The benchmark's texts in lists of at most ``chunk_chars`` characters (or one longer text)."""
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    if total > max_chars:
        raise ValueError(f"the benchmark has {total} characters; max_chars is {max_chars}")
    chunks, room = [[]], chunk_chars
    for row in benchmark.select(F.col("item_id").cast("string").alias("i"), "text").orderBy("i", "text").collect():
        if not row["text"]:
            continue
        if len(row["text"]) > room and chunks[-1]:
            chunks.append([])
            room = chunk_chars
        chunks[-1].append((row["i"] or "", row["text"]))
        room -= len(row["text"])
    return chunks


def find_items(docs: DataFrame, benchmark: DataFrame, size: int = 13, chunk_chars: int = 2_000_000, max_chars: int = 200_000_000) -> DataFrame:
    """``docs`` with n_words and found: every occurrence of a window as (word, words, item).

    A benchmark of up to ``chunk_chars`` characters makes one automaton and each text is scanned
    once; a larger one makes several, each in a pass of its own, so that a worker holds one bounded
    automaton. Beyond ``max_chars`` the call fails, as the texts pass through the driver. There is
    no shuffle. Null text has no words; null item texts and items without words have no window; a
    null item_id is the empty string. Other columns of ``docs`` stay; its own n_words or found go.
    """
    keep = [F.col(c) for c in docs.columns if c not in ("n_words", "found")]
    out = docs.select(*keep, F.lit(0).cast("long").alias("n_words"), F.array().cast(FOUND).alias("found"))
    schema = out.schema
    for chunk in item_chunks(benchmark, chunk_chars, max_chars):
        out = out.mapInArrow(_scan(chunk, size), schema)
    return out


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_hit, items, spans = [], [], []
        for found, text in zip(batch.column("found"), batch.column("text")):
            hits = found.as_py() if found.is_valid else []
            if not hits:
                n_hit.append(0), items.append([]), spans.append([])
                continue
            words = [(m.start(), m.end()) for m in WORD.finditer(text.as_py())]
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, [h["word"] for h in hits], 1)
            np.add.at(edge, [h["word"] + h["words"] for h in hits], -1)
            hit = np.cumsum(edge)[:-1] > 0
            turn = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
            n_hit.append(int(hit.sum()))
            items.append(sorted({h["item"] for h in hits}))
            spans.append([{"start": words[a][0], "end": words[b - 1][1]} for a, b in zip(turn[::2], turn[1::2])])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        names = [n for n in batch.schema.names if n != "found"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in names), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, kind)],
            [*names, "n_hit", "items", "spans"],
        )


def mark_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20, **limits: int) -> DataFrame:
    """``docs`` with n_words, n_hit, items, spans and contaminated.

    A word is hit inside any occurrence of a window; ``spans`` are the runs of hit words as
    [start, end) in code points of the original text. A document is contaminated when it has hit
    words and they are at least 1/``share`` of its words.

    Null, empty and wordless texts have no words and no hits; rows that repeat are judged each, whatever their
    ids; other columns stay, whatever their names (older ones of the added names are replaced). An empty table
    gives an empty one, an empty benchmark no hits.
    """
    docs, columns = set_aside(docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ADDED]), "doc_id", "text")
    found = find_items(docs, benchmark, size, **limits)
    fields = [f for f in found.schema.fields if f.name != "found"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    schema += ", n_hit long, items array<string>, spans array<struct<start:int,end:int>>"
    bad = (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))
    marked = found.mapInArrow(_spans, schema)
    return marked.select(*columns, "n_words", "n_hit", "items", "spans", bad.alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how: int) -> DataFrame:
    """``docs`` without the contaminated documents."""
    docs, columns = set_aside(docs, "doc_id", "text")
    return mark_contaminated(docs, benchmark, **how).where(~F.col("contaminated")).select(*columns)


def contamination_digest(marked: DataFrame) -> DataFrame:
    return marked.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )
