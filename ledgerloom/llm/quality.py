"""Quality rules with DataFrame functions only: counts of a text, and lines that too many documents share.

Lines are normalised and hashed; per host, the distinct documents of each line are counted, near copies
of one document as one. Text never leaves its task for that: only hashes are shuffled. Lines in more documents than the limit are boilerplate and removed; a document of
which too little is left is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.native import digest, let, set_aside, without, words
from ledgerloom.llm.store import kept

#: Hot lines meet the lines of documents in so many parts.
PARTS = 16
#: Hashes that stand for a text when near copies are told from other documents.
SKETCH = 8
#: Bits of a bitmap, bits for each text that is marked in them, and bitmaps at most (64 MB).
BITS, EACH, MOST_MAPS = 32768, 16, 1 << 14
#: Up to so many lines (about 100 bytes each) go to all tasks; beyond, they are joined.
SENT = 200_000


def repeated_words(w: Column, size: int = 3) -> Column:
    """How many of the words ``w`` lie in a run of ``size`` words that occurs twice or more."""

    def covered(g: Column) -> Column:
        placed = F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        def same(x: Column, y: Column) -> Column:
            return F.coalesce(x["h"] == y["h"], F.lit(False))

        twice = let(placed, lambda s: F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1))))
        at = F.array_sort(F.transform(twice, lambda x: x["i"]))
        own = let(at, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(size), F.coalesce(F.get(p, k + 1) - x, F.lit(size)))),
            F.lit(0), lambda a, x: a + x,
        ))
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(own)

    runs = F.transform(
        F.sequence(F.lit(0), F.size(w) - size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)])
    )
    return F.when(F.size(w) <= size, F.lit(0)).otherwise(let(runs, covered))


def base_counts(text: Column) -> Column:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    dup = F.when(F.contains(text, F.lit("\n")), let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))).otherwise(0)
    return let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        dup.cast("long").alias("n_dup_lines"),
        repeated_words(w).cast("long").alias("n_repeat_words"),
    ))


def normal_line(line: Column) -> Column:
    """A line in lower case with one blank for each run of characters that are no letters."""
    return F.btrim(F.regexp_replace(F.lower(line), r"[^\p{L}]+", " "))


def line_rows(docs: DataFrame, key: list[str]) -> DataFrame:
    """(key, pos, chars, raw, line) of each line with a letter; line is a hash of the normalised line."""
    rows = docs.select(*key, F.posexplode(F.split("text", "\n", -1)).alias("pos", "raw"))
    rows = rows.withColumn("norm", normal_line(F.col("raw"))).where("norm != ''")
    return rows.select(*key, "pos", F.length("raw").alias("chars"), "raw", F.xxhash64("norm").alias("line"))


def in_parts(few: DataFrame) -> DataFrame:
    return few.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))


def part_of(fp: str = "fp") -> Column:
    return F.pmod(F.xxhash64(fp), F.lit(PARTS)).cast("int")


def met(lines: DataFrame, few: DataFrame, how: str) -> DataFrame:
    """``lines`` joined to a kept table of (host, line): sent to all tasks up to SENT rows, else in PARTS parts."""
    if few.count() <= SENT:
        return lines.join(F.broadcast(few), ["host", "line"], how)
    return lines.withColumn("part", part_of()).join(in_parts(few), ["host", "line", "part"], how).drop("part")


def among(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` (with host, fp) whose text is in ``found``, and a few more: found texts are marked in bitmaps for all tasks."""
    texts = found.select("host", "fp").distinct()
    maps = min(1 << (texts.count() * EACH // BITS).bit_length(), MOST_MAPS)
    h = F.xxhash64("host", "fp")
    place = [F.pmod(F.shiftright(h, 15), F.lit(maps)).alias("map"), F.pmod(h, F.lit(BITS)).alias("bit")]
    marked = texts.select(*place).distinct().repartition("map").groupBy("map").agg(F.bitmap_construct_agg("bit").alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = docs.select("*", *place).join(F.broadcast(kept(marked)), "map")
    return met.where(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1).select(*docs.columns)


def sketches(lines: DataFrame, often: DataFrame, found: DataFrame) -> DataFrame:
    """(host, fp, low) of the texts in ``found``, which has the rows of lines that many texts hold; ``lines`` has theirs at least.

    low has, for each remainder modulo SKETCH, the smallest CRC-32 with that remainder among three words in a row
    (a shorter line counts whole) in the text's lines that are not in ``often``. Where no such line is
    left, low is one hash of the lines and their places.
    """

    def runs(w: Column) -> Column:
        last = F.greatest(F.size(w) - 3, F.lit(0))
        three = lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(3)])
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.crc32(three(i).cast("binary")))

    own = met(lines, often, "left_anti").select("host", "fp", F.explode(let(words(F.col("raw")), runs)).alias("h"))
    least = [F.min(F.when(F.col("h") % SKETCH == j, F.col("h"))).alias(f"s{j}") for j in range(SKETCH)]
    slots = own.groupBy("host", "fp").agg(*least)
    order = F.array(F.xxhash64(F.sort_array(F.collect_set(F.struct("pos", "line")))))
    one = found.groupBy("host", "fp").agg(order.alias("order"))
    low = F.array_compact(F.array(*[f"s{j}" for j in range(SKETCH)]))
    return one.join(slots, ["host", "fp"], "left").select("host", "fp", F.when(F.size(low) > 0, low).otherwise(F.col("order")).alias("low"))


def hot_lines(found: DataFrame, low: DataFrame, most_docs: int) -> DataFrame:
    """(host, line) of the lines in ``found`` that more than ``most_docs`` distinct documents of a host hold.

    Texts that are near copies apart from common lines count as one document, so that copies do not make
    their own lines boilerplate: their sketches agree but for one hash in SKETCH with that of the same text,
    the least by hash of those that share a hash with them.
    """
    low = kept(low)
    each = low.select("host", "fp", part_of().alias("part"), F.explode("low").alias("h"))
    shared = each.groupBy("host", "h").agg(F.min("fp").alias("first"), F.count("*").alias("c")).where("c > 1").drop("c")
    leaders = low.select("host", F.col("fp").alias("first"), F.col("low").alias("first_low"))
    shared = in_parts(shared.join(leaders, ["host", "first"]))
    near = F.size(F.array_intersect("low", "first_low")) >= F.greatest(F.size("low"), F.size("first_low")) * (1 - 1 / SKETCH)
    met_first = each.join(shared, ["host", "h", "part"]).where(F.col("fp") != F.col("first"))
    label = met_first.join(low, ["host", "fp"]).where(near).groupBy("host", "fp").agg(F.min("first").alias("label"))
    held = found.select("host", "line", "fp").distinct().join(label, ["host", "fp"], "left")
    n = F.count_distinct(F.coalesce("label", "fp")).alias("n")
    return held.groupBy("host", "line").agg(n).where(F.col("n") > most_docs).drop("n")


def judge(docs: DataFrame, host: str = "source", most_docs: int = 30, least_left: float = 0.3, least_chars: int = 200,
          least_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """``docs`` with base (struct of counts), base_failed, hot (positions of boilerplate lines), kept.

    base_failed: fewer than ``least_words`` words, or more than ``most_repeated`` percent of them in
    repeated runs. Depleted: lines were removed and fewer than ``least_chars`` characters, or less
    than the share ``least_left`` of the characters of its lines, are left. kept: neither.

    ``docs`` has doc_id, text and the host column. Null text is empty; null hosts are one host; null
    and repeated ids and repeated rows get a verdict each; other columns stay, whatever their names (older
    base, base_failed, hot and kept are replaced). Very long texts are split into lines in their own
    task. An empty table gives an empty one.
    """
    docs = docs.drop("base", "base_failed", "hot", "kept")
    at = docs.columns.index(host)
    docs, columns = set_aside(docs, "doc_id", "text")
    text, at = F.coalesce("text", F.lit("")), F.col(docs.columns[at])
    keys = [digest(text).alias("fp"), F.coalesce(F.concat(F.lit("="), at), F.lit("")).alias("host")]
    texts = docs.select("doc_id", "text", *keys)
    lines = line_rows(texts, ["doc_id", "fp", "host"])
    often = lines.groupBy("host", "line").agg(F.count_distinct("fp").alias("n")).where(F.col("n") > most_docs)
    often = kept(often.select("host", "line"))
    found = kept(met(lines, often, "inner").select("doc_id", "fp", "host", "pos", "chars", "line"))
    hot = kept(hot_lines(found, sketches(line_rows(among(texts, found), ["doc_id", "fp", "host"]), often, found), most_docs))
    removed = met(found, hot, "inner").groupBy(F.col("doc_id").alias("id"), F.col("fp").alias("of"), F.col("host").alias("of_host")).agg(
        F.collect_set(F.struct("pos", "chars")).alias("cut")
    )
    own = docs.select("*", *keys, base_counts(F.col("text")).alias("base"), F.length(text).alias("n"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("fp") == F.col("of")) & (F.col("host") == F.col("of_host"))
    left = F.col("n") - F.aggregate("cut", F.lit(0), lambda a, x: a + x["chars"])
    depleted = F.coalesce((left < least_chars) | (left < least_left * F.col("n")), F.lit(False))
    n, repeated = F.col("base.n_words"), F.col("base.n_repeat_words")
    failed = (n < least_words) | (100 * repeated > most_repeated * n)
    return own.join(removed, same, "left").select(
        *columns, "base", failed.alias("base_failed"),
        F.coalesce(F.transform("cut", lambda x: x["pos"]), F.array().cast("array<int>")).alias("hot"),
        (~failed & ~depleted).alias("kept"),
    )


def clean(docs: DataFrame, host: str = "source", **limits) -> DataFrame:
    """The kept documents without their boilerplate lines; n_chars, if there is one, follows the text.

    All columns stay, whatever their names; nulls, repeated rows, long texts and empty tables as in ``judge``.
    """
    at = docs.columns.index(host)
    docs, columns = set_aside(docs, "doc_id", "text", "n_chars")
    judged = judge(docs, host=docs.columns[at], **limits).where("kept")
    cut = F.size("hot") > 0
    judged = judged.withColumn("text", F.when(cut, F.array_join(without(F.split("text", "\n", -1), F.col("hot")), "\n")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        n = F.when(cut, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        judged = judged.withColumn("n_chars", n)
    return judged.select(*columns)


def quality_digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", "base.*", "base_failed", "kept")
