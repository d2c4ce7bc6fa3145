"""Near duplicates by MinHash: many universal hash minima, bands, signature verification, components.

A text's set holds the hashes of its runs of ``SIZE`` words. Each of ``HASHES`` universal hash functions gives
the set's minimum; ``ROWS`` minima in a row make one of ``BANDS`` band keys, and two sets meet where a key
agrees. Two sets of a similarity of 0.8 miss each other in all bands with a chance of 3 in a million.

* Equal sets are one set from the start.
* Sets of one key meet the key's first set only (a star, no pairs among themselves). The share of equal minima
  estimates their similarity. Sets connected by stars that are likely links make a neighbourhood.
* Sets of one key in different neighbourhoods are unlike the same first set. Those outside the key's largest
  neighbourhood meet the others; where they are many, the key is split by all other bands first, which unlike sets
  seldom share. What turns out to be likely joins neighbourhoods, so that any two sets that can link are in one.
* Likely links are confirmed on full sets, first each set with its most similar one, then those between components.
* What is left are neighbourhoods of several components. Small ones are compared in full. In a large one, a core
  (the shingles that most of a few members hold) rules pairs out: sets x and y share at most min(|x and core|,
  |y and core|) shingles and those that both have beyond the core, so only pairs with common shingles
  beyond the core, or with enough in it for their sizes, can link. This holds for any core.
* Components come from alternating large-star and small-star rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.batches import pieces, utf8
from ledgerloom.llm.bits import bit_filter, passes
from ledgerloom.llm.graph import components
from ledgerloom.llm.native import digest
from ledgerloom.llm.shingles import STEP, TURN, mixed, set_id, shingle_sets
from ledgerloom.llm.store import kept, release

SIZE = 4
#: Percent of the union that linked sets share at least.
LIKE = 80
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
#: Equal minima of two sets that may link: six standard deviations below what a similarity of 0.8 gives.
LEAST = int(HASHES * LIKE / 100 - 6 * (HASHES * 0.16) ** 0.5)
#: Equal minima that make neighbours: loose, so that what stays apart is so unlike that few bands agree.
LOOSE = int(HASHES * 0.35)
#: Sets of a key outside its largest group beyond which the key is split by other bands, and how often that is done.
STRAYS, DEPTH = 8, 2
#: Members of a neighbourhood up to which it is compared in full, and members that its core is made of.
FEW, SAMPLE = 32, 16
#: Links of one set that a task works on with one copy of that set.
PART = 64

_random = np.random.Generator(np.random.Philox(key=11))
#: The hash functions x -> a x + b modulo 2^64, a odd; compared by value, so by their high bits first.
A = _random.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
B = _random.integers(0, 2**64, HASHES, dtype=np.uint64)


def minima(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(HASHES, sets) minima of sets of hashes that follow one another and begin at ``starts``, none empty."""
    out = np.empty((HASHES, len(starts)), np.uint64)
    room = np.empty_like(x)
    for k in range(HASHES):
        np.multiply(x, A[k], out=room)
        room += B[k]
        np.minimum.reduceat(room, starts, out=out[k])
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    """(sets, BANDS) keys."""
    keys = np.zeros((BANDS, low.shape[1]), np.uint64)
    for r in range(ROWS):
        keys = mixed(keys + low[r::ROWS] * STEP)
    return mixed(keys + np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * TURN).T


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, ends = utf8(batch.column("text"))
        for lo, hi in pieces(ends):
            sets = [own for _, own in shingle_sets(raw, ends[lo : hi + 1], SIZE)]
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            sids = np.zeros(hi - lo, np.int64)
            signs, keys = [b""] * (hi - lo), [[]] * (hi - lo)
            if len(full):
                low = minima(np.concatenate(sets), np.concatenate([[0], np.cumsum(sizes[full])[:-1]]))
                short = np.ascontiguousarray((mixed(low) >> np.uint64(56)).astype(np.uint8).T)
                bands = band_keys(low).view(np.int64)
                for k, i in enumerate(full):
                    sids[i], signs[i], keys[i] = set_id(sets[i]), short[k].tobytes(), bands[k]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).slice(lo, hi - lo) for c in ("doc_id", "digest", "tid")), pa.array(sids), pa.array(sizes, pa.int64()),
                 pa.array(signs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "digest", "tid", "sid", "n", "sign", "keys"],
            )


def _sets(wanted):
    """The full sets of texts that pass a filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(passes(wanted.value, batch.column("tid").to_numpy())))
            raw, ends = utf8(batch.column("text"))
            for lo, hi in pieces(ends):
                sets = [own for _, own in shingle_sets(raw, ends[lo : hi + 1], SIZE)]
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64) if offsets[-1] else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_id(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], ["sid", "set"]
                )

    return run


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, agree, fits) of those pairs of which LOOSE minima agree; ``fits``: the sizes allow a link."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("sign_a", "sign_b"))
        agree = (a == b).sum(axis=1)
        columns = [batch.column("a"), batch.column("b"), pa.array(agree), batch.column("fits")]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "agree", "fits"]).filter(pa.array(agree >= LOOSE))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, agree, fits) of the pairs whose signatures make them neighbours."""
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("sid").alias(end), F.col("n").alias(f"n_{end}"), F.col("sign").alias(f"sign_{end}")), end)
    fits = (100 * F.col("n_a") >= LIKE * F.col("n_b")) & (100 * F.col("n_b") >= LIKE * F.col("n_a"))
    told = pairs.select("a", "b", "sign_a", "sign_b", fits.alias("fits"))
    return kept(told.mapInArrow(_agreeing, "a long, b long, agree long, fits boolean"))


def may_link() -> Column:
    return F.col("fits") & (F.col("agree") >= LEAST)


def full_sets(sids: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(sid, set) of the sets named in ``sids``; only texts that have one of them are read in full."""
    sids = kept(sids.select("sid").distinct())
    wanted = bit_filter(sets.join(sids, "sid", "left_semi").select("tid"))
    full = docs.mapInArrow(_sets(wanted), "sid long, set array<long>").join(sids, "sid", "left_semi")
    return kept(full.groupBy("sid").agg(F.first("set").alias("set")))


def met_in_parts(many: DataFrame, one: DataFrame, key: str, other: str) -> DataFrame:
    """``many`` with the columns of ``one`` (unique in ``key``), which is copied for every PART rows of a key."""
    parts = many.groupBy(key).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    one = one.join(parts, key).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    many = many.join(parts, key).withColumn("part", F.pmod(F.xxhash64(other), F.col("parts")).cast("int")).drop("parts")
    return many.join(one, [key, "part"]).drop("part")


def confirmed(pairs: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets link."""
    pairs = kept(pairs.select("a", "b"))
    full = full_sets(pairs.select(F.explode(F.array("a", "b")).alias("sid")), docs, sets)
    right = pairs.join(full.select(F.col("sid").alias("b"), F.col("set").alias("set_b")), "b")
    met = met_in_parts(right, full.select(F.col("sid").alias("a"), F.col("set").alias("set_a")), "a", "b")
    share = F.size(F.array_intersect("set_a", "set_b"))
    linked = 100 * share >= LIKE * (F.size("set_a") + F.size("set_b") - share)
    links = kept(met.where(linked).select("a", "b"))
    del right, full, met
    release(docs.sparkSession)
    return links


def _with_label(rows: DataFrame, labels: DataFrame, of: str, name: str) -> DataFrame:
    told = labels.select(F.col("node").alias(of), F.col("label").alias("_label"))
    return rows.join(told, of, "left").withColumn(name, F.coalesce("_label", of)).drop("_label")


def across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are in different components."""
    return _with_label(_with_label(pairs, labels, "a", "la"), labels, "b", "lb").where("la <> lb").drop("la", "lb")


def mains(rows: DataFrame) -> DataFrame:
    """(key, main, strays) of the keys of ``rows`` (key, sid, label) that hold several labels; main is the most frequent."""
    of = rows.groupBy("key", "label").agg(F.count("*").alias("c"))
    of = of.groupBy("key").agg(F.sum("c").alias("all"), F.max(F.struct("c", "label")).alias("most"), F.count("*").alias("labels"))
    return of.where("labels > 1").select("key", F.col("most.label").alias("main"), (F.col("all") - F.col("most.c")).alias("strays"))


def met_strays(rows: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of sets with one key and different labels; ``rows`` is (key, sid, label, main)."""
    stray = rows.where("label <> main").select("key", F.col("sid").alias("x"), F.col("label").alias("lx"))
    met = stray.join(rows.select("key", F.col("sid").alias("y"), F.col("label").alias("ly"), "main"), "key")
    met = met.where((F.col("lx") != F.col("ly")) & ((F.col("ly") == F.col("main")) | (F.col("x") < F.col("y"))))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def star_pairs(rows: DataFrame) -> DataFrame:
    """(a, b) of the first set a of each key of ``rows`` (key, sid, label) with its sets b of another label."""
    first = rows.groupBy("key").agg(F.min(F.struct("sid", "label")).alias("first"), F.max("label").alias("x"), F.min("label").alias("y"))
    met = rows.join(first.where("x <> y").drop("x", "y"), "key").where(F.col("first.label") != F.col("label"))
    return met.select(F.least("first.sid", "sid").alias("a"), F.greatest("first.sid", "sid").alias("b")).distinct()


def neighbours(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, agree, fits), a < b, that connect any two sets with a common key in ``rows`` (key, sid) that can link.

    Stars come first. Of a key with few sets outside the largest neighbourhood, these meet all others; one with many
    is split by the further bands, in which linked sets agree in about ten places and unlike ones hardly anywhere,
    and stars of the parts come next. What is still large after DEPTH splits is compared as it is.
    """
    rows = kept(rows.select("key", "sid", F.col("key").alias("last"), F.col("sid").alias("label")))
    known = kept(star_pairs(rows))
    found = verified(known, sets)
    out = []
    for depth in range(DEPTH + 1):
        rows = _with_label(rows.select("key", "sid", "last"), components(found), "sid", "label")
        many = F.lit(False) if depth == DEPTH else F.col("strays") > STRAYS
        rows = kept(rows.join(mains(rows).withColumn("many", many).drop("strays"), "key"))
        out.append(kept(met_strays(rows.where(~F.col("many"))).distinct()))
        rows = rows.where("many")
        if depth == DEPTH or rows.isEmpty():
            break
        rows = rows.join(sets.select("sid", "keys"), "sid")
        # Bands in one order, so that sets which share several are split by them once.
        rows = rows.select("sid", "label", "key", F.explode(F.filter("keys", lambda k: k > F.col("last"))).alias("last"))
        rows = rows.select(F.xxhash64("key", "last").alias("key"), "sid", "last", "label")
        alone = rows.groupBy("key").agg(F.max("label").alias("x"), F.min("label").alias("y")).where("x <> y").select("key")
        rows = kept(rows.join(alone, "key"))
        more = kept(star_pairs(rows).join(known, ["a", "b"], "left_anti"))
        known = kept(known.union(more))
        found = kept(found.union(verified(more, sets)))
    pairs = out[0]
    for more in out[1:]:
        pairs = pairs.union(more)
    return kept(found.union(verified(pairs.distinct().join(known, ["a", "b"], "left_anti"), sets)))


def against_core(members: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Members (key, sid) of neighbourhoods with the size ``n`` of their set, ``s`` of it in the core, ``more`` beyond it, ``core_n``.

    The core has the shingles of most of SAMPLE members, taken by hash; any other would do.
    """
    members = kept(members)
    full = full_sets(members, docs, sets)
    h = F.xxhash64("sid", F.lit(1))
    some = members.groupBy("key", F.pmod(h, F.lit(SAMPLE)).alias("slot")).agg(F.min(F.struct(h.alias("h"), "sid")).alias("x"))
    some = some.select("key", F.col("x.sid").alias("sid"))
    size = some.groupBy("key").agg(F.count("*").alias("size"))
    held = some.join(full, "sid").select("key", F.explode("set").alias("e")).groupBy("key", "e").agg(F.count("*").alias("c"))
    core = held.join(size, "key").where("2 * c > size").groupBy("key").agg(F.collect_list("e").alias("core"))
    core = size.select("key").join(core, "key", "left").select("key", F.coalesce("core", F.array().cast("array<long>")).alias("core"))
    told = met_in_parts(members.join(full, "sid"), core, "key", "sid")
    return kept(told.select(
        "key", "sid", F.size("set").alias("n"), F.size(F.array_intersect("set", "core")).alias("s"),
        F.array_except("set", "core").alias("more"), F.size("core").alias("core_n"),
    ))


def centre_pairs(told: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b) of the member nearest to each core with all members of other components that may link to it."""
    slim = _with_label(told.drop("more"), labels, "sid", "label")
    near = F.col("s") / (F.col("n") + F.col("core_n") - F.col("s"))
    first = slim.groupBy("key").agg(F.max(F.struct(near.alias("near"), "sid", "label", "n")).alias("x")).select("key", "x.*")
    first = first.select("key", F.col("sid").alias("a"), F.col("label").alias("la"), F.col("n").alias("n_a"))
    fits = (100 * F.col("n_a") >= LIKE * F.col("n")) & (100 * F.col("n") >= LIKE * F.col("n_a"))
    met = slim.join(first, "key").where(fits & (F.col("la") != F.col("label")))
    return met.select(F.least("a", "sid").alias("a"), F.greatest("a", "sid").alias("b"))


def open_pairs(told: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of one neighbourhood and different components that the core leaves open."""
    rows = _with_label(told, labels, "sid", "label")
    rows = kept(rows.join(mains(rows).drop("strays"), "key"))
    slim = rows.drop("more")

    # With enough in the core: 9 * share >= 4 (n + m) for some share <= s, whatever lies beyond the core.
    room = 9 * F.col("s") - 4 * F.col("n")
    least = slim.groupBy("key").agg(F.min("n").alias("least"))
    near = slim.withColumn("room", room).join(least, "key").where(F.col("room") >= 4 * F.col("least")).drop("least", "s")
    near = kept(near)
    x = near.where("label <> main").select("key", *[F.col(c).alias(f"{c}_x") for c in ("sid", "label", "n", "room")])
    inside = x.join(near, "key").where("label <> label_x AND room_x >= 4 * n AND room >= 4 * n_x AND (label = main OR sid_x < sid)")
    inside = inside.select(F.least("sid", "sid_x").alias("a"), F.greatest("sid", "sid_x").alias("b"))

    # With common shingles beyond it: a link needs ``need`` of them, so one of the |more| - need + 1 rarest is common.
    least_other = F.greatest(F.col("least"), F.ceil(LIKE * F.col("n") / 100))
    need = F.greatest(F.lit(1), F.ceil(4 * (F.col("n") + least_other) / 9) - F.col("s"))
    sides = rows.join(least, "key").select("key", "sid", "label", "main", "n", "s", F.size("more").alias("m"), need.alias("need"), "more")
    sides = sides.where("need <= m")
    more = kept(sides.select("key", "sid", "label", "main", (F.col("m") - F.col("need") + 1).alias("listed"), "m", F.explode("more").alias("e")))
    held = more.groupBy("key", "e").agg(F.count("*").alias("c"), F.min("label").alias("x"), F.max("label").alias("y")).where("c > 1")
    own = Window.partitionBy("key", "sid")
    more = more.join(held, ["key", "e"])
    alone = F.col("m") - F.count("*").over(own)  # shingles that no other member has are the rarest
    place = F.row_number().over(own.orderBy("c", "e"))
    more = more.withColumn("place", alone + place).where("place <= listed AND x <> y")
    more = kept(more.select(F.xxhash64("key", "e").alias("key"), "sid", "label"))
    beyond = met_strays(more.join(mains(more).drop("strays"), "key")).distinct()
    for end in ("a", "b"):
        beyond = beyond.join(sides.select(F.col("sid").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in "nsm"]), end)
    share = F.least("s_a", "s_b") + F.least("m_a", "m_b")
    beyond = beyond.where(9 * share >= 4 * (F.col("n_a") + F.col("n_b")))
    return inside.union(beyond.select("a", "b")).distinct()


def link_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n_shingles, label, component_id, kept) of every row of ``docs``; digest is that of the text.

    A set holds the distinct runs of four words, A-Z lower-cased; fewer words are one run. Documents
    link at a Jaccard similarity of 0.8 or more; component_id is the smallest doc_id reachable, null
    last, and ``kept`` says that it is the row's own. Null, empty and blank texts have no set and are linked
    with nothing. Null and repeated ids and repeated rows get a row each; other columns are ignored,
    whatever their names. A very long text is worked on alone. An empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"), F.xxhash64("text").alias("tid"), "text")
    schema = f"doc_id {kind}, digest binary, tid long, sid long, n long, sign binary, keys array<long>"
    info = kept(rows.mapInArrow(_describe, schema))
    sets = kept(info.where("n > 0").select("sid", "n", "tid", "sign", "keys").dropDuplicates(["sid"]))
    texts = docs.select(F.xxhash64("text").alias("tid"), "text").where(F.col("text").isNotNull())

    rows = sets.select("sid", F.explode("keys").alias("key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    found = neighbours(rows.join(shared, "key"), sets)
    around = kept(components(found))
    likely = kept(found.where(may_link()).select("a", "b", "agree"))
    both = likely.union(likely.select(F.col("b"), F.col("a"), "agree"))
    best = both.groupBy("b").agg(F.max(F.struct("agree", "a")).alias("x"))
    best = kept(best.select(F.least("x.a", "b").alias("a"), F.greatest("x.a", "b").alias("b")).distinct())
    links = confirmed(best, texts, sets)
    labels = kept(components(links))

    def linked(more: DataFrame) -> None:
        """Confirms pairs between components and joins these."""
        nonlocal links, labels
        more = kept(across(more, labels).distinct())
        if not more.isEmpty():
            links = kept(links.union(confirmed(more, texts, sets)))
            labels = kept(components(links))

    linked(likely.join(best, ["a", "b"], "left_anti"))
    members = around.select(F.col("label").alias("key"), F.col("node").alias("sid"))
    held = _with_label(members, labels, "sid", "label")
    held = kept(held.join(mains(held).drop("strays"), "key"))
    size = held.groupBy("key").agg(F.count("*").alias("size"))
    held = kept(held.join(size, "key"))
    told = against_core(held.where(F.col("size") > FEW).select("key", "sid"), texts, sets)
    linked(centre_pairs(told, labels))
    left = met_strays(held.where(F.col("size") <= FEW)).union(open_pairs(told, labels))
    left = left.join(likely.select("a", "b"), ["a", "b"], "left_anti")
    linked(verified(left, sets).where(may_link()).select("a", "b"))

    known = _with_label(info.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("least")), labels, "sid", "label")
    known = kept(known)
    least = known.groupBy("label").agg(F.min("least").alias("component"))
    known = known.join(least, "label").select("sid", "label", "component")
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    told = info.join(known, "sid", "left").select("doc_id", "digest", F.col("n").alias("n_shingles"), "label", own.alias("component_id"))
    return told.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that are not the first of their component; all columns stay, whatever their names.

    Of rows that share the first id, all with a text of the component stay; documents without a set stay.
    """
    told = link_documents(docs).where("kept").select(F.col("doc_id").alias("id"), F.col("digest").alias("own")).distinct()
    rows = docs.select("doc_id", digest(F.col("text")).alias("digest"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("digest").eqNullSafe(F.col("own"))
    return rows.join(told, same, "left_semi").select("row.*")
