"""Exact Jaccard self-join of word-shingle sets, size-aware: subsets for small sets, lists for large.

Two sets of n and m shingles link when they share at least 3 (n + m) / 7 of them (Jaccard 0.75).

* Equal sets are one set from the start.
* Light sets (fewer than ``boundary`` shingles) list all their subsets of the sizes that a link can
  need. Sets with a common subset of the needed size link, and linking each to the smallest set that
  lists the subset connects all of them: no pair is formed that is not a link.
* Heavy sets are found through inverted lists of the shingles that come first in hash order, as many
  that linked sets must share some. Lists are read by families of sets that are known to be connected
  (see below). A list of more than ``LONG`` families is not paired; instead its sets list more
  shingles than they need, so that a linked pair shares a shingle with a short list all the same. Sets
  for which that is not enough list all their shingles, and those that have one of their shortest lists
  in common, of as many as linked sets must share one of, are a group: there sets are told by what they
  differ in from a common core (``_long_links``). So no link is lost, whatever the lists' lengths.
* The boundary is where the counted cost of subsets exceeds that of lists.

Families come from a cheap first round: sets that share one of their four smallest hashes are
compared with the smallest set that has it. Later rounds ask first whether the first sets of two
families link, then whether a member links to the other's first set, and only then which members
may link, as far as the triangle inequality leaves that open.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.batches import utf8
from ledgerloom.llm.bits import bit_filter, passes
from ledgerloom.llm.graph import components
from ledgerloom.llm.native import digest, set_aside
from ledgerloom.llm.shingles import mixed, set_id, shingle_sets
from ledgerloom.llm.store import kept, small_batches

SIZE = 5
#: Smallest hashes of a set that the first round looks at.
LOW = 4
#: Most shingles of a set that may be treated as light.
TINY = 12
#: Most shingles of a set that lists all of them from the start.
SHORT = 24
#: Families that a list may hold and still be paired.
LONG = 32
#: Members that the core of a group of families in long lists is made of.
SAMPLE = 16


def needed(n: int, m: int) -> int:
    """Shingles that linked sets of n and m shingles share at least."""
    return -(-3 * (n + m) // 7)


def prefix(n: int) -> int:
    """So many first shingles of two linked sets have one in common."""
    return n - -(-3 * n // 4) + 1


def spare(n: int) -> int:
    """Further shingles that a set lists from the start; linked sets share one more for each.

    Sets of up to ``SHORT`` shingles list all of them.
    """
    p = prefix(n)
    return n - p if n <= SHORT else 8 + 3 * p // 20


def subset_sizes(n: int) -> range:
    """Sizes of common subsets that a link of a set of n shingles can need."""
    return range(needed(n, -(-3 * n // 4)), min(n, needed(n, 4 * n // 3)) + 1)


def subset_count(n: int) -> int:
    from math import comb

    return sum(comb(n, k) for k in subset_sizes(n))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, ends = utf8(batch.column("text"))
        sids, sizes, low = [], [], []
        for _, own in shingle_sets(raw, ends, SIZE):
            sids.append(set_id(own))
            sizes.append(len(own))
            low.append((own if len(own) <= TINY else own[:LOW]).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), batch.column("tid"), pa.array(sids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(low, pa.list_(pa.int64()))],
            ["doc_id", "digest", "tid", "sid", "n", "low"],
        )


def _chosen(batch: pa.RecordBatch, wanted) -> pa.RecordBatch:
    """The rows whose text is in a filter."""
    return batch.filter(pa.array(passes(wanted.value, batch.column("tid").to_numpy())))


def _sets(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            raw, ends = utf8(_chosen(batch, wanted).column("text"))
            sids, sets, size = [], [], 0
            for _, own in shingle_sets(raw, ends, SIZE):
                sid = set_id(own)
                if len(own) and sid not in seen:
                    seen.add(sid)
                    sids.append(sid)
                    sets.append(own.view(np.int64))
                    size += len(own)
                    if size > 1_000_000:
                        yield _set_batch(sids, sets)
                        sids, sets, size = [], [], 0
            if sids:
                yield _set_batch(sids, sets)

    return run


def _set_batch(sids: list, sets: list) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
    return pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), lists], ["sid", "set"])


def _text_filter(sets: DataFrame, sids: DataFrame):
    """A filter of one text for each of some sets."""
    return bit_filter(sets.join(sids.select("sid").distinct(), "sid", "left_semi").select("tid"))


def measure(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets with n_a, n_b and the number of shingles they ``share``.

    Only texts whose set is named by a pair are read in full. Pairs of a set that many pairs name are dealt to
    several tasks, each with a copy of that set.
    """
    pairs = kept(pairs.select("a", "b").distinct())
    named = pairs.select(F.explode(F.array("a", "b")).alias("sid"))
    sets = docs.mapInArrow(_sets(_text_filter(sets, named)), "sid long, set array<long>")
    sets = sets.join(named.distinct(), "sid", "left_semi")
    sets = kept(sets.groupBy("sid").agg(F.first("set").alias("set")))
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / 64).cast("int").alias("parts"))
    first = sets.withColumnsRenamed({"sid": "a", "set": "set_a"}).join(parts, "a")
    first = first.select("a", "set_a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    second = pairs.join(sets.withColumnsRenamed({"sid": "b", "set": "set_b"}), "b").join(parts, "a")
    second = second.withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")).drop("parts")
    met = second.join(first, ["a", "part"])
    share = F.size(F.array_intersect("set_a", "set_b"))
    return met.select("a", "b", F.size("set_a").alias("n_a"), F.size("set_b").alias("n_b"), share.alias("share"))


def linked() -> Column:
    return 175 * F.col("share") >= 75 * (F.col("n_a") + F.col("n_b"))


def _subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, sids, ns, os = [], [], [], []
        for sid, n, low in zip(*(batch.column(c).to_pylist() for c in ("sid", "n", "low"))):
            own = mixed(np.array(low, np.int64).view(np.uint64))
            for o in subset_sizes(n):
                for some in combinations(range(n), o):
                    keys.append(int((own[list(some)].sum() + np.uint64(o)).view(np.int64)))
                    sids.append(sid), ns.append(n), os.append(o)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, sids, ns, os)], ["key", "sid", "n", "o"])


def light_links(sets: DataFrame, boundary: int) -> DataFrame:
    """Links (a, b) that connect all linked sets of fewer than ``boundary`` shingles."""
    light = sets.where((F.col("n") > 0) & (F.col("n") < boundary)).select("sid", "n", "low")
    keys = light.mapInArrow(_subsets, "key long, sid long, n long, o long")
    least = keys.groupBy("key", "o").agg(F.min(F.struct("n", "sid")).alias("least"), F.count("*").alias("c")).where("c > 1")
    met = keys.join(least, ["key", "o"]).where(F.col("sid") != F.col("least.sid"))
    enough = F.ceil(3 * (F.col("n") + F.col("least.n")) / 7) <= F.col("o")
    return met.where(enough).select(F.col("sid").alias("a"), F.col("least.sid").alias("b")).distinct()


def choose_boundary(sets: DataFrame) -> int:
    """Where light work begins to cost more than list work, from counts of all sets by size.

    A light set costs its subsets; a heavy one its listed shingles, each times the mean number of
    sets that begin with the same shingle (what reading a list costs).
    """
    size = F.least("n", F.lit(TINY + 1))
    rows = (
        sets.where("n > 0").groupBy(size.alias("n"), F.get("low", F.lit(0)).alias("first")).agg(F.count("*").alias("c"))
        .groupBy("n").agg(F.sum("c").alias("sets"), F.sum(F.col("c") * F.col("c")).alias("met")).collect()
    )
    count = {r["n"]: (r["sets"], r["met"] / r["sets"]) for r in rows}

    def cost(x: int) -> float:
        light = sum(count.get(n, (0, 0))[0] * subset_count(n) for n in range(1, x))
        lists = sum(
            c * (prefix(n) + spare(n)) * mean for n, (c, mean) in count.items() if n <= TINY and n >= -(-3 * x // 4)
        )
        return light + lists

    return min(range(1, TINY + 2), key=cost)


def _listed(least_n: int, whole, some):
    """Rows (token, sid): the first shingles of each set, or all of them for the texts in ``whole``.

    With ``some``, first shingles that are not in that filter are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            raw, ends = utf8(batch.column("text"))
            tokens, sids, size = [], [], 0
            is_whole = passes(whole.value, batch.column("tid").to_numpy()) if whole is not None else np.zeros(batch.num_rows, bool)
            for row, own in shingle_sets(raw, ends, SIZE):
                n = len(own)
                if n < max(1, least_n):
                    continue
                sid = set_id(own)
                if sid in seen and not is_whole[row]:
                    continue
                seen.add(sid)
                if not is_whole[row]:
                    own = own[: prefix(n) + spare(n)]
                    if some is not None:
                        own = own[passes(some.value, own.view(np.int64))]
                tokens.append(own)
                sids.append(np.full(len(own), sid, np.int64))
                size += len(own)
                if size > 500_000:
                    yield _rows(tokens, sids)
                    tokens, sids, size = [], [], 0
            if size:
                yield _rows(tokens, sids)

    return run


def _rows(tokens: list, sids: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(sids))], ["token", "sid"]
    )


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, holder): those whose token has two holders or more.

    Equal rows become one, but a row may be written twice where a batch ends.
    """
    left = np.zeros((2, 0), np.int64)
    for batch in batches:
        rows = np.concatenate([left, [batch.column(c).to_numpy() for c in (0, 1)]], axis=1)
        new = np.ones(rows.shape[1], bool)
        new[1:] = (rows[:, 1:] != rows[:, :-1]).any(axis=0)
        rows = rows[:, new]
        same = rows[0, 1:] == rows[0, :-1]
        out = rows[:, np.concatenate([[False], same]) | np.concatenate([same, [False]])] if rows.shape[1] else rows
        if out.shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1])], batch.schema.names)
        left = rows[:, -1:]


def _pair_families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, family): pairs of families of short lists, hits of long ones.

    Pairs come as (a, b, times, 0), hits as (family, token, 0, 1); a list in progress keeps LONG + 1
    families at most.
    """
    names = ["a", "b", "times", "long"]
    token, held, is_long = None, [], False
    pairs: dict[tuple[int, int], int] = {}
    hits: list[tuple[int, int]] = []

    def close() -> None:
        if not is_long:
            for pair in combinations(held, 2):
                pairs[pair] = pairs.get(pair, 0) + 1

    def flush() -> pa.RecordBatch:
        rows = [(a, b, n, 0) for (a, b), n in pairs.items()] + [(f, t, 0, 1) for f, t in hits]
        pairs.clear(), hits.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)

    for batch in batches:
        for t, f in zip(batch.column("token").to_pylist(), batch.column("family").to_pylist()):
            if t != token:
                close()
                token, held, is_long = t, [f], False
            elif is_long:
                if f != held[-1]:
                    hits.append((f, t))
                    held = [f]
            elif f != held[-1]:
                held.append(f)
                if len(held) > LONG:
                    is_long = True
                    hits += [(x, t) for x in held]
                    held = [f]
            if len(pairs) + len(hits) > 200_000:
                yield flush()
    close()
    if pairs or hits:
        yield flush()


def _tokens(whole):
    """All shingles of the texts in ``whole``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, ends = utf8(_chosen(batch, whole).column("text"))
            for _, own in shingle_sets(raw, ends, SIZE):
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64))], ["token"])

    return run


def _lists(docs: DataFrame, families: DataFrame, least_n: int, whole, some) -> DataFrame:
    """One reading of the lists: see ``_pair_families``. ``families`` has node and label."""

    def gathered(rows: DataFrame, holder: str) -> DataFrame:
        rows = rows.repartition("token").sortWithinPartitions("token", holder)
        return rows.mapInArrow(_shared, f"token long, {holder} long")

    held = gathered(docs.mapInArrow(_listed(least_n, whole, some), "token long, sid long"), "sid")
    held = held.join(families, F.col("sid") == F.col("node"), "left")
    held = gathered(held.select("token", F.coalesce("label", "sid").alias("family")), "family")
    return kept(held.mapInArrow(_pair_families, "a long, b long, times long, long long"))


def _candidates(docs: DataFrame, sets: DataFrame, families: DataFrame, least_n: int) -> tuple[DataFrame, DataFrame | None]:
    """Pairs of families that may hold a link that is not known yet, and links of families that meet in long lists only."""
    n = F.col("n")
    first = (n - F.floor((3 * n + 3) / 4) + 1).cast("long")
    own = sets.where(n >= max(1, least_n)).join(families, F.col("sid") == F.col("node"), "left")
    own = own.select("sid", F.coalesce("label", "sid").alias("family"), "n", first.alias("p"))
    rest = F.col("n") - F.col("p")
    some = F.when(F.col("n") <= SHORT, rest).otherwise(8 + F.floor(3 * F.col("p") / 20))
    stats = kept(own.groupBy("family").agg(
        F.min(some).alias("some"), F.min(rest).alias("all"), F.min("n").alias("least"), F.max("n").alias("most"), F.max("p").alias("p"),
    ))
    found = _lists(docs, families, least_n, None, None)
    whole = None  # families whose sets list all their shingles
    while True:
        hits = found.where("long = 1").select(F.col("a").alias("family"), F.col("b").alias("token")).distinct()
        slack = stats.join(hits.groupBy("family").agg(F.count("*").alias("hit")), "family", "left")
        if whole is not None:
            slack = slack.join(whole.withColumn("is_whole", F.lit(True)), "family", "left")
        else:
            slack = slack.withColumn("is_whole", F.lit(None).cast("boolean"))
        listed = F.when(F.col("is_whole"), F.col("all")).otherwise(F.col("some"))
        hit = F.coalesce("hit", F.lit(0))
        missing = F.col("p") - (F.col("least") - hit)  # first shingles that only long lists have
        slack = kept(slack.select("family", "least", "most", "is_whole", (listed - hit).alias("slack"), missing.alias("missing")))
        more = slack.where((F.col("slack") < 0) & F.col("is_whole").isNull()).select("family")
        if more.isEmpty():
            break
        whole = kept(more if whole is None else whole.union(more))
        named = _text_filter(sets, own.join(whole, "family", "left_semi"))
        tokens = bit_filter(docs.mapInArrow(_tokens(named), "token long"))
        found = kept(found.union(_lists(docs, families, least_n, named, tokens)))
    pairs = found.where("long = 0").groupBy("a", "b").agg(F.sum("times").alias("times"))
    hard = slack.where("slack < 0 AND missing > 0").select("family", "missing")
    links = None
    if not hard.isEmpty():
        length = hits.groupBy("token").agg(F.count("*").alias("length"))
        theirs = hits.join(hard, "family").join(length, "token")
        rarest = F.row_number().over(Window.partitionBy("family").orderBy("length", "token"))
        theirs = kept(theirs.withColumn("rank", rarest).where(F.col("rank") <= F.col("missing")).select("token", "family"))
        links = _long_links(docs, sets, own, theirs)
    side = slack.drop("is_whole", "missing")
    for end in ("a", "b"):
        pairs = pairs.join(side.select(F.col("family").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("least", "most", "slack")]), end)
    enough = F.col("times") >= 1 + F.greatest(F.lit(0), F.least("slack_a", "slack_b"))
    fits = (4 * F.col("most_a") >= 3 * F.col("least_b")) & (4 * F.col("most_b") >= 3 * F.col("least_a"))
    return kept(pairs.where(enough & fits).select("a", "b")), links


def _long_links(docs: DataFrame, sets: DataFrame, own: DataFrame, theirs: DataFrame) -> DataFrame:
    """Links (a, b) that connect the families of ``theirs`` (token, family) that have a token in common and hold a linked pair.

    Families that tokens connect make a group. Its core has the shingles of most of ``SAMPLE`` members, taken by hash;
    any core would do. Of each member only the difference from the core is kept, d shingles that one of the two lacks.
    Sets of n and m shingles differ in d_x + d_y - 2 c, where c is what the differences have in common, and link when
    that is at most (n + m) / 7. With e = 7 d - n this is 14 c >= e_x + e_y. Where e_x + e_y is 0 or less they link, and so
    do both with the member of the least e: a star says it all. Others need common shingles in their
    differences. These are read rarest first, and two members meet only where enough can still follow.
    """
    groups = components(theirs.select(F.col("family").alias("a"), F.xxhash64("token").alias("b")))
    members = own.join(theirs.select("family").distinct(), "family", "left_semi").select("sid", "family", "n")
    members = kept(members.join(groups.select(F.col("node").alias("family"), F.col("label").alias("key")), "family"))
    full = docs.mapInArrow(_sets(_text_filter(sets, members)), "sid long, set array<long>").join(members.select("sid"), "sid", "left_semi")
    full = kept(full.groupBy("sid").agg(F.first("set").alias("set")))

    h = F.xxhash64("sid")
    some = members.groupBy("key", F.pmod(h, F.lit(SAMPLE)).alias("slot")).agg(F.min(F.struct(h.alias("h"), "sid")).alias("x"))
    some = some.select("key", F.col("x.sid").alias("sid"))
    size = some.groupBy("key").agg(F.count("*").alias("size"))
    core = some.join(full, "sid").select("key", F.explode("set").alias("s")).groupBy("key", "s").agg(F.count("*").alias("c"))
    core = core.join(size, "key").where("2 * c > size").groupBy("key").agg(F.collect_list("s").alias("core"))
    parts = members.groupBy("key").agg(F.ceil(F.count("*") / 64).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int")
    core = parts.join(core, "key", "left").select("key", F.coalesce("core", F.array().cast("array<long>")).alias("core"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    told = members.join(full, "sid").join(parts, "key").withColumn("part", part).drop("parts").join(core, ["key", "part"])
    told = told.withColumn("diff", F.concat(F.array_except("set", "core"), F.array_except("core", "set")))
    told = kept(told.select("key", "sid", "family", (7 * F.size("diff") - F.col("n")).alias("e"), "diff"))

    slim = told.select("key", "sid", "family", "e")
    least = kept(slim.groupBy("key").agg(F.min(F.struct("e", "sid", "family")).alias("x")))
    star = slim.join(least, "key").where((F.col("e") + F.col("x.e") <= 0) & (F.col("family") != F.col("x.family")))
    star = kept(star.select(F.col("x.sid").alias("a"), F.col("sid").alias("b")))

    listed = told.select("key", "sid", "family", "e", F.explode("diff").alias("s"))
    often = listed.groupBy("key", "s").agg(F.count("*").alias("c"), F.min("family").alias("x"), F.max("family").alias("y")).where("x < y")
    by_own = Window.partitionBy("key", "sid")
    listed = listed.join(often.select("key", "s", "c"), ["key", "s"])
    listed = listed.withColumns({"place": F.row_number().over(by_own.orderBy("c", "s")), "shared": F.count("*").over(by_own)})
    # How many of the member's shingles that others have come from this one on.
    listed = listed.withColumn("rest", F.col("shared") - F.col("place") + 1).join(least.select("key", F.col("x.e").alias("least")), "key")
    listed = kept(listed.where("14 * rest >= e + least").select("key", "s", "sid", "family", "e", "rest"))
    other = listed.select("key", "s", *[F.col(c).alias(f"{c}_y") for c in ("sid", "family", "e", "rest")])
    sums = F.col("e") + F.col("e_y")
    met = listed.join(other, ["key", "s"]).where((F.col("sid") < F.col("sid_y")) & (F.col("family") != F.col("family_y")) & (sums > 0) & (14 * F.least("rest", "rest_y") >= sums))
    met = kept(met.select("key", F.col("sid").alias("a"), F.col("sid_y").alias("b"), sums.alias("least")).distinct())
    for end in ("a", "b"):
        met = met.join(told.select("key", F.col("sid").alias(end), F.col("diff").alias(f"diff_{end}")), ["key", end])
    links = met.where(14 * F.size(F.array_intersect("diff_a", "diff_b")) >= F.col("least")).select("a", "b")
    return kept(star.union(links))


def _distance() -> Column:
    return 1 - F.col("share") / (F.col("n_a") + F.col("n_b") - F.col("share"))


def _family_links(docs: DataFrame, sets: DataFrame, families: DataFrame, candidates: DataFrame, known: DataFrame) -> list[DataFrame]:
    """Links that connect those candidate families that hold a linked pair; ``known`` are all links so far."""
    if candidates.isEmpty():
        return []
    asked = kept(measure(docs, sets, candidates))
    out = [asked.where(linked()).select("a", "b")]
    open_pairs = asked.where(~linked()).select("a", "b")
    merged = kept(components(known.union(out[0])))  # families that are one by now need no more asking
    for end in ("a", "b"):
        open_pairs = open_pairs.join(merged.select(F.col("node").alias(end), F.col("label").alias(f"l{end}")), end, "left")
    open_pairs = kept(open_pairs.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b"))
    both = open_pairs.select(F.col("a").alias("own"), F.col("b").alias("other"))
    both = both.union(both.select("other", "own"))
    members = families.where("node != label").withColumnsRenamed({"node": "m", "label": "own"})
    asks = kept(members.join(both, "own").select("m", "own", "other"))
    if asks.isEmpty():
        return out
    # Members against the first set of the other family, and against their own for the triangle.
    told = measure(docs, sets, asks.select(F.col("other").alias("a"), F.col("m").alias("b")).union(asks.select(F.col("own").alias("a"), F.col("m").alias("b"))))
    told = kept(told.withColumn("d", _distance()))
    out.append(told.where(linked()).select("a", "b"))
    near = told.select(F.col("a").alias("to"), F.col("b").alias("m"), "d")
    known = asks.join(near.withColumnsRenamed({"to": "other", "d": "d_other"}), ["other", "m"])
    known = known.join(near.withColumnsRenamed({"to": "own", "d": "d_own"}), ["own", "m"])
    # Also the first set of each family, at distance 0 from its own.
    left, right = (
        known.select(F.col("own" if x == "a" else "other").alias("a"), F.col("other" if x == "a" else "own").alias("b"),
                     F.col("m").alias(f"m{x}"), F.col("d_other").alias(f"far{x}"), F.col("d_own").alias(f"near{x}"))
        for x in ("a", "b")
    )
    may = (F.abs(F.col("fara") - F.col("nearb")) <= 0.2500001) & (F.abs(F.col("farb") - F.col("neara")) <= 0.2500001)
    rest = left.join(right, ["a", "b"]).where(may & (F.col("a") < F.col("b"))).select(F.col("ma").alias("a"), F.col("mb").alias("b"))
    rest = kept(rest.distinct())
    if not rest.isEmpty():
        out.append(measure(docs, sets, rest).where(linked()).select("a", "b"))
    return out


def link_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n_shingles, label, component_id) of every document.

    A document's set holds its distinct runs of five words, A-Z lower-cased; a text of fewer words has
    its whole sequence as one run. Documents link at a Jaccard similarity of 0.75 or more;
    component_id is the smallest doc_id that can be reached by links. Null, empty and blank texts have
    no shingles and are linked with nothing. Rows with a null id take part and get the component of
    their text; repeated ids and repeated rows get a row each. Other columns are ignored. An empty
    table gives no rows. Shingles and sets are told apart by 64-bit hashes.
    """
    with small_batches(docs.sparkSession):
        return _link(docs)


def _link(docs: DataFrame) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    described = docs.select("doc_id", digest(F.col("text")).alias("digest"), F.xxhash64("text").alias("tid"), "text")
    info = kept(described.mapInArrow(_describe, f"doc_id {kind}, digest binary, tid long, sid long, n long, low array<long>"))
    sets = kept(info.where("n > 0").groupBy("sid").agg(F.max("n").alias("n"), F.min("tid").alias("tid"), F.first("low").alias("low")))
    docs = docs.select(F.xxhash64("text").alias("tid"), "text").where(F.col("text").isNotNull())
    boundary = choose_boundary(sets)
    least_n = -(-3 * boundary // 4)
    links = [light_links(sets, boundary)]

    starts = sets.where(F.col("n") >= least_n).select("sid", "n", F.explode(F.slice("low", 1, LOW)).alias("token"))
    least = starts.groupBy("token").agg(F.min(F.struct("sid", "n")).alias("x"), F.count("*").alias("c")).where("c > 1")
    met = starts.join(least, "token").where((F.col("sid") != F.col("x.sid")) & (4 * F.col("n") >= 3 * F.col("x.n")) & (4 * F.col("x.n") >= 3 * F.col("n")))
    links.append(measure(docs, sets, met.select(F.col("x.sid").alias("a"), F.col("sid").alias("b"))).where(linked()).select("a", "b"))
    links = [kept(links[0].union(links[1]))]
    families = components(links[0])

    candidates, long_links = _candidates(docs, sets, families, least_n)
    if long_links is not None:
        links[0] = links[0].union(long_links)
    links += _family_links(docs, sets, families, candidates, links[0])
    for more in links[1:]:
        links[0] = links[0].union(more)
    final = components(links[0])

    known = info.groupBy("sid").agg(F.min("doc_id").alias("least")).join(final, F.col("sid") == F.col("node"), "left")
    known = kept(known.select("sid", F.coalesce("label", "sid").alias("label"), "least"))
    least = known.groupBy("label").agg(F.min("least").alias("component_id"))
    known = known.join(least, "label").select("sid", "label", "component_id")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return info.join(known, "sid").select("doc_id", "digest", F.col("n").alias("n_shingles"), "label", component.alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of each group: the smallest id, null last; of rows that share it, one.

    Documents without shingles (null, empty, blank) all stay, repeated rows of them too. Other columns stay,
    whatever their names. An empty table gives an empty one.
    """
    docs, columns = set_aside(docs, "doc_id", "text")
    linked_rows = link_documents(docs)
    id_and_text = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    chosen = linked_rows.where("n_shingles > 0").groupBy("label").agg(F.min(id_and_text).alias("x"))
    stay = chosen.select(F.col("x.doc_id").alias("id"), F.col("x.digest").alias("of"), F.lit(False).alias("every"))
    bare = linked_rows.where("n_shingles = 0").select("doc_id", "digest", F.lit(True)).distinct()
    rows = docs.select("*", digest(F.col("text")).alias("digest"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & F.col("digest").eqNullSafe(F.col("of"))
    rows = rows.join(stay.union(bare), same)
    no = F.row_number().over(Window.partitionBy("doc_id", "digest").orderBy("doc_id"))
    return rows.withColumn("no", no).where((F.col("no") == 1) | F.col("every")).select(*columns)
