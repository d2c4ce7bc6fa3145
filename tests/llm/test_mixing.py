"""Targets of the mix against the level they stand for, found in another way, with exact fractions."""

import re
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import SF
from ledgerloom.llm import mixing, queries


def levelled(sizes, weights, total, most=3):
    """min(most * size, level * weight) for the one level at which the targets add up to ``total``.

    The sum grows with the level, piece by piece linearly: the source that fills next ends a piece.
    """
    at = sorted((Fraction(most * s, w), s, w) for s, w in zip(sizes, weights))
    filled, open_weight = 0, sum(weights)
    for level, s, w in at:
        if filled + level * open_weight >= total:
            break
        filled += most * s
        open_weight -= w
    level = Fraction(total - filled, open_weight) if open_weight else Fraction(0)
    return [min(Fraction(most * s), level * w) if open_weight else Fraction(most * s) for s, w in zip(sizes, weights)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=12))
def test_targets_are_the_level(sizes):
    weights = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    want = levelled(sizes, weights, sum(sizes))
    got = mixing.targets(sizes, weights, sum(sizes), 3)
    assert sum(want) == sum(sizes)
    assert got == pytest.approx([float(x) for x in want], rel=1e-9, abs=1e-6)


def test_whole_table(spark, sf_rows):
    rows = sf_rows("documents", "doc_id", "text", "source")
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _ in rows}
    of = {d: s for d, _, s in rows}
    names = sorted(set(of.values()), key=lambda s: (s is None, (s or "").encode()))
    total = {n: sum(size[d] for d in of if of[d] == n) for n in names}
    want = dict(zip(names, levelled([total[n] for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))], sum(total.values()))))
    got = queries.op3_mix_sources(spark, SF).collect()
    assert len(got) == len(rows) == len(size)
    taken = dict.fromkeys(names, 0)
    for r in got:
        source = of[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], total[source])
        assert r["target"] == pytest.approx(float(want[source])) and 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for n in names:
        assert abs(taken[n] - want[n]) <= max(20, want[n] / 50), n
