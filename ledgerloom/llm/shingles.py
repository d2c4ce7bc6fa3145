"""Hashed word shingles of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from ledgerloom.llm.batches import pieces

BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: A random number for each byte and odd multipliers; any fixed choice will do.
BYTE = np.random.Generator(np.random.Philox(key=5)).integers(1, 2**63, 256, dtype=np.uint64)
STEP = np.uint64(0x9E3779B97F4A7C15 | 3)
TURN = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_starts(text: np.ndarray, starts: np.ndarray, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where words begin, which bytes are in words) of texts that begin at ``starts``."""
    solid = ~blank[text]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edge = starts[:-1][np.diff(starts) > 0]
    first[edge] = solid[edge]
    return np.flatnonzero(first), solid


def word_hashes(raw: np.ndarray, ends: np.ndarray, lo: int, hi: int, fold: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of rows lo..hi, bytes replaced by ``fold``, and each row's place in them."""
    text = fold[raw[ends[lo] : ends[hi]]]
    starts = ends[lo : hi + 1] - ends[lo]
    begin, solid = word_starts(text, starts, BLANK)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(hi - lo + 1, np.int64)
    # Sum of byte numbers times the power of the place in the word, blanks counting nothing.
    place = np.arange(len(text))
    place[begin[0] :] -= np.repeat(begin, np.diff(np.append(begin, len(text))))
    power = np.cumprod(np.full(min(int(place.max()) + 1, len(text)), STEP, np.uint64))
    value = BYTE[text] * power[place]
    value[~solid] = 0
    total = np.add.reduceat(value, begin)
    return mixed(total), np.searchsorted(begin, starts)


def shingle_hashes(raw: np.ndarray, ends: np.ndarray, lo: int, hi: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of rows lo..hi, and each row's place in them.

    A row of fewer words, but not none, has its whole sequence as one run.
    """
    word, at = word_hashes(raw, ends, lo, hi)
    m = np.diff(at)
    n = np.where(m == 0, 0, np.maximum(m - size + 1, 1))
    out_at = np.concatenate([[0], np.cumsum(n)])
    start = np.arange(out_at[-1]) - np.repeat(out_at[:-1], n) + np.repeat(at[:-1], n)
    length = np.repeat(np.minimum(m, size), n)
    total = length.astype(np.uint64) * TURN
    padded = np.append(word, np.zeros(size, np.uint64))
    for k in range(size):
        total += np.where(k < length, padded[start + k], np.uint64(0)) * np.uint64(pow(int(STEP), k, 1 << 64))
    return mixed(total), out_at


def shingle_sets(raw: np.ndarray, ends: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row."""
    for lo, hi in pieces(ends):
        h, at = shingle_hashes(raw, ends, lo, hi, size)
        for i in range(hi - lo):
            own = h[at[i] : at[i + 1]]
            if len(own) > 1:
                own = np.sort(own)
                own = own[np.concatenate([[True], own[1:] != own[:-1]])]
            yield lo + i, own


def set_id(own: np.ndarray) -> int:
    """A number for a set of hashes, 0 for the empty set."""
    if not len(own):
        return 0
    total = int(np.add.reduce(mixed(own ^ TURN))) + len(own) * int(STEP)
    return int(mixed(np.array([total % (1 << 64)], np.uint64)).view(np.int64)[0])
