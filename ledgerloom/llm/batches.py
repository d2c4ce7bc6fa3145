"""Text columns of Arrow batches as byte arrays, for the operators that work with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a single longer text makes a piece of its own.
PIECE = 1 << 20


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has no bytes."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, ends


def pieces(ends: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows holding at most ``limit`` bytes, or one longer row."""
    lo, n = 0, len(ends) - 1
    while lo < n:
        hi = int(np.searchsorted(ends, ends[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi
