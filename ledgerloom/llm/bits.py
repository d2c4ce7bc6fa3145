"""Filters of a fixed size for columns of longs. They only ever let too much pass."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shingles import mixed
from ledgerloom.llm.store import freeing

#: A filter has 2 ** BITS bits (8 MB) however many values it was made from; they pass the driver once.
BITS = 26


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = mixed(h.view(np.uint64)) >> np.uint64(64 - BITS)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = np.zeros(1 << (BITS - 6), np.uint64)
    for batch in batches:
        at = mixed(batch.column(0).to_numpy().view(np.uint64)) >> np.uint64(64 - BITS)
        np.bitwise_or.at(words, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
    used = np.flatnonzero(words)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words[used].view(np.int64))], ["word", "bits"])


def bit_filter(values: DataFrame):
    """A broadcast bitmap of a column of longs, of 2 ** BITS bits however many values there are."""
    with freeing(values.sparkSession):
        words = values.mapInArrow(_set_bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(1 << (BITS - 6), np.uint64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return values.sparkSession.sparkContext.broadcast(bits.view(np.uint8))
