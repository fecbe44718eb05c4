"""A Bloom filter built on executors, of bounded size, for tests in Python tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FUNCTIONS, PER_HASH = 6, 64


def places(h: np.ndarray, bits: int, which: int) -> np.ndarray:
    """Bit number of each 64-bit hash under one of the filter's functions."""
    return ((h & np.uint64(0xFFFFFFFF)) + np.uint64(which + 1) * (h >> np.uint64(32))) % np.uint64(bits)


def passing(h: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Indices of the hashes that the filter, an array of 64-bit words, lets through."""
    live = np.arange(len(h))
    for i in range(FUNCTIONS):
        p = places(h[live], 64 * len(held), i)
        live = live[(held[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63)) & np.uint64(1)).astype(bool)]
    return live


def build(hashes: DataFrame, most_mb: float) -> np.ndarray:
    """Filter of a one-column table of longs: ``PER_HASH`` bits for each, ``most_mb`` megabytes at most.

    Beyond that size it only lets more through: what it passes goes to an exact join.
    """
    name = hashes.columns[0]
    bits = int(min(most_mb * 8e6, max(1 << 16, PER_HASH * hashes.count()))) // 64 * 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            p = np.unique(np.concatenate([places(h, bits, i) for i in range(FUNCTIONS)]))
            yield pa.RecordBatch.from_arrays([pa.array((p >> np.uint64(6)).view(np.int64)), pa.array((np.uint64(1) << (p & np.uint64(63))).view(np.int64))], names=["word", "bit"])

    parts = hashes.where(F.col(name).isNotNull()).mapInArrow(run, "word long, bit long").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[parts["word"].to_numpy()] = parts["bits"].to_numpy().view(np.uint64)
    return out
