"""Work on all members of a bucket without gathering a large bucket in one task.

A bucket of more than ``tile`` members is split into tiles; every pair of tiles
becomes a unit of its own, so each pair of members still meets in exactly one
unit and a unit has at most about two tiles of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.scratch import keep


def units(rows: DataFrame, tile: int, deal: bool = True) -> DataFrame:
    """``rows`` (bucket, id, ...) with a unit key; if ``deal``, sorted so that a unit's rows are adjacent.

    Buckets with a single row are dropped: they hold no pair. Adds ``unit``
    (long) and ``side`` (0, 1: the tile it stands in; -1 where both are one).
    ``id`` must be one row's own value in a bucket. Rows with a null bucket are dropped.
    """
    rows = rows.where(F.col("bucket").isNotNull())
    sizes = keep(rows.groupBy("bucket").agg(F.count("*").alias("_n")).where("_n > 1"), "sizes")  # a table of its own, so that the join can split a large bucket
    tiles = F.ceil(F.col("_n") / tile).cast("long")
    own = F.pmod(F.xxhash64("id", F.lit(7)), F.col("_t"))
    others = F.sequence(F.lit(0).cast("long"), F.col("_t") - 1)
    pair = F.transform(others, lambda o: F.struct(F.least(o, F.col("_o")).alias("i"), F.greatest(o, F.col("_o")).alias("j")))
    dealt = rows.join(sizes, "bucket").withColumn("_t", tiles).withColumn("_o", own).withColumn("_p", F.explode(pair))
    side = F.when(F.col("_p.i") == F.col("_p.j"), -1).when(F.col("_o") == F.col("_p.i"), 0).otherwise(1).cast("byte")
    dealt = dealt.withColumn("unit", F.xxhash64("bucket", "_p.i", "_p.j")).withColumn("side", side).drop("_n", "_t", "_o", "_p")
    keys = ["unit", "bucket"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "side", "id") if deal else dealt


def each_unit(work: Callable[[pa.Table], pa.RecordBatch | Iterator[pa.RecordBatch] | None], keys: tuple[str, ...] = ("unit", "bucket")) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow over sorted rows that calls ``work`` with each run of equal keys; it gives one batch, several, or none."""

    def results(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        out = work(pa.concat_tables(held) if len(held) > 1 else held[0])
        for batch in () if out is None else (out,) if isinstance(out, pa.RecordBatch) else out:
            if batch.num_rows:
                yield batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            cols = [table.column(k).to_numpy() for k in keys]
            change = np.zeros(table.num_rows, dtype=bool)
            for c in cols:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), table.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                key = tuple(c[lo] for c in cols)
                if held and key != last:
                    yield from results(held)
                    held = []
                last = key
                held.append(table.slice(lo, hi - lo))
        if held:
            yield from results(held)

    return run


class Forest:
    """Union-find over the members 0..n-1 of one unit."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        """Unite two members; True, and an edge kept, if they were apart."""
        a0, b0 = self.find(a), self.find(b)
        if a0 == b0:
            return False
        self.up[max(a0, b0)] = min(a0, b0)
        self.edges.append((a, b))
        return True
