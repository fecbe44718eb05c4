"""Connected components by alternating large-star and small-star steps.

Stars are made with a minimum per node (partial aggregation, so a hub costs one
row for each map task) and a join (which adaptive execution can split), never by
gathering a node's neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.scratch import keep


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and a digest of their set."""
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Component of every node that has an edge.

    ``edges`` has two columns of one orderable type. Returns ``node`` and
    ``component``, the smallest node reachable. Nodes without edges, loops and
    edges with a null end give no row (a loop alone names no other node);
    repeated edges count once. An empty table gives an empty table.
    """
    a, b = edges.columns[:2]
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = keep(edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    mark = _mark(edges)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        joined = large.join(large.groupBy("u").agg(F.min("v").alias("m")), "u")
        small = joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = keep(small.select("e.*").where("u <> v").distinct(), "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("u"), "v")
    return edges.union(roots).distinct().select(F.col("u").alias("node"), F.col("v").alias("component"))
