"""Embedding near-duplicates by navigable small-world graphs, one for each shard.

Vectors that are equal, but for a factor that is a power of two, form a class first.
Classes are dealt to shards by hash; each shard builds a hierarchical graph in one task
and audits it: some of its own vectors, and probes made at the threshold's distance from
them, are searched and compared with brute force, and the beam doubles until the mean
recall of a query is as wanted for both (at the size of the shard the search is a full
scan). The least recall of a shard is returned. Then every block of classes is searched in
every shard. A query whose beam holds nothing but hits is searched again with
twice the beam, so no limit cuts its links. Hits are verified by cosine in double
precision. A unit gives each query's number of links and a spanning forest of
them, not all pairs; components unite the forests.

Shards number ``least_shards`` at least and hold ``shard_rows`` rows and ``shard_mb``
megabytes of vectors at most on average, blocks likewise, so the work of a unit is bounded; units number
shards times blocks. A unit holds its shard's graph, which reaches it in pieces of
``PIECE`` bytes so that no row is large, and reads the block in Arrow batches; searches
take as many queries at once as ``CELLS`` allow. A worker thus needs a few times
``shard_mb``, however many rows there are.

Results for odd input: a vector that is null, empty, zero, or holds a null or a
non-finite component links with nothing. Vectors of differing lengths do not
link. A row without an id is linked and counted, names no component, and is not
kept. Rows that share an id are counted apart. Other columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.buckets import Forest
from millrace.operators.components import components
from millrace.plans.scratch import keep

DEGREE, BUILD_BEAM, EXPAND = 16, 48, 4
#: Numbers that a step of a search or of a build holds at once; bytes of a graph in one row.
CELLS, PIECE = 1 << 23, 1 << 18


def _step(nodes: int, width: int) -> int:
    """Queries that walk together: one mark for each node, and the vectors of the neighbours looked at."""
    return max(1, min(1024, CELLS // (nodes + 1), CELLS // (EXPAND * 2 * DEGREE * width)))


def unit_rows(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def beam_search(vectors: np.ndarray, near: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, cosines) [query, beam] by falling cosine, -1 where the beam isn't full; all queries walk in step.

    ``near`` [node, degree] holds neighbours or -1, ``entry`` [query, k] the nodes to begin from.
    """
    q, n = len(queries), len(vectors)
    rows = np.arange(q)
    seen = np.zeros((q, n + 1), dtype=bool)
    seen[:, n] = True  # stands for "no neighbour"
    ids = np.full((q, beam), n, dtype=np.int32)
    sims = np.full((q, beam), -2.0, dtype=np.float32)
    todo = np.zeros((q, beam), dtype=bool)
    first = np.where(entry < 0, n, entry)
    fresh_rows = rows
    new = first
    while True:
        order = np.sort(new, axis=1)
        order[:, 1:][order[:, 1:] == order[:, :-1]] = n
        order[seen[fresh_rows[:, None], order]] = n
        seen[fresh_rows[:, None], order] = True
        found = np.einsum("qmd,qd->qm", vectors[np.minimum(order, n - 1)], queries[fresh_rows], optimize=False)
        found[order == n] = -2.0
        all_ids = np.concatenate([ids[fresh_rows], order], axis=1)
        all_sims = np.concatenate([sims[fresh_rows], found], axis=1)
        all_todo = np.concatenate([todo[fresh_rows], order < n], axis=1)
        top = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        ids[fresh_rows] = np.take_along_axis(all_ids, top, 1)
        sims[fresh_rows] = np.take_along_axis(all_sims, top, 1)
        todo[fresh_rows] = np.take_along_axis(all_todo, top, 1)
        open_rows = np.flatnonzero(todo.any(axis=1))
        if not len(open_rows):
            return np.where(ids == n, -1, ids), sims
        waiting = todo[open_rows]
        place = np.argsort(~waiting, axis=1, kind="stable")[:, :EXPAND]  # the best that wait
        live = np.take_along_axis(waiting, place, 1)
        chosen = np.where(live, np.take_along_axis(ids[open_rows], place, 1), n)
        np.put_along_axis(waiting, place, False, 1)
        todo[open_rows] = waiting
        near_ids = near[np.minimum(chosen, n - 1)]
        near_ids = np.where((chosen[:, :, None] == n) | (near_ids < 0), n, near_ids)
        new = near_ids.reshape(len(open_rows), -1)
        fresh_rows = open_rows


def diverse(vectors: np.ndarray, base: np.ndarray, cand: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """For each node of ``base`` up to ``degree`` of its candidates (-1: none), best first.

    A candidate nearer to one already taken than to the node waits until all others are taken.
    """
    order = np.argsort(-np.where(cand < 0, -3.0, sims), axis=1, kind="stable")
    cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
    b, c = cand.shape
    v = vectors[np.maximum(cand, 0)]
    pair = np.einsum("bid,bjd->bij", v, v, optimize=True)
    taken = np.zeros((b, c), dtype=bool)
    count = np.zeros(b, dtype=np.int64)
    for k in range(c):
        worst = np.where(taken, pair[:, k, :], -2.0).max(axis=1)
        good = (cand[:, k] >= 0) & (count < degree) & (sims[:, k] > worst)
        taken[:, k] = good
        count += good
    rank = np.argsort(np.where(taken, 0, np.where(cand >= 0, 1, 2)), axis=1, kind="stable")[:, :degree]
    out = np.take_along_axis(cand, rank, 1)
    return np.pad(out, ((0, 0), (0, degree - out.shape[1])), constant_values=-1) if out.shape[1] < degree else out


def _layer(vectors: np.ndarray, degree: int, entry_of) -> np.ndarray:
    """Neighbours [node, degree] of one layer; nodes join in growing batches. ``entry_of(ids)`` gives nodes to begin from among the first."""
    n = len(vectors)
    near = np.full((n, degree), -1, dtype=np.int32)
    done = 0
    while done < n:
        size = min(n - done, max(64, min(done, 1024)))
        batch = np.arange(done, done + size)
        among = vectors[batch] @ vectors[batch].T  # at most 1024 by 1024
        among[np.tril_indices(size)] = -2.0  # each node meets those of its batch once
        among = np.maximum(among, among.T)
        np.fill_diagonal(among, -2.0)
        k = min(BUILD_BEAM // 2, size)
        mates = np.argsort(-among, axis=1, kind="stable")[:, :k]
        cand, sims = batch[mates].astype(np.int32), np.take_along_axis(among, mates, 1)
        cand[sims < -1.5] = -1
        if done:
            step = _step(done, vectors.shape[1])
            walks = [beam_search(vectors[:done], near[:done], vectors[part], entry_of(part, done), min(BUILD_BEAM, done)) for part in (batch[lo : lo + step] for lo in range(0, size, step))]
            cand, sims = (np.concatenate([x, np.concatenate(y)], axis=1) for x, y in zip((cand, sims), zip(*walks, strict=True), strict=True))
        few = max(1, min(1024, CELLS // (cand.shape[1] * max(vectors.shape[1], cand.shape[1]))))
        for lo in range(0, size, few):
            near[batch[lo : lo + few]] = diverse(vectors, batch[lo : lo + few], cand[lo : lo + few], sims[lo : lo + few], degree)
        # links back, best first, then thinned
        src = np.repeat(batch, degree)
        dst = near[batch].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        many = max(1, CELLS // (2 * vectors.shape[1]))
        back = np.concatenate([np.einsum("ed,ed->e", vectors[src[lo : lo + many]], vectors[dst[lo : lo + many]]) for lo in range(0, max(1, len(src)), many)])
        order = np.lexsort((-back, dst))
        src, dst = src[order], dst[order]
        start = np.flatnonzero(np.r_[True, dst[1:] != dst[:-1]]) if len(dst) else np.empty(0, np.int64)
        rank = np.arange(len(dst)) - np.repeat(start, np.diff(np.r_[start, len(dst)]))
        targets = dst[start]
        extra = np.full((len(targets), 2 * degree), -1, dtype=np.int32)
        fits = rank < 2 * degree
        extra[np.searchsorted(targets, dst[fits]), rank[fits]] = src[fits]
        few = max(1, min(1024, CELLS // (3 * degree * max(vectors.shape[1], 3 * degree))))
        for lo in range(0, len(targets), few):
            t = targets[lo : lo + few]
            both = np.concatenate([near[t], extra[lo : lo + few]], axis=1)
            both.sort(axis=1)
            both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
            near[t] = diverse(vectors, t, both, np.einsum("bcd,bd->bc", vectors[np.maximum(both, 0)], vectors[t]), degree)
        done += size
    return near


class Graph:
    """Layers of a hierarchical graph over unit vectors (float32), the highest layer first in ``upper``."""

    def __init__(self, vectors: np.ndarray, base: np.ndarray, upper: list[tuple[np.ndarray, np.ndarray]], beam: int = 32):
        self.vectors, self.base, self.upper, self.beam = vectors, base, upper, beam

    @classmethod
    def build(cls, vectors: np.ndarray) -> Graph:
        n = len(vectors)
        upper: list[tuple[np.ndarray, np.ndarray]] = []
        members, step = np.arange(n), DEGREE
        stack = []
        while len(members) > 4 * DEGREE:
            members = members[::step]
            stack.append(members)
        for members in reversed(stack):
            upper.append((members, _layer(vectors[members], DEGREE, lambda ids, done: np.zeros((len(ids), 1), dtype=np.int32))))
        graph = cls(vectors, np.empty((0, 2 * DEGREE), np.int32), upper)

        def begin(ids: np.ndarray, done: int) -> np.ndarray:
            found = graph.entry(vectors[ids])
            return np.concatenate([np.where(found < done, found, -1), np.zeros((len(ids), 1), np.int32)], axis=1)

        graph.base = _layer(vectors, 2 * DEGREE, begin)
        return graph

    def entry(self, queries: np.ndarray, beam: int = 4) -> np.ndarray:
        """Nodes from which the base layer is entered: the best few of the lowest upper layer."""
        at = np.zeros((len(queries), 1), dtype=np.int32)
        for k, (members, near) in enumerate(self.upper):
            if k:
                place = np.searchsorted(members, at)
                at = np.where(at < 0, -1, place)
            ids, _ = beam_search(self.vectors[members], near, queries, at, min(beam, len(members)))
            at = np.where(ids < 0, -1, members[np.maximum(ids, 0)]).astype(np.int32)
        return at

    def search(self, queries: np.ndarray, threshold: float, beam: int | None = None) -> list[np.ndarray]:
        """For each query the nodes with cosine of about ``threshold`` or more (float32); beams that hold only hits widen."""
        n, beam = len(self.vectors), min(beam or self.beam, len(self.vectors))
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
        todo = np.arange(len(queries))
        floor = threshold - 1e-4
        while len(todo):
            again = []
            step = _step(n, self.vectors.shape[1])
            for lo in range(0, len(todo), step):
                part = todo[lo : lo + step]
                if beam >= n:
                    hits = queries[part] @ self.vectors.T >= floor
                    for i, q in enumerate(part.tolist()):
                        out[q] = np.flatnonzero(hits[i])
                    continue
                ids, sims = beam_search(self.vectors, self.base, queries[part], self.entry(queries[part]), beam)
                for i in np.flatnonzero(sims[:, 0] >= floor).tolist():
                    out[part[i]] = ids[i][(sims[i] >= floor) & (ids[i] >= 0)].astype(np.int64)
                again.append(part[sims[:, -1] >= floor])
            todo = np.concatenate([*again, np.empty(0, np.int64)])
            beam = min(2 * beam, n)
        return out

    def audit(self, threshold: float, recall: float, probes: int = 512, seed: int = 5) -> float:
        """Widen ``beam`` until probes near the threshold are answered with ``recall``; returns the recall reached."""
        n, d = self.vectors.shape
        rng = np.random.default_rng(seed)
        own = self.vectors[rng.permutation(n)[:probes]].astype(np.float64)
        side = rng.normal(size=own.shape)
        side -= (side * own).sum(1, keepdims=True) * own
        side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
        cos = threshold + 0.1 * (1 - threshold)
        queries = (cos * own + np.sqrt(1 - cos * cos) * side * (d > 1)).astype(np.float32)
        step = _step(n, d)
        sets = [(q, [np.flatnonzero(row >= threshold) for lo in range(0, len(q), step) for row in q[lo : lo + step] @ self.vectors.T]) for q in (queries, own.astype(np.float32))]
        while True:
            means = []
            for q, truth in sets:
                each = [len(np.intersect1d(a, b)) / len(a) for a, b in zip(truth, self.search(q, threshold), strict=True) if len(a)]
                means.append(float(np.mean(each)) if each else 1.0)
            if min(means) >= recall or self.beam >= n:
                return min(means)
            self.beam = min(2 * self.beam, n)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, vectors=self.vectors, base=self.base, beam=self.beam, **{f"m{i}": m for i, (m, _) in enumerate(self.upper)}, **{f"n{i}": x for i, (_, x) in enumerate(self.upper)})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Graph:
        z = np.load(io.BytesIO(data))
        return cls(z["vectors"], z["base"], [(z[f"m{i}"], z[f"n{i}"]) for i in range((len(z.files) - 3) // 2)], int(z["beam"]))


def packed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vector (bytes of doubles; null if it can't link) and key (its digest)."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, keys = [], []
            for v in batch.column(1):
                x = v.as_py()
                ok = x is not None and len(x) and None not in x
                a = np.array(x if ok else [0.0], dtype=np.float64) + 0.0
                ok = ok and np.isfinite(a).all() and a.any()
                if ok:  # the largest component between 1/2 and 1, so that no length leaves the range of doubles
                    a = np.ldexp(a, -int(np.frexp(np.abs(a).max())[1])) + 0.0
                data.append(a.tobytes() if ok else None)
                keys.append(hashlib.blake2b(data[-1], digest_size=16).digest() if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary()), pa.array(keys, pa.binary())], names=["id", "vector", "key"])

    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, vector binary, key binary")


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Vectors of equal width, without an object for each."""
    out = [np.empty((0, width))]
    for c in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(c):
            first = np.frombuffer(c.buffers()[1], np.int64 if pa.types.is_large_binary(c.type) else np.int32)[c.offset]
            out.append(np.frombuffer(c.buffers()[2], np.float64, len(c) * width, offset=int(first)).reshape(-1, width))
    return np.concatenate(out)


class _Shard:
    """A graph with its vectors and nodes; searches batches of queries and remembers which nodes their links have joined."""

    def __init__(self, data: bytes):
        z = np.load(io.BytesIO(data))
        self.exact, self.nodes, self.weights = z["exact"], z["nodes"], z["weights"]
        self.graph = Graph.load(z["graph"].tobytes())
        self.norms = np.linalg.norm(self.exact, axis=1)
        self.order = np.argsort(self.nodes)
        self.names = self.nodes.tolist()
        self.forest = Forest(len(self.names))

    @staticmethod
    def dump(graph: Graph, exact: np.ndarray, nodes: np.ndarray, weights: np.ndarray) -> memoryview:
        out = io.BytesIO()
        np.savez(out, graph=np.frombuffer(graph.dump(), np.uint8), exact=exact, nodes=nodes, weights=weights)
        return out.getbuffer()

    def _place(self, node: int) -> int:
        """Number of a query in the forest; one that is not of this shard gets a new one, as a block has each but once."""
        at = int(np.searchsorted(self.nodes, node, sorter=self.order))
        if at < len(self.nodes) and self.nodes[self.order[at]] == node:
            return int(self.order[at])
        self.names.append(node)
        self.forest.up.append(len(self.forest.up))
        return len(self.names) - 1

    def links(self, own: np.ndarray, q: np.ndarray, threshold: float) -> pa.RecordBatch:
        """(query, null, number of links) of each query that has links, and (node, node, 0) of each edge that joins what was apart."""
        a, b, links = [], [], []
        q_norms = np.linalg.norm(q, axis=1)
        for i, hits in enumerate(self.graph.search(unit_rows(q), threshold)):
            hits = hits[(self.exact[hits] @ q[i]) / (self.norms[hits] * q_norms[i]) >= threshold] if len(hits) else hits
            hits = hits[self.nodes[hits] != own[i]]
            if len(hits):
                a.append(int(own[i]))
                b.append(None)
                links.append(int(self.weights[hits].sum()))
                at = self._place(int(own[i]))
                for h in hits.tolist():
                    self.forest.join(at, h)
        for x, y in self.forest.edges:
            a.append(self.names[x])
            b.append(self.names[y])
            links.append(0)
        self.forest.edges.clear()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], names=["a", "b", "links"])


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, recall: float = 0.98, least_shards: int = 12, shard_rows: int = 100_000, block_rows: int = 16_384, shard_mb: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each row of ``vectors``: id, n_links, component_id, kept and recall (the least that a shard's audit reached)."""
    rows = keep(packed(vectors, id_col, vector_col), "vectors")
    classes = rows.where("key is not null").groupBy("key").agg(F.min("id").alias("least"), F.count("*").alias("n"), F.first("vector").alias("vector"))
    classes = keep(classes.withColumn("node", F.monotonically_increasing_id()).withColumn("width", (F.octet_length("vector") / 8).cast("int")), "vector-classes")
    count, size = classes.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("vector")), F.lit(0))).first()
    shards = max(least_shards, -(-count // shard_rows), -(-size // (shard_mb << 20)))
    blocks = max(1, -(-count // block_rows), -(-size // (shard_mb << 20)))

    def build(group: pa.Table) -> pa.Table:
        shard, width = (group.column(c)[0].as_py() for c in ("shard", "width"))
        nodes, weights = (group.column(c).to_numpy().astype(np.int64) for c in ("node", "n"))
        v = _matrix(group.column("vector"), width)
        del group
        graph = Graph.build(unit_rows(v))
        reached = graph.audit(threshold, recall)
        data = _Shard.dump(graph, v, nodes, weights)
        pieces = [pa.array([data[lo : lo + PIECE]], pa.binary()) for lo in range(0, len(data), PIECE)]
        n = len(pieces)
        cols = [pa.array([shard] * n, pa.int64()), pa.array([width] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.chunked_array(pieces), pa.array([float(reached)] * n)]
        return pa.Table.from_arrays(cols, names=["shard", "width", "piece", "data", "recall"])

    dealt = classes.select(F.pmod(F.xxhash64("node", F.lit(1)), F.lit(shards)).cast("long").alias("shard"), "width", "vector", "node", "n")
    graphs = keep(dealt.groupBy("shard", "width").applyInArrow(build, "shard long, width int, piece int, data binary, recall double"), "graphs")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows sorted by unit, in each the pieces of the graph first and then the queries, whose ``piece`` is null."""
        unit, shard, pieces = None, None, []
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("shard", "width", "block")]
            change = np.zeros(batch.num_rows, dtype=bool)
            for k in (*keys, batch.column("piece").is_null().to_numpy(zero_copy_only=False)):
                change[1:] |= k[1:] != k[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                part, now = batch.slice(lo, hi - lo), tuple(int(k[lo]) for k in keys)
                if now != unit:
                    unit, shard, pieces = now, None, []
                if part.column("piece")[0].is_valid:
                    pieces += [x.as_py() for x in part.column("data")]
                    continue
                if pieces:
                    shard, pieces = _Shard(b"".join(pieces)), []
                if shard is not None:  # else no vector of this length is in the shard
                    yield shard.links(part.column("node").to_numpy(), _matrix(part.column("data"), now[1]), threshold)

    block = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(blocks)).cast("long").alias("block")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    queries = classes.select(each(shards).alias("shard"), "width", block, F.lit(None).cast("int").alias("piece"), F.col("vector").alias("data"), "node")
    spread = graphs.select("shard", "width", each(blocks).alias("block"), "piece", "data", F.lit(None).cast("long").alias("node"))
    keys = ["shard", "width", "block"]
    units = spread.unionByName(queries).repartition(*keys).sortWithinPartitions(*keys, F.col("piece").asc_nulls_last())
    found = keep(units.mapInArrow(search, "a long, b long, links long"), "vector-links")

    links = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    parts = components(found.where("b is not null").select("a", "b")).withColumnRenamed("component", "part")
    named = classes.select("key", "node", "least", "n").join(links, "node", "left").join(parts, "node", "left").withColumn("part", F.coalesce("part", "node"))
    named = keep(named, "vector-parts")
    reach = keep(named.groupBy("part").agg(F.min("least").alias("component_id")), "vector-firsts")  # so that the join can split a large component
    named = keep(named.join(reach, "part").select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"), "vector-components")
    bad = rows.where("key is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    reached = graphs.agg(F.coalesce(F.min("recall"), F.lit(1.0))).first()[0]
    out = rows.where("key is not null").select("id", "key").join(named, "key").select("id", "n_links", "component_id").unionByName(bad)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"), F.lit(reached).alias("recall"))
