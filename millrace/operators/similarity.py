"""Similarity joins over vectors: exact, nearest neighbours, sign hashing, and search.

Exact joins compare blocks of rows with one another in matrix products; a pair of
blocks is a unit of work of bounded size, and only pairs at the threshold leave it.
Products are made in single precision first; what may count is computed again in
double precision, so results are those of double precision throughout.
Vectors that are null or zero, or hold a null, are similar to nothing (similarity 0).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.vectors import distance, literal
from millrace.plans.buckets import each_unit, units
from millrace.plans.scratch import keep

#: Rows of a block in a small table; blocks of one of middling size, so that all cores have work; bytes of a block's vectors in a large one.
BLOCK, BLOCKS, BLOCK_BYTES = 2048, 24, 32 << 20
#: Similarities held at once (so that they stay in a core's cache), and columns of them; bytes of vectors that a nearest-neighbour task holds, and that it reads past them.
STEP, WIDE, HELD_BYTES, READ_BYTES = 1 << 20, 2048, 64 << 20, 256 << 20


def _rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    kind = dict(df.dtypes)[vector_col]
    v = F.col(vector_col)
    return df.select(F.col(id_col).alias("id"), (v if kind == "array<float>" else v.cast("array<double>")).alias("v"))


def _unit(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one, and which of them are usable; the width is that of the first usable row."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = pa.concat_arrays(rows.chunks) if isinstance(rows, pa.ChunkedArray) else rows
    sizes = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
    flat = rows.flatten()
    if flat.null_count:
        lists = rows.to_pylist()
        holes = np.array([r is not None and None in r for r in lists], dtype=bool)
        flat = pa.array([x for r, hole in zip(lists, holes, strict=True) if r is not None and not hole for x in r], pa.float64())
        sizes = np.where(holes, 0, sizes)
    used = sizes > 0
    width = int(sizes[used.argmax()]) if used.any() else 1
    good = sizes == width if used.any() else used
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
    if not np.array_equal(used, good):
        values = values[np.repeat(good, sizes)]
    if good.all() and len(good):
        v = values.reshape(-1, width)
    else:
        v = np.zeros((len(sizes), width))
        v[good] = values.reshape(-1, width) if good.any() else 0
    n = np.sqrt(np.einsum("nd,nd->n", v, v))
    ok = good & (n > 0)
    v /= np.where(ok, n, 1)[:, None]
    ok &= np.isfinite(v).all(axis=1)
    v[~ok] = 0
    return v, ok


def _ids(values: np.ndarray, like: pa.DataType) -> pa.Array:
    return pa.array(values.tolist() if values.dtype == object else values, like)


def _size(rows: DataFrame) -> tuple[int, int]:
    """Number of rows and width of the vectors."""
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    return n, max(width or 1, 1)


def _blocks(n: int, width: int, block_rows: int = BLOCK) -> int:
    """Blocks of a table: of a bounded number of bytes, and up to BLOCKS of them as soon as each has ``block_rows`` rows."""
    return max(1, -(-n // max(BLOCK, BLOCK_BYTES // (8 * width))), min(BLOCKS, -(-n // block_rows)))


def _own(n: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")


def _to_tasks(rows: DataFrame, tiles: int, *order: str) -> DataFrame:
    """Rows of each ``unit`` (from 0) together and, as far as there are tasks, alone in one."""
    tasks = max(1, min(tiles, 2000))
    dealt = rows.repartitionById(tasks, F.pmod("unit", F.lit(tasks)).cast("int"))
    return dealt.sortWithinPartitions("unit", *order) if order or tasks < tiles else dealt


def _tiles(left: DataFrame, right: DataFrame | None = None, block_rows: int = BLOCK) -> DataFrame:
    """Rows dealt to every pair of blocks: (unit, side, id, v); side 0 and 1, or -1 where a block of a table meets itself.

    Without ``right`` the pairs are those of ``left`` with itself, each once.
    """
    n = _blocks(*_size(left), block_rows)
    each = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    if right is None:
        own = left.withColumn("o", _own(n)).withColumn("p", each(n))
        i, j = F.least("o", "p").cast("long"), F.greatest("o", "p").cast("long")
        side = F.when(F.col("o") == F.col("p"), -1).when(F.col("o") < F.col("p"), 0).otherwise(1)
        return _to_tasks(own.select((i * n - F.expr("least(o, p) * (least(o, p) + 1L) div 2") + j).alias("unit"), side.cast("byte").alias("side"), "id", "v"), n * (n + 1) // 2)
    m = _blocks(*_size(right), block_rows)
    a = left.withColumn("o", _own(n)).withColumn("p", each(m)).select((F.col("o").cast("long") * m + F.col("p")).alias("unit"), F.lit(0).cast("byte").alias("side"), "id", "v")
    b = right.withColumn("o", _own(m)).withColumn("p", each(n)).select((F.col("p").cast("long") * m + F.col("o")).alias("unit"), F.lit(1).cast("byte").alias("side"), "id", "v")
    return _to_tasks(a.union(b), n * m)


def _margin(width: int) -> float:
    """More than the error of a product of two rows of length one in single precision."""
    return 1.2e-7 * (width + 8)


def _close(a: np.ndarray, b: np.ndarray, threshold: float, same: bool = False, values: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """(rows of ``a``, rows of ``b``, cosine) of the pairs at the threshold, in steps; if both are the ``same``, each pair once.

    Candidates come from products in single precision, with a margin; what counts is their cosine in double precision.
    Without ``values`` pairs above the margin come without it.
    """
    x, y, width = a.astype(np.float32), b.astype(np.float32), max(a.shape[1], 1)
    if not len(x) or not len(y) or a.shape[1] != b.shape[1]:
        return
    low, sure, part = np.float32(threshold - _margin(width)), np.float32(threshold + _margin(width)), max(1, STEP // width)
    for at in range(0, len(y), WIDE):
        right = np.ascontiguousarray(y[at : at + WIDE].T)
        for lo in range(0, min(len(x), at + WIDE) if same else len(x), STEP // WIDE):
            sims = x[lo : lo + STEP // WIDE] @ right
            found = np.flatnonzero(sims >= low)
            if not values:
                above = sims.ravel()[found] > sure
                i, j = np.divmod(found[above], sims.shape[1])
                yield i + lo, j + at, None
                found = found[~above]
            for k in range(0, len(found), part):
                i, j = np.divmod(found[k : k + part], sims.shape[1])
                i, j = i + lo, j + at
                if same:
                    i, j = i[i < j], j[i < j]
                sim = np.einsum("nd,nd->n", a[i], b[j])
                live = sim >= threshold
                yield i[live], j[live], sim[live]


def _sides(unit: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
    """Vectors, ids, usable rows of either side, and whether a block meets itself."""
    v, ok = _unit(unit.column("v"))
    side, ids = unit.column("side").to_numpy(), unit.column("id").to_numpy()
    if (side < 0).any():
        return v, ids, np.flatnonzero(ok), np.flatnonzero(ok), True
    return v, ids, np.flatnonzero(ok & (side == 0)), np.flatnonzero(ok & (side == 1)), False


def similar_pairs(df: DataFrame, threshold: float, id_col: str = "id", vector_col: str = "embedding", block_rows: int = BLOCK, normals: tuple[int, int, int] | None = None) -> DataFrame:
    """All pairs id_a < id_b with cosine of ``threshold`` or more; with ``normals`` (tables, bits, seed), of those that share a sign hash."""
    rows = _rows(df, id_col, vector_col)
    kind = rows.schema["id"].dataType.simpleString()

    def work(unit: pa.Table) -> Iterator[pa.RecordBatch]:
        like = unit.schema.field("id").type
        v, ids, left, right, same = _sides(unit)
        h = sign_hashes(v, planes(normals[0], normals[1], v.shape[1], normals[2])) if normals else None
        for a, b, sim in _close(v[left], v[right], threshold, same):
            a, b = left[a], right[b]
            live = ids[a] != ids[b]
            if h is not None:
                live &= (h[a] == h[b]).any(axis=1)
            a, b, sim = a[live], b[live], sim[live]
            x, y = ids[a], ids[b]
            yield pa.RecordBatch.from_arrays([_ids(np.where(x < y, x, y), like), _ids(np.where(x < y, y, x), like), pa.array(sim)], names=["id_a", "id_b", "sim"])

    return _tiles(rows, None, block_rows).mapInArrow(each_unit(work, ("unit",)), f"id_a {kind}, id_b {kind}, sim double")


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give all members of a component of (a, b) the least of their labels; labels are places, and a label's own label is itself."""
    while True:
        x, y = label[a], label[b]
        live = x != y
        if not live.any():
            return
        a, b, x, y = a[live], b[live], x[live], y[live]
        label[np.maximum(x, y)] = np.minimum(x, y)
        while not np.array_equal(up := label[label], label):
            label[:] = up


def similar_links(df: DataFrame, threshold: float, id_col: str = "id", vector_col: str = "embedding", fresh: DataFrame | None = None, block_rows: int = BLOCK) -> DataFrame:
    """(id_a, id_b) with the components of ``similar_pairs``, at most a row for each id and block: every tile gives stars, not pairs.

    With ``fresh``, rows of ``df``, those of the pairs that have a row of ``fresh``.
    """
    rows = _rows(df, id_col, vector_col)
    kind = rows.schema["id"].dataType.simpleString()

    def work(unit: pa.Table) -> pa.RecordBatch:
        v, ids, left, right, same = _sides(unit)
        order = np.argsort(ids, kind="stable")
        rank = np.argsort(order, kind="stable")
        label = np.arange(len(ids))  # by rank, so that a component's label is its smallest id
        left_rank, right_rank = rank[left], rank[right]
        for a, b, _ in _close(v[left], v[right], threshold, same, values=False):
            join_labels(label, left_rank[a], right_rank[b])
        ids = ids[order]
        rest = np.flatnonzero(label != np.arange(len(ids)))
        rest = rest[ids[label[rest]] != ids[rest]]  # with fresh, a row meets itself
        like = unit.schema.field("id").type
        return pa.RecordBatch.from_arrays([_ids(ids[label[rest]], like), _ids(ids[rest], like)], names=["id_a", "id_b"])

    tiles = _tiles(rows, None, block_rows) if fresh is None else _tiles(_rows(fresh, id_col, vector_col), rows, block_rows)
    return tiles.mapInArrow(each_unit(work, ("unit",)), f"id_a {kind}, id_b {kind}")


def similar_to(rows: DataFrame, others: DataFrame, threshold: float) -> DataFrame:
    """(id) of the ``rows`` with a cosine of ``threshold`` or more to a row of ``others`` of another id; both have (id, v)."""
    kind = rows.schema["id"].dataType.simpleString()

    def work(unit: pa.Table) -> pa.RecordBatch:
        v, ids, left, right, _ = _sides(unit)
        x, y, margin = v[left].astype(np.float32), v[right].astype(np.float32), _margin(v.shape[1])
        hit = np.zeros(len(right), dtype=bool)
        own = np.isin(ids[right], ids[left])  # these may meet themselves
        for at in range(0, len(right), WIDE):
            part = np.arange(at, min(at + WIDE, len(right)))
            for lo in range(0, len(left), STEP // WIDE):
                rows_ = left[lo : lo + STEP // WIDE]
                open_ = part[~hit[part] & ~own[part]]
                if len(open_):
                    most = (x[lo : lo + len(rows_)] @ y[open_].T).max(axis=0)
                    hit[open_[most > threshold + margin]] = True
                    near = open_[(most >= threshold - margin) & (most <= threshold + margin)]
                    for _, b, _ in _close(v[rows_], v[right[near]], threshold):
                        hit[near[b]] = True
                near = part[~hit[part] & own[part]]
                for a, b, _ in _close(v[rows_], v[right[near]], threshold):
                    hit[near[b[ids[rows_[a]] != ids[right[near[b]]]]]] = True
        return pa.RecordBatch.from_arrays([_ids(ids[right[hit]], unit.schema.field("id").type)], names=["id"])

    return _tiles(others, rows).mapInArrow(each_unit(work, ("unit",)), f"id {kind}").distinct()


def similar_hops(df: DataFrame, threshold: float, most: int = 3, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """(id, hops) of the rows within ``most`` steps of the smallest id that is similar to another; that id is null if there is none.

    A step goes from a row to those with a cosine of ``threshold`` or more. Rows newly reached are compared with those
    not yet reached, so no pair is compared twice and none is written.
    """
    rows = keep(_rows(df, id_col, vector_col), "rows")
    start, last, batch = None, None, 256
    while start is None:
        some = rows if last is None else rows.where(F.col("id") > F.lit(last))
        some = keep(some.where("id IS NOT NULL").orderBy("id").limit(batch), "start")
        last = some.agg(F.max("id")).first()[0]
        if last is None:
            break
        start = similar_to(some, rows, threshold).agg(F.min("id")).first()[0]
        batch *= 8
    kind = rows.schema["id"].dataType.simpleString()
    seen = df.sparkSession.createDataFrame([(start, 0)], f"id {kind}, hops int")
    front = seen.select("id")
    for k in range(1, most + 1):
        left = rows.join(seen.select("id"), "id", "left_anti")
        front = keep(similar_to(left, rows.join(front, "id", "left_semi"), threshold), "front")
        if start is None or front.isEmpty():
            break
        seen = seen.unionByName(front.withColumn("hops", F.lit(k)))
    return seen


def _best(row: np.ndarray, dist: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` entries of each ``row`` that come first by distance (12 decimals) and id."""
    rank = np.unique(ids, return_inverse=True)[1] if ids.dtype == object else ids
    order = np.lexsort((rank, np.round(dist, 12), row))
    sorted_rows = row[order]
    first = np.searchsorted(sorted_rows, sorted_rows)
    return order[np.arange(len(order)) - first < k]


class _Nearest:
    """The ``k`` corpus rows nearest to each of a block of queries, as the corpus comes in batches."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, k: int, itself: bool):
        self.v, self.ids, self.k, self.itself = v, ids, k, itself
        self.low = v.astype(np.float32)
        self.bound = np.full(len(v), -np.inf, dtype=np.float32)
        self.row, self.dist, self.match = np.zeros(0, np.int64), np.zeros(0), None

    def add(self, v: np.ndarray, ids: np.ndarray) -> None:
        if not len(v) or not len(self.v) or v.shape[1] != self.v.shape[1]:
            if not len(v) or not len(self.v):
                return
            v = np.zeros((len(v), self.v.shape[1]))  # of another length: similarity 0
        low, margin, k = v.astype(np.float32), np.float32(2 * _margin(v.shape[1]) + 1e-11), self.k + (not self.itself)
        groups = min(len(v), max(64, 8 * k))
        step = max(1, STEP // len(v))
        rows, dists, matches = [self.row], [self.dist], [self.match if self.match is not None else ids[:0]]
        for lo in range(0, len(self.v), step):
            sims = self.low[lo : lo + step] @ low.T
            bound = self.bound[lo : lo + step]
            if np.isneginf(bound).any() and groups >= k:  # the k-th of the largest of some groups lies below the k-th of all
                wide = len(v) // groups * groups
                tops = sims[:, :wide].reshape(len(sims), -1, groups).max(axis=1)
                bound = np.maximum(bound, np.partition(tops, groups - k, axis=1)[:, groups - k] - margin)
            hit = sims >= bound[:, None]
            many = np.flatnonzero(np.count_nonzero(hit, axis=1) > 16 * groups)  # ties: these rows are sorted out in double precision
            for i in many.tolist():
                hit[i] = False
                d = np.round(1 - v @ self.v[lo + i], 12)
                if not self.itself:
                    d[ids == self.ids[lo + i]] = np.inf
                last = np.partition(d, min(self.k, len(d)) - 1)[min(self.k, len(d)) - 1]
                at, level = np.flatnonzero(d < last), np.flatnonzero(d == last)
                rest = self.k - len(at)
                level = level[np.argsort(ids[level], kind="stable")[:rest]] if len(level) > rest else level
                at = np.concatenate([at, level])
                at = at[np.isfinite(d[at])]
                rows.append(np.full(len(at), lo + i)), dists.append(1 - v[at] @ self.v[lo + i]), matches.append(ids[at])
            found = np.flatnonzero(hit)
            part = max(1, STEP // v.shape[1])
            for at in range(0, len(found), part):
                i, j = np.divmod(found[at : at + part], len(v))
                i = i + lo
                if not self.itself:
                    live = self.ids[i] != ids[j]
                    i, j = i[live], j[live]
                rows.append(i), dists.append(1 - np.einsum("nd,nd->n", self.v[i], v[j])), matches.append(ids[j])
        row, dist, match = np.concatenate(rows), np.concatenate(dists), np.concatenate(matches)
        at = _best(row, dist, match, self.k)
        self.row, self.dist, self.match = row[at], dist[at], match[at]
        full = np.flatnonzero(np.bincount(self.row, minlength=len(self.v)) == self.k)
        worst = np.full(len(self.v), -np.inf)
        np.maximum.at(worst, self.row, self.dist)
        self.bound[full] = (1 - worst[full]).astype(np.float32) - margin


def nearest(queries: DataFrame, corpus: DataFrame, k: int = 1, query_id: str = "id", corpus_id: str = "id", query_vector: str = "embedding", corpus_vector: str = "embedding", itself: bool = True) -> DataFrame:
    """The ``k`` corpus rows nearest to each query: query, match, distance, rank (from 1); ties go to the smaller match.

    With ``itself`` false a row doesn't match its own id. Unusable queries have no rows. A task holds a block of queries
    and reads a part of the corpus past it, so its memory has a bound and the corpus is copied once for each block of queries.
    """
    q, c = _rows(queries, query_id, query_vector), _rows(corpus, corpus_id, corpus_vector)
    (nq, wide), (nc, other) = _size(q), _size(c)
    held = max(1, -(-nq * wide * 8 // HELD_BYTES), min(-(-nq // BLOCK), 7))
    parts = max(1, -(-nc * other * 8 // READ_BYTES), min(-(-nc // BLOCK), -(-2 * BLOCKS // held)))
    kq, kc = (x.schema["id"].dataType.simpleString() for x in (q, c))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = q.withColumn("o", _own(held)).withColumn("p", each(parts)).select((F.col("o").cast("long") * parts + F.col("p")).alias("unit"), F.lit(0).cast("byte").alias("side"), F.col("id").alias("query"), F.lit(None).cast(kc).alias("match"), "v")
    b = c.withColumn("o", _own(parts)).withColumn("p", each(held)).select((F.col("p").cast("long") * parts + F.col("o")).alias("unit"), F.lit(1).cast("byte").alias("side"), F.lit(None).cast(kq).alias("query"), F.col("id").alias("match"), "v")
    a, b = (x.withColumn("v", F.col("v").cast("array<double>")) for x in (a, b)) if dict(a.dtypes)["v"] != dict(b.dtypes)["v"] else (a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, first, best, kinds = None, [], None, None

        def ready() -> _Nearest | None:
            if not first:
                return None
            table = pa.concat_tables(first)
            first.clear()
            v, ok = _unit(table.column("v"))
            return _Nearest(v[ok], table.column("query").to_numpy()[ok], k, itself)

        def result() -> pa.RecordBatch | None:
            if best is None or best.match is None or not len(best.row):
                return None
            return pa.RecordBatch.from_arrays([_ids(best.ids[best.row], kinds[0]), _ids(best.match, kinds[1]), pa.array(best.dist)], names=["query", "match", "distance"])

        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = batch.schema.field("query").type, batch.schema.field("match").type
            table = pa.Table.from_batches([batch])
            key = table.column("unit").to_numpy() * 2 + table.column("side").to_numpy()
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if key[lo] // 2 != unit:
                    if (out := result()) is not None:
                        yield out
                    unit, best = key[lo] // 2, None
                    first.clear()
                piece = table.slice(lo, hi - lo)
                if key[lo] % 2 == 0:
                    first.append(piece)
                    continue
                best = best or ready()
                if best is not None:
                    v, ok = _unit(piece.column("v"))
                    best.add(v[ok], piece.column("match").to_numpy()[ok])
        if (out := result()) is not None:
            yield out

    found = _to_tasks(a.union(b), held * parts, "side").mapInArrow(run, f"query {kq}, match {kc}, distance double")
    order = Window.partitionBy("query").orderBy(F.round("distance", 12), "match")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest_match(queries: DataFrame, corpus: DataFrame, query_id: str = "id", corpus_id: str = "id", query_vector: str = "embedding", corpus_vector: str = "embedding") -> DataFrame:
    """Each query with its nearest corpus row and distance; a query without a usable vector has null and infinity."""
    found = nearest(queries, corpus, 1, query_id, corpus_id, query_vector, corpus_vector)
    ids = queries.select(F.col(query_id).alias("query"))
    return ids.join(found.drop("rank"), "query", "left").withColumn("distance", F.coalesce("distance", F.lit(float("inf"))))


def similar_pairs_knn(df: DataFrame, threshold: float, k: int = 50, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """Pairs of which one is among the other's ``k`` nearest, with cosine of ``threshold`` or more."""
    found = nearest(df, df, k, id_col, id_col, vector_col, vector_col, itself=False)
    pairs = found.where(1 - F.col("distance") >= threshold).select(F.least("query", "match").alias("id_a"), F.greatest("query", "match").alias("id_b"), (1 - F.col("distance")).alias("sim"))
    return pairs.groupBy("id_a", "id_b").agg(F.max("sim").alias("sim"))


def planes(tables: int, bits: int, width: int, seed: int = 42) -> np.ndarray:
    """Normals [table, bit] of the hashing planes, to three decimals so that they can be written down."""
    return np.random.default_rng(seed).normal(size=(tables, bits, width)).round(3)


def lsh_plan(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """(tables, bits) that make a pair at the threshold share a hash with probability ``recall``, for n rows.

    A plane parts two vectors with probability angle / pi. There are bits enough that a bucket of unrelated rows has
    some 512 members, four at least, and as many tables as the recall then asks for.
    """
    if not 0 < recall < 1:
        raise ValueError("the recall has to lie between 0 and 1")
    bits = max(4, math.ceil(math.log2(max(n, 1) / 512)) if n else 0)
    shared = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return (1 if shared >= recall else math.ceil(math.log(1 - recall) / math.log1p(-shared))) if shared > 0 else 1, bits


def sign_hashes(v: np.ndarray, normals: np.ndarray) -> np.ndarray:
    """Hash [row, table]: bit b is set if the row lies above plane b."""
    above = np.einsum("nd,tbd->ntb", v, normals) > 0
    return (above << np.arange(normals.shape[1])).sum(axis=2)


def similar_pairs_lsh(df: DataFrame, threshold: float, recall: float = 0.95, tables: int | None = None, bits: int | None = None, seed: int = 42, least: int = 0, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """Pairs that share a sign hash in some table and have cosine of ``threshold`` or more.

    ``tables`` and ``bits`` follow from the wanted recall of pairs at the threshold, unless both are given (10 and 8 are
    usual; they find 0.18 of the pairs at 0.35, 0.39 at 0.55 and 0.97 at 0.9). A caller who wants all pairs compared below some number
    of rows gives it as ``least``.
    """
    rows = _rows(df, id_col, vector_col)
    if least and len(rows.limit(least).collect()) < least:
        return similar_pairs(df, threshold, id_col, vector_col)
    if tables is None or bits is None:
        tables, bits = lsh_plan(rows.count(), threshold, recall)
    if tables >= 2 ** (bits - 2):  # buckets that hold most pairs, many of them several times: all pairs are less work
        return similar_pairs(df, threshold, id_col, vector_col, normals=(tables, bits, seed))
    kind = rows.schema["id"].dataType.simpleString()

    def hashed(batches):
        for batch in batches:
            v, ok = _unit(pa.chunked_array([batch.column(1)]))
            h = sign_hashes(v, planes(tables, bits, v.shape[1], seed))[ok]
            used = pa.array(np.flatnonzero(ok))
            lists = pa.array(h.tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(used), batch.column(1).take(used), lists], names=["id", "v", "hashes"])

    marked = rows.mapInArrow(hashed, f"id {kind}, v {dict(rows.dtypes)['v']}, hashes array<long>")
    keyed = marked.select("id", "v", "hashes", F.posexplode("hashes").alias("table", "hash")).withColumn("bucket", F.col("table") * (1 << bits) + F.col("hash"))

    def work(unit: pa.Table) -> pa.RecordBatch | None:
        v, _ = _unit(unit.column("v"))
        ids, side, t = unit.column("id").to_numpy(), unit.column("side").to_numpy(), unit.column("table")[0].as_py()
        h = np.array(unit.column("hashes").to_pylist())
        sims = v @ v.T
        a, b = np.nonzero((sims >= threshold) & (ids[:, None] < ids[None, :]) & ((side[:, None] != side[None, :]) | (side[:, None] < 0)))
        first = ~(h[a][:, :t] == h[b][:, :t]).any(axis=1)  # in no earlier table
        a, b = a[first], b[first]
        return pa.RecordBatch.from_arrays([_ids(ids[a], unit.schema.field("id").type), _ids(ids[b], unit.schema.field("id").type), pa.array(sims[a, b])], names=["id_a", "id_b", "sim"])

    return units(keyed, BLOCK).select("unit", "bucket", "side", "id", "v", "table", "hashes").mapInArrow(each_unit(work), f"id_a {kind}, id_b {kind}, sim double")


def conditions(entity_type: str | None = None, tag: str | None = None, active_only: bool = False, tag_text: str | None = None) -> Column | None:
    """Filter of a search: none, one, or all of the conditions."""
    parts = []
    if entity_type:
        parts.append(F.col("primary_entity_type") == entity_type.upper())
    if tag:
        parts.append(F.array_contains("tags", tag.upper()))
    if tag_text:
        parts.append(F.array_join("tags", ", ").contains(tag_text.upper()))
    if active_only:
        parts.append(~F.coalesce(F.col("distilled"), F.lit(False)))
    return reduce(lambda a, b: a & b, parts) if parts else None


def vector_search(df: DataFrame, query: list[float], k: int = 10, where: Column | None = None, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` rows with the smallest cosine distance to ``query``, then the smallest id."""
    rows = df.where(where) if where is not None else df
    return rows.withColumn("distance", distance(F.col(vector_col), literal(query))).orderBy("distance", id_col).limit(k)




def pairs_from_matrix(matrix: DataFrame, threshold: float) -> DataFrame:
    """Pairs i < j of a similarity table (i, j, sim) at the threshold."""
    return matrix.where((F.col("i") < F.col("j")) & (F.col("sim") >= threshold)).select(F.col("i").alias("id_a"), F.col("j").alias("id_b"), "sim")
