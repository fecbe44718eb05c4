"""SimHash near-duplicates found through pivot distance tables.

A text's fingerprint is the majority vote over the hashes of its word shingles.
For a fixed list of reference fingerprints ("pivots") the Hamming distances of a
fingerprint's segments to each pivot are computed once. They serve twice:

* Of at most ``radius`` differing bits, spread over m segments, m - ``radius``
  segments get none, so two linked fingerprints have equal distances to *all*
  pivots in each of them. Those rows of the table, for every choice of m - ``radius``
  segments, are the equi-join keys by which rows meet; no linked pair is lost.
  More fingerprints are cut in more segments, which makes longer keys: 5 keys of 12
  bits, 15 of 20, 35 of 27 or 70 of 32, so buckets of unrelated rows stay small.
* Where rows meet, a pair is discarded as soon as its distances to one pivot
  differ by more than the radius (triangle inequality); what survives all pivots
  is verified on the fingerprints themselves.

Only one edge for each newly reached member leaves a unit, not all pairs.

Results for odd input: a null text counts as empty and has fingerprint zero, as
has a text without words; zero links like any other fingerprint. Repeated rows
and equal texts share a fingerprint and a component. A row without ``doc_id`` is
returned with the component of its fingerprint; it names no component. If no
row of a component has a ``doc_id``, its component is null. Other columns of the
input are ignored, so their names cannot clash. An empty table gives an empty one.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import bloom
from millrace.plans.buckets import Forest, each_unit, units
from millrace.operators.components import components
from millrace.llm.paragraphs import jaccard_edges
from millrace.plans.scratch import keep

SEED = 42
#: Rows of a bucket that one unit of work holds at most (twice this for a pair of tiles).
TILE = 2048
#: The same for texts, whose buckets ``key_plan`` lets grow to 8192 unrelated members: a second tile would shuffle every row twice.
TEXT_TILE = 8192
#: Pairs of fingerprints that are compared at once.
CELLS = 1 << 18
_VOTES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
_ROWS = (np.arange(8) * 256).astype(np.int64)


def pivots(n: int, seed: int = 1) -> list[int]:
    """n reference fingerprints, the same on every machine."""
    return [random.Random(f"pivot {seed} {i}").getrandbits(64) for i in range(n)]


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, cut at runs of ASCII white space."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def shingles(parts: list[bytes], size: int) -> list[bytes]:
    """Space-joined runs of ``size`` words, repeats included; fewer words make one shingle, none make none."""
    if len(parts) <= size:
        return [b" ".join(parts)] if parts else []
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1) - 1
    starts = [0, *(ends[:-size] + 1).tolist()]
    return [joined[a:b] for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)]


def fingerprint(parts: list[bytes], seed: int = SEED) -> int:
    """64 bits; a bit is one if it is one in over half the shingles' XXH64."""
    if not parts:
        return 0
    hashes = np.frombuffer(b"".join([xxhash.xxh64_digest(s, seed) for s in parts]), dtype=np.uint8).reshape(-1, 8)
    counts = np.bincount((hashes + _ROWS).ravel(), minlength=2048).reshape(8, 256) @ _VOTES
    return int.from_bytes(np.packbits(counts.ravel() * 2 > len(parts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, seed: int = SEED) -> DataFrame:
    """``id_col`` and ``fp`` (the 64 bits as a long) of every row; one narrow pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.array([fingerprint(shingles(words(t.as_py()), size), seed) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long").withColumnRenamed("id", id_col)


def _segments(n: int) -> list[tuple[int, int]]:
    """(first bit, bits) of n segments of the 64 bits."""
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def segments_for(n: int, radius: int, bucket: int = TILE) -> int:
    """Into how many segments n fingerprints are cut, so that a bucket of unrelated ones has some ``bucket`` members at most."""
    m = radius + 1
    while m < 2 * radius and n >> (64 // m * (m - radius)) > bucket:
        m += 1
    return m


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def table_keys(fps: np.ndarray, radius: int, refs: np.ndarray, cut: int) -> Iterator[np.ndarray]:
    """For each choice of ``cut`` - ``radius`` segments a number for their distances to all pivots."""
    parts = []
    for first, bits in _segments(cut):
        packed = np.zeros(len(fps), np.uint64)
        for r in refs:
            near = np.bitwise_count((fps ^ r) & np.uint64(((1 << bits) - 1) << first))
            packed = (packed << np.uint64(bits.bit_length())) | near.astype(np.uint64)
        parts.append(packed)
    for k, chosen in enumerate(itertools.combinations(parts, cut - radius)):
        key = np.full(len(fps), k + 1, np.uint64)
        for part in chosen:
            key = (key ^ part) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        yield key


def survivors(fps: np.ndarray, side: np.ndarray, radius: int, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one unit that no pivot discards and that differ in ``radius`` bits at most."""
    table = np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    first = table[order, 0]
    ends = np.searchsorted(first, first + radius, side="right")  # only these can lie within the radius
    found_a, found_b = [], []
    for lo in range(0, len(order), 256):
        hi = min(lo + 256, len(order))
        top = int(ends[hi - 1])
        a, b = np.nonzero(np.arange(lo, top)[None, :] > np.arange(lo, hi)[:, None])
        a, b = order[a + lo], order[b + lo]
        live = (side[a] != side[b]) | (side[a] < 0)
        a, b = a[live], b[live]
        for k in range(len(refs)):
            live = np.abs(table[a, k] - table[b, k]) <= radius
            a, b = a[live], b[live]
        live = np.bitwise_count(fps[a] ^ fps[b]) <= radius
        found_a.append(a[live])
        found_b.append(b[live])
    return np.concatenate(found_a or [order[:0]]), np.concatenate(found_b or [order[:0]])


def linked(fps: DataFrame, radius: int = 4, n_pivots: int = 10, tile: int = TILE, cut: int | None = None) -> DataFrame:
    """Edges (a, b) of distinct fingerprints whose components are those of all links within ``radius`` bits; ``cut`` segments, by their number if None."""
    refs, cut = pivots(n_pivots), cut or segments_for(fps.count(), radius)
    at = np.array(refs, dtype=np.uint64)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key in table_keys(batch.column(0).to_numpy().view(np.uint64), radius, at, cut):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key.view(np.int64))], names=["id", "bucket"])

    keyed = fps.select(F.col("fp").alias("id")).mapInArrow(keys, "id long, bucket long")

    def work(unit: pa.Table) -> pa.RecordBatch | None:
        ids = unit.column("id").to_numpy()
        a, b = survivors(ids.view(np.uint64), unit.column("side").to_numpy(), radius, at)
        forest = Forest(len(ids))
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            forest.join(x, y)
        if not forest.edges:
            return None
        pairs = np.array(forest.edges)
        return pa.RecordBatch.from_arrays([pa.array(ids[pairs[:, 0]]), pa.array(ids[pairs[:, 1]])], names=["a", "b"])

    return units(keyed, tile).select("unit", "bucket", "side", "id").mapInArrow(each_unit(work), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, radius: int = 4, n_pivots: int = 10) -> DataFrame:
    """One row for each row of ``docs``: its id, ``fp`` and ``component_id`` (the smallest id reachable by links)."""
    marked = keep(fingerprints(docs, id_col, text_col, size), "fingerprints")
    classes = keep(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "fp-classes")
    found = components(linked(classes, radius, n_pivots))
    joined = found.join(classes, found["node"] == classes["fp"]).select("fp", "component", "least")
    joined = keep(joined, "fp-reached")
    least = keep(joined.groupBy("component").agg(F.min("least").alias("reach")), "fp-least")  # so that the join can split a large component
    reach = joined.join(least, "component").select("fp", "reach")
    named = keep(classes.join(reach, "fp", "left").select("fp", F.coalesce("reach", "least").alias("component_id")), "fp-components")
    return marked.join(named, "fp").select(id_col, "fp", "component_id")


# Near-duplicate texts: fingerprints only bring pairs together, exact similarity decides.


def shared_key_chance(bits: int, keys: int, p: float, radius: int) -> float:
    """Chance that two fingerprints whose 128 bits each differ with probability p lie within the radius and agree on all bits of a key."""
    total = 0.0
    for d in range(radius + 1):
        agree = math.comb(128 - d, bits) / math.comb(128, bits)
        total += math.comb(128, d) * p**d * (1 - p) ** (128 - d) * (1 - (1 - agree) ** keys)
    return total


def key_plan(n: int, threshold: float, recall: float) -> tuple[int, int, int]:
    """(bits of a key, number of keys, radius in 128 bits) for n classes.

    Two texts with Jaccard similarity J have shingle vectors at cosine 2J / (1 + J), so a fingerprint
    bit differs with probability angle / pi. The radius holds all but one in a thousand of the pairs at the
    threshold. Keys grow with the logarithm of n, so that a bucket of unrelated fingerprints stays below 8192
    members, and there are as many as give a pair at the threshold the wanted chance.
    """
    p = math.acos(2 * threshold / (1 + threshold)) / math.pi
    radius = min(128, math.ceil(128 * p + 3.1 * math.sqrt(128 * p * (1 - p))))
    bits = max(10, math.ceil(math.log2(max(n, 2))) - 12)
    keys = 1
    wanted = min(recall, 0.998)  # the radius alone loses one in a thousand
    while shared_key_chance(bits, keys, p, radius) < wanted:
        keys += max(1, keys // 20)
        if keys > 4096:
            raise ValueError(f"no plan of 4096 keys finds pairs at {threshold} with probability {recall} among {n} texts")
    return bits, keys, radius


def key_masks(bits: int, keys: int) -> list[tuple[int, int]]:
    """Random sets of ``bits`` of the 128 bits, as masks of the two fingerprints."""
    out = []
    for k in range(keys):
        chosen = random.Random(f"key {bits} {k}").sample(range(128), bits)
        out.append((sum(1 << b for b in chosen if b < 64), sum(1 << (b - 64) for b in chosen if b >= 64)))
    return out


def close_members(unit: pa.Table, key: int, masks: np.ndarray, radius: int, refs: np.ndarray) -> np.ndarray:
    """Rows of a unit that are within ``radius`` of the 128 bits of another, where no earlier key brings the pair together."""
    one, two = (unit.column(c).to_numpy().view(np.uint64) for c in ("fp", "fp2"))
    side = unit.column("side").to_numpy()
    tables = [np.sort((np.bitwise_count(one ^ r) + np.bitwise_count(two ^ ~r)).astype(np.int16)) for r in refs]
    left = [int(np.searchsorted(t, t + radius, side="right").sum()) for t in tables]
    best = refs[int(np.argmin(left))]  # the pivot that leaves the fewest pairs; all but some pairs of a unit are unrelated, so a second one costs more than the distance
    table = (np.bitwise_count(one ^ best) + np.bitwise_count(two ^ ~best)).astype(np.int16)
    order = np.argsort(table, kind="stable")
    ends = np.searchsorted(table[order], table[order] + radius, side="right")
    x, y = one[order], two[order]
    live = np.zeros(len(one), dtype=bool)
    step = max(16, CELLS // max(1, len(order)))
    for lo in range(0, len(order), step):
        hi = min(lo + step, len(order))
        top = int(ends[hi - 1])
        apart = np.bitwise_count(x[lo:hi, None] ^ x[None, lo:top])
        apart += np.bitwise_count(y[lo:hi, None] ^ y[None, lo:top])
        at = np.flatnonzero(apart <= radius)
        a, b = at // (top - lo), at % (top - lo)
        a, b = order[a[b > a] + lo], order[b[b > a] + lo]
        near = (side[a] != side[b]) | (side[a] < 0)
        a, b = a[near], b[near]
        if len(a) and key:
            p, q = one[a] ^ one[b], two[a] ^ two[b]
            early = np.zeros(len(a), dtype=bool)
            for m1, m2 in masks[:key]:
                early |= ((p & m1) | (q & m2)) == 0
            a, b = a[~early], b[~early]
        live[a] = live[b] = True
    return np.flatnonzero(live)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def text_components(docs: DataFrame, size: int = 5, threshold: float = 0.8, recall: float = 0.995, n_pivots: int = 4, filter_mb: float = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each distinct (id, text_hash): ``first``, the smallest (id, text_hash) of its component, and ``copies`` (its rows).

    Texts are linked if the Jaccard similarity of their distinct ``size``-word shingles is ``threshold`` or more,
    however often a shingle repeats in either; texts without words, null ones too, are equal to each other.
    """

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digest, one, two = [], [], []
            for t in batch.column(2):
                parts = words(t.as_py())
                cut = shingles(parts, size)
                digest.append(xxhash.xxh3_128_digest(b" ".join(parts)))
                distinct = list(set(cut))  # each votes once, as in the similarity that decides
                one.append(fingerprint(distinct, SEED))
                two.append(fingerprint(distinct, SEED + 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digest, pa.binary()), *[pa.array(np.array(x, np.uint64).view(np.int64)) for x in (one, two)]], names=["id", "text_hash", "digest", "fp", "fp2"])

    rows = _texts(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    marked = keep(rows.mapInArrow(marks, f"id {kind}, text_hash long, digest binary, fp long, fp2 long"), "text-marks")
    classes = marked.groupBy("digest").agg(F.first("fp").alias("fp"), F.first("fp2").alias("fp2"), F.min(F.struct("id", "text_hash")).alias("place"))
    classes = keep(classes.withColumn("class", F.monotonically_increasing_id()), "text-classes")
    bits, n_keys, radius = key_plan(classes.count(), threshold, recall)
    masks = key_masks(bits, n_keys)
    at, refs = np.array(masks, dtype=np.uint64), np.array(pivots(n_pivots), dtype=np.uint64)
    keys = [F.struct(F.lit(k).alias("key"), F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_long(a))), F.col("fp2").bitwiseAND(F.lit(_long(b)))).alias("bucket")) for k, (a, b) in enumerate(masks)]
    keyed = classes.select(F.col("class").alias("id"), "fp", "fp2", F.explode(F.array(*keys)).alias("k")).select("id", "fp", "fp2", "k.*")

    def work(unit: pa.Table) -> pa.RecordBatch | None:
        live = close_members(unit, unit.column("key")[0].as_py(), at, radius, refs)
        return unit.select(["unit", "bucket", "side", "id"]).take(pa.array(live)).combine_chunks().to_batches()[0] if len(live) else None

    met = units(keyed, TEXT_TILE).select("unit", "bucket", "side", "id", "fp", "fp2", "key").mapInArrow(each_unit(work), "unit long, bucket long, side byte, id long")
    met = keep(met, "text-pairs")
    spots = met.select("id").distinct().join(classes.select(F.col("class").alias("id"), "place.text_hash", F.xxhash64("place.id", "place.text_hash").alias("spot")), "id")
    spots = keep(spots, "text-spots")
    shared = docs.sparkSession.sparkContext.broadcast(bloom.build(spots.select("spot"), filter_mb))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            live = bloom.passing(batch.column(1).to_numpy().view(np.uint64), shared.value)
            out = [b"".join(sorted({xxhash.xxh3_64_digest(s) for s in shingles(words(batch.column(2)[i].as_py()), size)})) for i in live.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(live)), batch.column(1).take(pa.array(live)), pa.array(out, pa.binary())], names=["text_hash", "spot", "shingles"])

    wanted = rows.select("text_hash", F.xxhash64("id", "text_hash").alias("spot"), "text").mapInArrow(sets, "text_hash long, spot long, shingles binary")
    wanted = keep(wanted.join(spots, ["spot", "text_hash"]).dropDuplicates(["id"]).select("id", "shingles"), "text-sets")
    parts = components(jaccard_edges(met.join(wanted, "id").repartition("unit", "bucket"), threshold))
    named = classes.join(parts, classes["class"] == parts["node"], "left").select("digest", "place", F.coalesce("component", "class").alias("component"))
    named = keep(named, "text-parts")
    firsts = keep(named.groupBy("component").agg(F.min("place").alias("first")), "text-leaders")  # so that the join can split a large component
    named = keep(named.select("digest", "component").join(firsts, "component").select("digest", "first"), "text-components")
    return marked.groupBy("id", "text_hash", "digest").agg(F.count("*").alias("copies")).join(named, "digest").select("id", "text_hash", "copies", "first")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (of those, the smallest text hash)."""
    found = keep(text_components(docs, id_col=id_col, text_col=text_col, **options), "text-firsts")
    stay = found.where(F.struct("id", "text_hash").eqNullSafe(F.col("first"))).select("id", "text_hash")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("row_id", F.col(f"row.`{id_col}`")).withColumn("row_hash", F.xxhash64(F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))))
    out = rows.join(stay, rows["row_id"].eqNullSafe(stay["id"]) & (rows["row_hash"] == stay["text_hash"]))
    if not found.where("copies > 1").isEmpty():  # rows equal in id and text
        out = out.dropDuplicates(["id", "text_hash"])
    return out.select("row.*")
