"""Benchmark passages in training texts, found by spaced-seed hashing.

A mask names the word positions of a window that count; the others are ignored,
so a hash at such a position survives a substituted word there. Windows of test
items and of training texts are hashed under the same masks and joined. A hit
fixes an item, a text and the alignment of one on the other; the whole item is
then laid over the text and the longest stretch in which enough words agree is
the overlap.

Training windows far outnumber test windows, so each task first looks its
windows up in a Bloom filter of the test hashes, at most ``filter_mb`` large
however many items there are; survivors go to the exact join. Only texts with a
survivor leave the scan, as word hashes.

A pair is reported where an overlap has at least ``least_words`` agreeing words
(all of the item's if it has fewer) with at least ``agree`` of its words equal.
Each item is hashed under all masks that fit it; items of fewer than ``SHORT_BELOW``
words also under a shorter mask with four words, as three substitutions can leave
them no hit otherwise. Items that no mask fits are matched whole: under one hash of
all their words.

The words of an item stand once in a table of items and those of a text once in a
table of hits; an alignment carries the text's words under the item, never more than
the item has.

Results for odd input: null or empty texts, and items without words, match
nothing. Rows without an id are matched and reported with a null id. Repeated
rows are reported once for each. Equal items are each reported. Other columns
are ignored. An empty table on either side gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import bloom
from millrace.plans.scratch import keep

#: Spaced seeds: 1 counts, 0 is ignored (fixed values). Seven words of spans of ten to thirteen.
MASKS = ("1101101011", "11100101101", "110100011011", "1100110010101")
#: For items of fewer words than SHORT_BELOW (fixed values).
SHORT_MASK, SHORT_BELOW = "1101001", 30
_WORD = re.compile(r"\w+")
_M = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of a text's words: case-folded runs of letters, digits and underscores."""
    if not text:
        return np.empty(0, np.uint64)
    parts = _WORD.findall(text.lower())
    digest = xxhash.xxh3_64_digest
    return np.frombuffer(b"".join([digest(w) for w in parts]), dtype=">u8").astype(np.uint64)


def seed_hashes(words: np.ndarray, mask: str, number: int) -> np.ndarray:
    """A hash for every position at which the mask fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, number + 1, dtype=np.uint64)
    for j in [i for i, c in enumerate(mask) if c == "1"]:
        h *= _M
        h += words[j : j + n]
    h ^= h >> np.uint64(31)
    h *= _M
    return h ^ (h >> np.uint64(29))


def whole_hash(words: np.ndarray) -> int:
    """Under which an item too short for the masks is found."""
    return int(seed_hashes(words, "1" * len(words), 100 + len(words))[0])


def item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_row, item, n and words (binary) of every item that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column(1)):
                w = word_hashes(t.as_py())
                if len(w):
                    yield pa.RecordBatch.from_arrays([batch.column(2).slice(i, 1), batch.column(0).slice(i, 1), pa.array([len(w)], pa.int32()), pa.array([w.tobytes()], pa.binary())], names=["item_row", "item", "n", "words"])

    rows = items.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("item_row"))
    return rows.mapInArrow(run, f"item_row long, item {rows.schema['item'].dataType.simpleString()}, n int, words binary")


def own_masks(n: int, masks: tuple[str, ...]) -> list[tuple[str, int]]:
    """(mask, its number) of those that an item of ``n`` words is hashed under."""
    fit = [(m, k) for k, m in enumerate(masks) if len(m) <= n]
    if len(SHORT_MASK) <= n < SHORT_BELOW:
        fit.append((SHORT_MASK, len(masks)))
    return fit or [("1" * n, 100 + n)]


def item_seeds(words: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """item_row, seed, at and mask (its number) of every window of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                w = np.frombuffer(t.as_buffer(), np.uint64)
                for mask, k in own_masks(len(w), masks):
                    h = seed_hashes(w, mask, k)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), row)), pa.array(h.view(np.int64)), pa.array(np.arange(len(h), dtype=np.int32)), pa.array(np.full(len(h), k, np.int32))], names=["item_row", "seed", "at", "mask"])

    return words.select("item_row", "words").mapInArrow(run, "item_row long, seed long, at int, mask int")


def overlap(text: np.ndarray, item: np.ndarray, shift: int, agree: float) -> tuple[int, int, int]:
    """(first item word, words, agreeing words) of the longest stretch of ``item`` that ``text`` has from ``shift`` on.

    At least ``agree`` of the stretch's words are equal, and it begins and ends with an equal one. Of equally long ones the first.
    """
    lo, hi = max(0, -shift), min(len(item), len(text) - shift)
    if hi <= lo:
        return 0, 0, 0
    same = text[lo + shift : hi + shift] == item[lo:hi]
    gain = np.concatenate([[0.0], np.cumsum(same - agree)])
    start = np.searchsorted(-np.minimum.accumulate(gain), -gain - 1e-9)  # the first place from which the share is high enough
    end = int(np.argmax(np.arange(len(gain)) - start))
    hits = np.flatnonzero(same[start[end] : end])
    if not len(hits):
        return 0, 0, 0
    return lo + int(start[end] + hits[0]), int(hits[-1] - hits[0] + 1), len(hits)


def contaminated(docs: DataFrame, items: DataFrame, masks: tuple[str, ...] = MASKS, agree: float = 0.8, least_words: int = 12, filter_mb: float = 32, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row for each text and item with an overlap.

    Columns: the text's id, the item's id, ``text_at`` and ``item_at`` (first word of the overlap in
    each), ``n_words`` and ``n_equal`` (words of the overlap, and those that agree). With ``row_col``
    the pairs carry that column in place of ``id_col``.
    """
    items = keep(item_words(items, item_col, item_text_col), "items")
    seeds = keep(item_seeds(items, masks), "item-seeds")
    used = {r[0] for r in seeds.select("mask").distinct().collect()}  # the masks, and lengths below the shortest
    known = [*enumerate(masks), (len(masks), SHORT_MASK), *((100 + n, "1" * n) for n in range(1, max(map(len, masks))))]
    shared = docs.sparkSession.sparkContext.broadcast((bloom.build(seeds.select("seed"), filter_mb), [(m, k) for k, m in known if k in used]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, runs = shared.value
        for batch in batches:
            row, seed, at, words = [], [], [], []
            for i, t in enumerate(batch.column(1)):
                w = word_hashes(t.as_py())
                own_seed, own_at = [], []
                for mask, k in runs:
                    h = seed_hashes(w, mask, k)
                    live = bloom.passing(h, held)
                    if len(live):
                        own_seed.append(h[live].view(np.int64))
                        own_at.append(live)
                if own_seed:
                    row.append(i)
                    seed.append(np.concatenate(own_seed))
                    at.append(np.concatenate(own_at).astype(np.int32))
                    words.append(w.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(seed, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int32())), pa.array(words, pa.binary())], names=["id", "seeds", "ats", "words"])

    rows = docs.select(F.col(row_col or id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    hits = rows.mapInArrow(scan, f"id {kind}, seeds array<long>, ats array<int>, words binary").withColumn("row", F.monotonically_increasing_id())
    hits = keep(hits, "seed-hits")
    each = hits.select("row", F.explode(F.arrays_zip("seeds", "ats")).alias("s")).select("row", F.col("s.seeds").alias("seed"), F.col("s.ats").alias("text_pos"))
    test = seeds.select("seed", "item_row", "at")
    aligned = each.join(test, "seed").select("row", "item_row", (F.col("text_pos") - F.col("at")).alias("shift")).distinct()
    aligned = aligned.join(items.select("item_row", "n"), "item_row").groupBy("row").agg(F.collect_list(F.struct("item_row", "shift", "n")).alias("places"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, places in enumerate(batch.column("places")):
                text, found = np.frombuffer(batch.column("words")[i].as_buffer(), np.uint64), places.as_py()
                for lo in range(0, len(found), 1000):
                    part = found[lo : lo + 1000]
                    under = [text[max(0, p["shift"]) : max(0, p["shift"] + p["n"])].tobytes() for p in part]
                    which = pa.array([i] * len(part))
                    yield pa.RecordBatch.from_arrays([batch.column("row").take(which), batch.column("id").take(which), pa.array([p["item_row"] for p in part], pa.int64()), pa.array([p["shift"] for p in part], pa.int32()), pa.array(under, pa.binary())], names=["row", "id", "item_row", "shift", "under"])

    laid = aligned.join(hits.select("row", "id", "words"), "row").mapInArrow(cut, f"row long, id {kind}, item_row long, shift int, under binary")
    laid = keep(laid, "laid-out")  # else, where the items are broadcast, one stage would hold two Python workers a core, which stay
    pairs = laid.join(items.select("item_row", "item", F.col("words").alias("item_words")), "item_row")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep_at, out = [], []
            for i in range(batch.num_rows):
                item = np.frombuffer(batch.column("item_words")[i].as_buffer(), np.uint64)
                under = np.frombuffer(batch.column("under")[i].as_buffer(), np.uint64)
                shift = batch.column("shift")[i].as_py()
                first, n, good = overlap(under, item, min(0, shift), agree)
                if good and good >= min(least_words, len(item)):
                    keep_at.append(i)
                    out.append((first + shift, first, n, good))
            got = np.array(out, np.int32).reshape(-1, 4)
            which = pa.array(keep_at, pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(which) for c in ("row", "item_row", "id", "item")], *[pa.array(np.ascontiguousarray(got[:, k])) for k in range(4)]], names=["row", "item_row", "id", "item", "text_at", "item_at", "n_words", "n_equal"])

    item_kind = items.schema["item"].dataType.simpleString()
    pairs = pairs.select("row", "item_row", "id", "item", "shift", "item_words", "under")
    found = pairs.mapInArrow(verify, f"row long, item_row long, id {kind}, item {item_kind}, text_at int, item_at int, n_words int, n_equal int")
    best = found.groupBy("row", "item_row").agg(F.min_by(F.struct("id", "item", "text_at", "item_at", "n_words", "n_equal"), F.struct(-F.col("n_equal"), "n_words", "text_at")).alias("b"))
    return best.select(F.col("b.id").alias(row_col or id_col), F.col("b.item").alias(item_col), "b.text_at", "b.item_at", "b.n_words", "b.n_equal")


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text overlaps with no item, with all their columns, whatever their names.

    Texts are told apart by a hash of 128 bits, so equal ones share a verdict; a null text overlaps with nothing.
    """
    text = F.col(f"row.`{text_col}`").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("text", text).withColumn("text_hash", F.md5(text.cast("binary")))
    found = contaminated(rows.select("text", "text_hash"), items, id_col="text_hash", text_col="text", row_col="text_hash", **options)
    leaks = keep(found.select("text_hash").distinct(), "leaks")
    return rows.join(leaks, "text_hash", "left_anti").select("row.*")
