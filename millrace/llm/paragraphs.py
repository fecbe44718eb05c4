"""Repeated passages found by MinHash banding of paragraphs.

There are two kinds of paragraphs. All words are lower-cased.

* Lines of ``least_words`` words or more, which may differ a little. Equal lines form a class. Each
  class gets MinHash values of its word shingles, in bands tuned so that two lines at the threshold
  share one with the wanted probability; classes that share a band meet, and their exact Jaccard
  similarity is computed. Connected components over classes name the copies. In a text, adjacent
  lines that have copies form a passage, with the short lines between them; passages of
  ``passage_words`` words or more are reported (``copied``), so a common short line alone is not.
* Stretches of the word stream, whatever lines it is broken into, which must be equal. Every window
  of 23 three-word shingles gets its MinHash; the shingle that is least begins a paragraph of 23
  words. An equal run of 45 words, wherever it begins and ends, holds a whole such window and the
  paragraph that begins in it, so both copies have that paragraph. Paragraphs of equal words collide
  and form a class, which is its own component. Adjacent copied paragraphs form a chain; from its ends
  the texts are compared word by word with the first occurrence, so passages end where the words
  differ, not where a paragraph does. Chains of ``passage_words`` words or more are reported (``runs``).

The first occurrence of each paragraph (smallest id, then text hash, then place) is the one kept.
``repeated`` is the union of both kinds; ``without_copies`` takes both out of the texts.

A text row is known by its id and the hash of its text: rows equal in both count as one text.
Results for odd input: null and empty texts have no paragraphs. A null id sorts first. A paragraph
that is repeated inside one text counts as copied. Every word of a copy has the same word at an earlier
place, and that at an earlier one if it is a copy too, so what is taken out always stays in some text.
Other columns are ignored (``without_copies`` returns them, whatever their names). An empty table
gives no rows. A text in which the least shingle of a window occurs twice in it may lose that window.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, StringType

from millrace.llm import bloom
from millrace.plans.buckets import Forest, each_unit, units
from millrace.operators.components import components
from millrace.plans.scratch import keep

TILE = 1024
#: Members of a unit up to which pairs are taken one by one.
FEW = 40
#: Words of an anchored paragraph, shingles of a window whose least begins one, words of a shingle. Equal runs of UNIT + AROUND - 1 words share one;
#: with UNIT no less than AROUND the paragraphs of a run leave no gap.
UNIT, AROUND, GRAM = 23, 23, 3
#: Words next to a chain's end that are compared; more than AROUND - 1, so that the ends of equal runs are reached.
CONTEXT = 32
_C = np.uint64(0x9E3779B97F4A7C15)
_WHITE = np.array([chr(c).isspace() for c in range(0x3002)])


def tuned_bands(threshold: float, recall: float, rows: int = 3) -> int:
    """Bands of ``rows`` values that make a pair at the threshold meet with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= _C
    return h ^ (h >> np.uint64(29))


def word_hashes(words: list[str]) -> np.ndarray:
    digest = xxhash.xxh3_64_digest
    return np.frombuffer(b"".join([digest(w) for w in words]), dtype=">u8").astype(np.uint64)


def word_spans(text: str) -> np.ndarray:
    """(first character, the one after the last) of each word."""
    white = np.zeros(len(text) + 2, dtype=bool)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    white[[0, -1]] = True
    white[1:-1] = _WHITE[np.minimum(code, len(_WHITE) - 1)]
    edge = np.flatnonzero(white[1:] != white[:-1])
    return edge.reshape(-1, 2)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words."""
    n = len(words) - size + 1
    h = np.zeros(max(n, 0), dtype=np.uint64)
    for j in range(size if n > 0 else 0):
        h = h * _C + words[j : j + n]
    return _mix(h)


def lines_of(text: str | None, least: int) -> list[tuple[int, int, int, list[str]]]:
    """(line number, character offset, words of the lines before, lower-cased words) of the lines with at least ``least`` words."""
    out, start, before = [], 0, 0
    for i, line in enumerate((text or "").split("\n")):
        words = line.lower().split()
        if len(words) >= least:
            out.append((i, start, before, words))
        start += len(line) + 1
        before += len(words)
    return out


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(7)
    return r.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 1 << 63, n, dtype=np.uint64)


def band_values(starts: np.ndarray, shingles: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """For each paragraph (its shingles begin at ``starts``) one hash for each band."""
    a, b = _multipliers(bands * rows)
    out = np.empty((len(starts), bands), dtype=np.uint64)
    for k in range(bands):
        h = np.full(len(starts), k + 1, dtype=np.uint64)
        for j in range(k * rows, (k + 1) * rows):
            h = _mix(h * _C + np.minimum.reduceat(_mix(shingles * a[j] + b[j]), starts))
        out[:, k] = h
    return out


def _identity(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def paragraphs(docs: DataFrame, size: int, bands: int, rows: int, least_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each paragraph: id, text_hash, line, ordinal (among the text's paragraphs), start, length, before (words of the lines before), n_words, digest, bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                row, line, ordinal, start, length, before, count, digest, hashes = [], [], [], [], [], [], [], [], []
                for i, t in enumerate(part.column(2)):
                    text = t.as_py()
                    found = lines_of(text, least_words)
                    for k, (number, at, earlier, words) in enumerate(found):
                        row.append(i)
                        line.append(number)
                        ordinal.append(k)
                        start.append(at)
                        length.append((text.find("\n", at) + 1 or len(text) + 1) - 1 - at)
                        before.append(earlier)
                        count.append(len(words))
                        digest.append(xxhash.xxh3_128_digest(" ".join(words)))
                    if found:
                        hashes.append(word_hashes([w for *_, words in found for w in words]))
                if not row:
                    continue
                words = np.concatenate(hashes)
                n = np.array(count)
                ends = np.cumsum(n)
                shingled = np.concatenate([shingle_hashes(words, size), np.zeros(min(size - 1, len(words)), np.uint64)])
                inside = np.ones(len(words), dtype=bool)  # shingles that do not cross into the next paragraph
                for j in range(1, size):
                    inside[ends[n >= j] - j] = False
                kept = np.maximum(n - size + 1, 0)
                first = np.cumsum(kept) - kept
                values = band_values(first, shingled[inside], bands, rows)
                cols = [part.column(0).take(pa.array(row, pa.int64())), part.column(1).take(pa.array(row, pa.int64())), *[pa.array(np.array(x, np.int32)) for x in (line, ordinal, start, length, before, count)]]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, bands, dtype=np.int32)), pa.array(values.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([*cols, pa.array(digest, pa.binary()), lists], names=["id", "text_hash", "line", "ordinal", "start", "length", "before", "n_words", "digest", "bands"])

    if least_words < size:
        raise ValueError("a paragraph needs at least the words of one shingle")
    known = _identity(docs, id_col, text_col)
    kind = known.schema["id"].dataType.simpleString()
    return known.mapInArrow(run, f"id {kind}, text_hash long, line int, ordinal int, start int, length int, before int, n_words int, digest binary, bands array<long>")


def _spot(id_: Column, text_hash: Column, line: Column) -> Column:
    return F.xxhash64(id_, text_hash, line)


def shingle_sets(docs: DataFrame, wanted: DataFrame, size: int, filter_mb: float, id_col: str, text_col: str) -> DataFrame:
    """spot, text_hash, line and shingles (sorted distinct hashes, binary) of the lines whose spot is among ``wanted``; maybe of more."""
    shared = docs.sparkSession.sparkContext.broadcast(bloom.build(wanted, filter_mb))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            at = batch.column(0).to_numpy().view(np.uint64)
            live = bloom.passing(at, held)
            out = [np.unique(shingle_hashes(word_hashes(batch.column(3)[i].as_py().lower().split()), size)).tobytes() for i in live.tolist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(live)) for k in range(3)], pa.array(out, pa.binary())], names=["spot", "text_hash", "line", "shingles"])

    lines = _identity(docs, id_col, text_col).select("id", "text_hash", F.posexplode(F.split("text", "\n")).alias("line", "words"))
    lines = lines.select(_spot(F.col("id"), F.col("text_hash"), F.col("line")).alias("spot"), "text_hash", "line", "words")
    return lines.mapInArrow(run, "spot long, text_hash long, line int, shingles binary")


def _link_few(sets: list[np.ndarray], side: np.ndarray, threshold: float, forest: Forest) -> None:
    """Joins pairs that are similar enough one by one."""
    own = [set(s.tolist()) for s in sets]
    size = [len(s) for s in own]
    order = np.argsort(size, kind="stable").tolist()
    find = forest.find
    for p, x in enumerate(order):
        most = size[x] / threshold + 1e-9
        for y in order[p + 1 :]:
            if size[y] > most:  # sizes too far apart, as are all that follow
                break
            if side[x] == side[y] >= 0 or find(x) == find(y):
                continue
            both = len(own[x] & own[y])
            if both >= threshold * (size[x] + size[y] - both) - 1e-9:
                forest.join(x, y)


def _link_many(sets: list[np.ndarray], side: np.ndarray, threshold: float, forest: Forest) -> None:
    """The same; each member's overlaps with all larger ones are counted at once."""
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    size, side = size[order], side[order]
    names, flat = np.unique(np.concatenate([sets[i] for i in order.tolist()]), return_inverse=True)
    ends = np.concatenate([[0], np.cumsum(size)])
    last = np.searchsorted(size, size / threshold + 1e-9, side="right")
    part = np.arange(len(sets))  # the component that each is in as yet
    own = np.zeros(len(names), dtype=bool)
    for x, top in enumerate(last.tolist()):
        live = (part[x + 1 : top] != part[x]) & ((side[x + 1 : top] != side[x]) | (side[x] < 0))
        if not live.any():
            continue
        mine = flat[ends[x] : ends[x + 1]]
        own[mine] = True
        total = np.concatenate([[0], np.cumsum(own[flat[ends[x + 1] : ends[top]]], dtype=np.int64)])
        own[mine] = False
        both = np.diff(total[ends[x + 1 : top + 1] - ends[x + 1]])
        for y in (x + 1 + np.flatnonzero(live & (both >= threshold * (size[x] + size[x + 1 : top] - both) - 1e-9))).tolist():
            if forest.join(int(order[x]), int(order[y])):
                part[part == part[y]] = part[x]


def jaccard_edges(tile_rows: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) of members of one unit whose sets (``shingles``) are similar enough; enough edges to connect them all."""

    def work(unit: pa.Table) -> pa.RecordBatch | None:
        ids, side = unit.column("id").to_numpy(), unit.column("side").to_numpy()
        forest = Forest(len(ids))
        link = _link_few if len(ids) <= FEW else _link_many
        link([np.frombuffer(s.as_py(), np.uint64) for s in unit.column("shingles")], side, threshold, forest)
        if not forest.edges:
            return None
        e = np.array(forest.edges)
        return pa.RecordBatch.from_arrays([pa.array(ids[e[:, 0]]), pa.array(ids[e[:, 1]])], names=["a", "b"])

    return tile_rows.select("unit", "bucket", "side", "id", "shingles").sortWithinPartitions("unit", "bucket", "side", "id").mapInArrow(each_unit(work), "a long, b long")


def without_repeats(rows: DataFrame) -> DataFrame:
    """``rows`` (bucket, id) with one of each set of buckets that have the same members, and only buckets with two or more."""
    signs = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("s1"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("s2")).where("n > 1")
    one = signs.groupBy("n", "s1", "s2").agg(F.min("bucket").alias("bucket")).select("bucket")
    return rows.join(one, "bucket", "left_semi")


def copied(docs: DataFrame, size: int = 5, threshold: float = 0.8, recall: float = 0.99, rows: int = 2, least_words: int = 5, passage_words: int = 45, filter_mb: float = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Paragraphs of repeated passages.

    Columns: ``id_col``, text_hash, line, start and length (characters), n_words, component (any number, one
    for all copies), n_copies (paragraphs in the component) and kept (the component's first paragraph).
    """
    bands = tuned_bands(threshold, recall, rows)
    found = keep(paragraphs(docs, size, bands, rows, least_words, id_col, text_col), "paragraphs")
    place = F.struct("id", "text_hash", "line")
    classes = found.select("digest", "bands", place.alias("place")).groupBy("digest").agg(F.first("bands").alias("bands"), F.min("place").alias("place"), F.count("*").alias("n"))
    classes = keep(classes.withColumn("class", F.monotonically_increasing_id()), "paragraph-classes")

    met = keep(without_repeats(classes.select(F.explode("bands").alias("bucket"), F.col("class").alias("id"))), "paragraph-bands")
    spot = _spot(F.col("place.id"), F.col("place.text_hash"), F.col("place.line"))
    spots = met.select("id").distinct().join(classes.select(F.col("class").alias("id"), spot.alias("spot"), "place.text_hash", "place.line"), "id")
    spots = keep(spots, "paragraph-spots")
    sets = shingle_sets(docs, spots.select("spot"), size, filter_mb, id_col, text_col)
    sets = keep(sets.join(spots, ["spot", "text_hash", "line"]).dropDuplicates(["id"]).select("id", "shingles"), "paragraph-sets")
    dealt = units(met, TILE, deal=False).join(sets, "id").repartition("unit", "bucket")
    parts = components(jaccard_edges(dealt, threshold))

    named = classes.join(parts, classes["class"] == parts["node"], "left").select("digest", "place", "n", F.coalesce("component", "class").alias("component"))
    sizes = named.groupBy("component").agg(F.sum("n").alias("n_copies"), F.min("place").alias("first")).where("n_copies > 1")
    repeated = keep(named.select("digest", "component").join(sizes, "component"), "repeated-classes")
    members = found.drop("bands").join(repeated, "digest")
    text = Window.partitionBy("id", "text_hash").orderBy("ordinal")
    run = members.dropDuplicates(["id", "text_hash", "ordinal"]).withColumn("_run", F.col("ordinal") - F.row_number().over(text))
    passage = Window.partitionBy("id", "text_hash", "_run")
    run = run.withColumn("_words", F.max(F.col("before") + F.col("n_words")).over(passage) - F.min("before").over(passage)).where(F.col("_words") >= passage_words)
    here = F.struct("id", "text_hash", "line")
    return run.select(F.col("id").alias(id_col), "text_hash", "line", "start", "length", "n_words", "component", "n_copies", here.eqNullSafe(F.col("first")).alias("kept"))


def sliding_least(a: np.ndarray, n: int) -> np.ndarray:
    """The least of every ``n`` adjacent values."""
    done = 1
    while done < n:
        step = min(done, n - done)
        a = np.minimum(a[:-step], a[step:])
        done += step
    return a


def anchors(h: np.ndarray, around: int = AROUND) -> np.ndarray:
    """Places of the least of every ``around`` adjacent values (their upper 54 bits), of equal ones the last.

    Where values repeat so often that more than every fourth place would be one, a place stays until it leaves the window.
    """
    n = len(h) - around + 1
    if n <= 0:
        return np.empty(0, np.int64)
    low = np.uint64(1023)  # the lowest bits name the place, and of equal values let the last be least
    least = sliding_least((h | low) - (np.arange(len(h), dtype=np.uint64) & low), around)
    window = np.arange(n)
    at = window + (((low - (least & low)).astype(np.int64) - window) & 1023)
    found = at[np.concatenate([[True], at[1:] != at[:-1]])]
    if 4 * len(found) <= n:
        return found
    out, value = [-1], least | low
    for j, (p, x) in enumerate(zip(at.tolist(), value.tolist(), strict=True)):
        if out[-1] < j or x != last:
            out.append(p)
            last = x
    return np.array(out[1:])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hashes' multiplier and of its inverse."""
    if len(_POWERS[0]) < n:
        size = 1 << n.bit_length()
        for k, base in enumerate((int(_C), pow(int(_C), -1, 1 << 64))):
            with np.errstate(over="ignore"):
                _POWERS[k] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, base, np.uint64))])
    return _POWERS[0][:n], _POWERS[1][:n]


_POWERS = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def anchored(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash of all its words) of every anchored paragraph."""
    parts = (text or "").lower().split()
    if len(parts) < UNIT + AROUND - 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    words = word_hashes(parts)
    at = anchors(shingle_hashes(words, GRAM))
    at = at[at <= len(words) - UNIT]
    up, down = _powers(len(words) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(words * up[:-1])])
    return at, _mix((total[at + UNIT] - total[at]) * down[at])


def chains(places: list[int]) -> list[tuple[int, int]]:
    """(number of the first, of the last) of the sorted ``places`` in each stretch whose paragraphs leave no gap."""
    out: list[tuple[int, int]] = []
    for i, p in enumerate(places):
        if out and p <= places[i - 1] + UNIT:
            out[-1] = (out[-1][0], i)
        else:
            out.append((i, i))
    return out


def _key(id_: Column, text_hash: Column) -> Column:
    return F.xxhash64(id_, text_hash)


def _maybe_among(keys: DataFrame, filter_mb: float) -> Callable[[Column], Column]:
    """A condition that lets every key in ``keys``, and maybe others, through. Python sees the key alone, never a row's text.

    What passes is joined by a shuffle (hint ``merge``): with a broadcast, Python code after the join would run in the same
    stage, and each core would hold two Python workers for the rest of the application.
    """
    shared = keys.sparkSession.sparkContext.broadcast(bloom.build(keys, filter_mb))

    @pandas_udf(BooleanType())
    def live(key: pd.Series) -> pd.Series:
        out = np.zeros(len(key), dtype=bool)
        out[bloom.passing(key.to_numpy().view(np.uint64), shared.value)] = True
        return pd.Series(out)

    return live


def _chained(docs: DataFrame, filter_mb: float, id_col: str, text_col: str) -> DataFrame:
    """id, text_hash, chain, begin, end, component, n_copies, and for each end the id, text_hash and place of the first occurrence of the paragraph there."""
    known = _identity(docs, id_col, text_col)
    kind = known.schema["id"].dataType.simpleString()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchored(t.as_py()) for t in batch.column(2)]
            ends = pa.array(np.cumsum([0, *(len(at) for at, _ in found)]).astype(np.int32))
            places, hashes = np.concatenate([*(x for x, _ in found), np.empty(0, np.int64)]), np.concatenate([*(x for _, x in found), np.empty(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(ends, pa.array(places.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(hashes.view(np.int64)))], names=["id", "text_hash", "places", "digests"])

    every = keep(known.mapInArrow(digests, f"id {kind}, text_hash long, places array<int>, digests array<long>").where(F.size("places") > 0), "stretches")
    twice = every.select(F.explode("digests").alias("digest")).groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    shared = docs.sparkSession.sparkContext.broadcast(bloom.build(keep(twice, "repeated-stretches"), filter_mb))

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, digests = batch.column(2), batch.column(3).flatten().to_numpy().view(np.uint64)
            live = bloom.passing(digests, shared.value)
            row = pa.array(np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))[live])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), lists.flatten().take(pa.array(live)), pa.array(digests[live].view(np.int64))], names=["id", "text_hash", "place", "digest"])

    found = keep(every.mapInArrow(units, f"id {kind}, text_hash long, place int, digest long"), "repeated-places")
    place = F.struct("id", "text_hash", "place")
    seen = found.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("n")).where(~F.col("first").eqNullSafe(F.col("last"))).drop("last")
    seen = keep(seen, "first-places")  # a table of its own, so that the join can split a common digest
    texts = found.join(seen, "digest").where(~place.eqNullSafe(F.col("first"))).groupBy("id", "text_hash").agg(F.collect_set(F.struct("place", "digest", "n", "first")).alias("units"))
    first = f"struct<id:{kind},text_hash:bigint,place:int>"

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for i, units in enumerate(batch.column(2)):
                units = sorted(units.as_py(), key=lambda u: u["place"])
                for x, y in chains([u["place"] for u in units]):
                    rows.append(i)
                    out.append((units[x]["place"], units[y]["place"] + UNIT, units[x]["digest"], units[x]["n"], units[x]["first"], units[y]["first"]))
            cols = list(zip(*out, strict=True)) or [()] * 6
            place_kind = batch.schema.field(2).type.value_type.field("first").type
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), place_kind, place_kind]
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), batch.column(1).take(pa.array(rows, pa.int64())), *arrays], names=["id", "text_hash", "begin", "end", "component", "n_copies", "first_left", "first_right"])

    made = texts.mapInArrow(link, f"id {kind}, text_hash long, begin int, end int, component long, n_copies long, first_left {first}, first_right {first}")
    return keep(made.withColumn("chain", F.monotonically_increasing_id()), "chains")


def _contexts(docs: DataFrame, wanted: DataFrame, filter_mb: float, id_col: str, text_col: str) -> DataFrame:
    """For each wanted (key, text_hash, at, side): ``words`` (hashes, going away from ``at``) and ``chars`` (character offsets of the edge after 0, 1, ... of them, and last of the far edge of a paragraph that has its near edge at ``at``)."""
    grouped = keep(wanted.groupBy("key", "text_hash").agg(F.collect_set(F.struct("at", "side")).alias("ends")), "passage-ends")
    live = _maybe_among(grouped.select("key"), filter_mb)
    texts = _identity(docs, id_col, text_col).where("text_hash is not null and text is not null").select(_key(F.col("id"), F.col("text_hash")).alias("key"), "text_hash", "text")
    texts = texts.where(live(F.col("key"))).join(grouped.hint("merge"), ["key", "text_hash"]).select("key", "text_hash", "text", "ends")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py()
                spans, parts = word_spans(text), text.lower().split()
                ends = batch.column(3)[i].as_py()
                hashes, chars = [], []
                for e in ends:
                    p = e["at"]
                    if e["side"] == 0:
                        lo = max(0, p - CONTEXT)
                        hashes.append(word_hashes(parts[lo:p])[::-1].tobytes())
                        chars.append(np.append(spans[lo : p + 1, 0][::-1], spans[min(p + UNIT, len(spans)) - 1, 1]).astype(np.int32).tobytes())
                    else:
                        hashes.append(word_hashes(parts[p : p + CONTEXT]).tobytes())
                        chars.append(np.append(spans[p - 1 : p + CONTEXT, 1], spans[max(0, p - UNIT), 0]).astype(np.int32).tobytes())
                row = pa.array([i] * len(ends), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array([e["at"] for e in ends], pa.int32()), pa.array([e["side"] for e in ends], pa.int32()), pa.array(hashes, pa.binary()), pa.array(chars, pa.binary())], names=["key", "text_hash", "at", "side", "words", "chars"])

    return keep(texts.mapInArrow(cut, "key long, text_hash long, at int, side int, words binary, chars binary").dropDuplicates(["key", "text_hash", "at", "side"]), "passage-contexts")


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """chain, side, words that agree beyond the end, and the character offsets of the new end in the copy and in the first occurrence, there of the paragraph's far edge too."""
    for batch in batches:
        more, here, there, far = [], [], [], []
        for words, first, chars, first_chars in zip(*[batch.column(c).to_pylist() for c in ("words", "first_words", "chars", "first_chars")], strict=True):
            a, b = np.frombuffer(words, np.uint64), np.frombuffer(first, np.uint64)
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            more.append(int(differ[0]) if len(differ) else m)
            here.append(int(np.frombuffer(chars, np.int32)[more[-1]]))
            there.append(int(np.frombuffer(first_chars, np.int32)[more[-1]]))
            far.append(int(np.frombuffer(first_chars, np.int32)[-1]))
        yield pa.RecordBatch.from_arrays([batch.column("chain"), batch.column("side"), pa.array(more, pa.int32()), pa.array(here, pa.int32()), pa.array(there, pa.int32()), pa.array(far, pa.int32())], names=["chain", "side", "more", "char", "first_char", "far_char"])


def merged(spans: list[dict]) -> list[tuple[int, int, int, int, int, int]]:
    """(first word, word after the last, start, end, component, copies) of the stretches that overlapping or adjacent spans cover."""
    out: list[list[int]] = []
    for s in sorted(spans, key=lambda s: (s["a"], s["b"])):
        if out and s["a"] <= out[-1][1]:
            if s["b"] > out[-1][1]:
                out[-1][1], out[-1][3] = s["b"], s["end"]
            out[-1][4:] = [min(out[-1][4], s["component"]), max(out[-1][5], s["n_copies"])]
        else:
            out.append([s["a"], s["b"], s["start"], s["end"], s["component"], s["n_copies"]])
    return [tuple(x) for x in out]


def runs(docs: DataFrame, passage_words: int = 45, filter_mb: float = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Equal runs of ``passage_words`` words or more, wherever they begin and end.

    Columns: ``id_col``, text_hash, start and length (characters), first_word, n_words, component (a number that copies
    of one passage share), n_copies (places of the paragraph that begins it) and kept (the first occurrence).
    """
    found = _chained(docs, filter_mb, id_col, text_col)
    kind = found.schema["id"].dataType.simpleString()
    ends = []
    for side, name, at, first_at in ((0, "left", "begin", "place"), (1, "right", "end", f"place + {UNIT}")):
        ends.append(found.select("chain", "id", "text_hash", F.lit(side).alias("side"), F.col(at).alias("at"), F.col(f"first_{name}").alias("first"), F.expr(f"first_{name}.{first_at}").alias("first_at")))
    ends = ends[0].unionByName(ends[1]).withColumn("key", _key(F.col("id"), F.col("text_hash"))).withColumn("first_key", _key(F.col("first.id"), F.col("first.text_hash")))
    first = ends.select(F.col("first_key").alias("key"), F.col("first.text_hash").alias("text_hash"), F.col("first_at").alias("at"), "side").distinct()
    near = _contexts(docs, ends.select("key", "text_hash", "at", "side").union(first), filter_mb, id_col, text_col)
    own = ends.select("chain", "side", "key", "text_hash", "at", "first_key", F.col("first.text_hash").alias("first_hash"), "first_at").join(near, ["key", "text_hash", "at", "side"])
    other = near.select(F.col("key").alias("first_key"), F.col("text_hash").alias("first_hash"), F.col("at").alias("first_at"), "side", F.col("words").alias("first_words"), F.col("chars").alias("first_chars"))
    both = own.join(other, ["first_key", "first_hash", "first_at", "side"]).select("chain", "side", "words", "chars", "first_words", "first_chars")
    grown = both.mapInArrow(_extended, "chain long, side int, more int, char int, first_char int, far_char int")
    at = lambda side, col: F.max(F.when(F.col("side") == side, F.col(col)))
    grown = grown.groupBy("chain").agg(*[at(i, c).alias(f"{c}_{n}") for i, n in ((0, "left"), (1, "right")) for c in ("more", "char", "first_char", "far_char")])
    full = found.join(grown, "chain").withColumn("a", F.col("begin") - F.col("more_left")).withColumn("b", F.col("end") + F.col("more_right")).where(F.col("b") - F.col("a") >= passage_words)
    full = keep(full, "passages")
    span = lambda a, b, start, end: F.struct(a.alias("a"), b.alias("b"), start.alias("start"), end.alias("end"), "component", "n_copies")
    copies = full.select("id", "text_hash", span(F.col("a"), F.col("b"), F.col("char_left"), F.col("char_right")).alias("span"), F.lit(False).alias("kept"))
    # the first occurrence lies in one piece where both ends point to one text at the same distance; else the pieces at the ends are named
    left, right, size = F.col("first_left"), F.col("first_right"), F.col("end") - F.col("begin")
    whole = left["id"].eqNullSafe(right["id"]) & left["text_hash"].eqNullSafe(right["text_hash"]) & (right["place"] + UNIT - left["place"]).eqNullSafe(size)
    at_left, at_right = left["place"] - F.col("more_left"), right["place"] + UNIT + F.col("more_right")
    pieces = [
        (whole, left, span(at_left, at_right, F.col("first_char_left"), F.col("first_char_right"))),
        (~whole, left, span(at_left, left["place"] + UNIT, F.col("first_char_left"), F.col("far_char_left"))),
        (~whole, right, span(right["place"], at_right, F.col("far_char_right"), F.col("first_char_right"))),
    ]
    stay = [full.where(cond).select(first["id"].alias("id"), first["text_hash"].alias("text_hash"), piece.alias("span"), F.lit(True).alias("kept")) for cond, first, piece in pieces]
    rows = copies.union(stay[0]).union(stay[1]).union(stay[2]).groupBy("id", "text_hash", "kept").agg(F.collect_set("span").alias("spans"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, out = [], []
            for i, spans in enumerate(batch.column(3)):
                for a, b, start, end, component, n in merged(spans.as_py()):
                    row.append(i)
                    out.append((start, end - start, a, b - a, component, n))
            cols = list(zip(*out, strict=True)) or [()] * 6
            which = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(which), batch.column(1).take(which), *[pa.array(c, t) for c, t in zip(cols, [pa.int32()] * 4 + [pa.int64()] * 2, strict=True)], batch.column(2).take(which)], names=[id_col, "text_hash", "start", "length", "first_word", "n_words", "component", "n_copies", "kept"])

    return rows.mapInArrow(join, f"`{id_col}` {kind}, text_hash long, start int, length int, first_word int, n_words int, component long, n_copies long, kept boolean")


def repeated(docs: DataFrame, filter_mb: float = 32, id_col: str = "doc_id", text_col: str = "text", passage_words: int = 45, **options) -> DataFrame:
    """Both kinds: the columns of ``copied`` with ``kind`` ("line" or "run"); a run has no line number."""
    lines = copied(docs, passage_words=passage_words, filter_mb=filter_mb, id_col=id_col, text_col=text_col, **options)
    words = runs(docs, passage_words, filter_mb, id_col, text_col).withColumn("line", F.lit(None).cast("int"))
    names = [id_col, "text_hash", "line", "start", "length", "n_words", "component", "n_copies", "kept"]
    return lines.select(F.lit("line").alias("kind"), *names).unionByName(words.select(F.lit("run").alias("kind"), *names))


def remaining(text: str, lines: set[int], spans: list[tuple[int, int]]) -> str:
    """``text`` without these lines and without the words of these spans (first, number); lines that lose all their words go."""
    out, before = [], 0
    gone = np.zeros(len(text.split()), dtype=bool)
    for a, n in spans:
        gone[a : a + n] = True
    for i, line in enumerate(text.split("\n")):
        n = len(line.split())
        cut = gone[before : before + n]
        before += n
        if i in lines or n and cut.all():
            continue
        if cut.any():
            spots = [m.span() for m in re.finditer(r"\S+", line)]
            edge = np.flatnonzero(np.diff(np.concatenate([[True], cut, [True]]).astype(np.int8))).tolist()
            line = " ".join(line[spots[a][0] : spots[b - 1][1]] for a, b in zip(edge[::2], edge[1::2], strict=True))
        out.append(line)
    return "\n".join(out)


@pandas_udf(StringType())
def _remaining(text: pd.Series, lines: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if x is None or t is None else remaining(t, set(x.tolist()), [(y["first_word"], y["n_words"]) for y in p]) for t, x, p in zip(text, lines, spans, strict=True)], dtype=object)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_mb: float = 32, passage_words: int = 45, **options) -> DataFrame:
    """``docs`` with all columns and rows, but of each repeated passage only the first occurrence: its lines (``copied``) and its words (``runs``).

    Only rows that lose something, and the few that a Bloom filter takes for such, go through a join and to Python.
    """
    lines = copied(docs, id_col=id_col, text_col=text_col, filter_mb=filter_mb, passage_words=passage_words, **options).where("not kept")
    lines = lines.select(F.col(id_col).alias("id"), "text_hash", "line", F.lit(None).cast("struct<first_word:int,n_words:int>").alias("span"))
    words = runs(docs, passage_words, filter_mb, id_col, text_col).where("not kept")
    words = words.select(F.col(id_col).alias("id"), "text_hash", F.lit(None).cast("int").alias("line"), F.struct("first_word", "n_words").alias("span"))
    gone = lines.unionByName(words).groupBy("id", "text_hash").agg(F.collect_set("line").alias("lines"), F.collect_set("span").alias("spans"))
    gone = keep(gone, "passages-to-go")
    live = _maybe_among(gone.select(_key(F.col("id"), F.col("text_hash")).alias("key")), filter_mb)(F.col("key"))
    text = F.col(f"row.`{text_col}`").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("id", F.col(f"row.`{id_col}`")).withColumn("text_hash", F.xxhash64(text)).withColumn("key", _key(F.col("id"), F.col("text_hash")))
    some = rows.where(live)
    here = some["id"].eqNullSafe(gone["id"]) & (some["text_hash"] == gone["text_hash"])
    left = some.join(gone.hint("merge"), here, "left").select("row", _remaining(text, F.col("lines"), F.col("spans")).alias("text"))
    left = left.union(rows.where(~live).select("row", text.alias("text")))
    return left.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
