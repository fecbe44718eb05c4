"""Packing token sequences by bounded-space online best-fit.

Each packer keeps a fixed number of open bins. A bitset has one bit for every
amount of free space that some open bin has, so the fullest bin that still takes
a piece is the lowest set bit at or above the piece's length, found with two
integer operations. When a new bin would exceed the number of open ones, the
fullest closes first: it is the least likely to take another piece.

Texts are tokenised in one narrow pass. Only (id, piece, length) rows are dealt
to packers, by hash, one packer for every ``per_packer`` pieces, and each packs its
rows in the order of that hash; so a task that runs again gives the same bins.

Results for odd input: a null text counts as empty, and an empty text is the end
token alone (one piece of length one). Rows that share an id, or have none, are
packed on their own each. Long texts are cut into full pieces, of which the
first may be shorter. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.scratch import keep

#: The pre-tokenising pattern of byte-level BPE files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_UNSAFE = re.compile(r" \s|\s ")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def _byte_of() -> dict[str, int]:
    """The printable characters by which byte-level BPE files write bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _in_order(model: dict) -> bool:
    """Whether the ids of what merges make rise with the merges' order, as encoding by rank takes for granted."""
    made = [model["vocab"].get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in model["merges"]]
    return None not in made and all(a < b for a, b in zip(made, made[1:], strict=False))


class Encoder:
    """Token ids of a tokenizer file as little-endian unsigned 32-bit bytes.

    Byte-level BPE never joins across a space between two other characters that
    are not white space, so what stands between such spaces is encoded once and
    remembered (``remembered`` entries, then forgotten and learnt anew). Other
    tokenizers and pre-tokenisers, files whose ids don't rise with the merges, and
    texts that hold an added token take the plain path.
    """

    def __init__(self, path: str, remembered: int = 300_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        from tokenizers import Tokenizer

        self.remembered, self.known, self.older, self.fast = remembered, {}, {}, None
        self.plain = Tokenizer.from_file(path)
        added = [t["content"] for t in spec.get("added_tokens", [])]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        vocabulary = spec["model"].get("vocab")
        before = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] == "BPE" and _in_order(spec["model"]) and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True) and not spec.get("normalizer"):
            import tiktoken

            byte = _byte_of()
            ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in added}
            self.fast = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _miss(self, part: str) -> bytes:
        if len(self.known) >= self.remembered:
            self.known, self.older = {}, self.known
        found = self.older.get(part) or array("I", self.fast.encode_ordinary(" " + part)).tobytes()
        if len(part) <= 64:
            self.known[part] = found
        return found

    def __call__(self, text: str) -> bytes:
        if self.fast is None or self.added and self.added.search(text):
            return array("I", self.plain.encode(text, add_special_tokens=False).ids).tobytes()
        first, *rest = _CUT.split(text) if _UNSAFE.search(text) else text.split(" ")
        known, miss = self.known, self._miss
        return array("I", self.fast.encode_ordinary(first)).tobytes() + b"".join([known.get(p) or miss(p) for p in rest])


def cuts(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be short."""
    first = n % most or most
    return [(0, min(first, n)), *((s, most) for s in range(first, n, most))]


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, most: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, piece, start, length and ids (binary, little-endian unsigned 32-bit) of every piece."""
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                row, number, start, length, ids = [], [], [], [], []
                for i, text in enumerate(part.column(1)):
                    whole = encode(text.as_py() or "") + end
                    for k, (s, n) in enumerate(cuts(len(whole) // 4, most)):
                        row.append(i)
                        number.append(k)
                        start.append(s)
                        length.append(n)
                        ids.append(whole[4 * s : 4 * (s + n)])
                cols = [part.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "piece", "start", "length", "ids"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


class BestFit:
    """Bounded-space online best-fit; ``place`` gives (bin number, offset)."""

    def __init__(self, most: int = 1024, open_bins: int = 256):
        self.most, self.limit = most, open_bins
        self.bits, self.open, self.made = 0, 0, 0
        self.with_free: list[list[int]] = [[] for _ in range(most + 1)]

    def _take(self, free: int) -> int:
        stack = self.with_free[free]
        number = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        return number

    def place(self, length: int) -> tuple[int, int]:
        fit = self.bits >> length
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            number = self._take(free)
        else:
            if self.open == self.limit and length < self.most:
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.open -= 1
            free, number = self.most, self.made
            self.made += 1
            self.open += 1
        left = free - length
        if left:
            self.with_free[left].append(number)
            self.bits |= 1 << left
        else:
            self.open -= 1
        return number, self.most - free


def place(rows: DataFrame, most: int = 1024, open_bins: int = 256, per_packer: int = 131_072) -> DataFrame:
    """``rows`` (with piece and length) with sequence_id and offset; ``rows`` must be a written table."""
    n = rows.count()
    names = rows.columns
    order = F.xxhash64(*[F.col(c) for c in names])
    dealt = rows.withColumn("_order", order).repartition(max(1, -(-n // per_packer)), "_order").sortWithinPartitions("_order", *names).drop("_order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, first = BestFit(most, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            at = np.array([packer.place(x) for x in batch.column("length").to_pylist()], dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at[:, 0] + first), pa.array(at[:, 1])], names=[*names, "sequence_id", "offset"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return dealt.mapInArrow(run, f"{types}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, most: int = 1024, open_bins: int = 256, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces with their place, with a checksum in place of the ids."""
    cut = pieces(docs, tokenizer, end_id, most, id_col, text_col).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(keep(cut, "pieces"), most, open_bins)
