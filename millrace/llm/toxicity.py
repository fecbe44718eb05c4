"""Toxicity categories by a chain of linear classifiers.

The categories are predicted one after the other. Each is a logistic regression
on hashed word and word-beginning features of the text and on the probabilities
of the categories before it. While the chain is trained, those probabilities are
out-of-fold predictions (each from a model that has not seen the row), so a later
link learns how far to trust an earlier one on new rows; the links kept are then
fitted on all rows of the sample.

The order is from what comes before toxicity to toxicity itself: ``low_quality``
(the label quality is 0), kinds of toxicity, and ``toxic``. The kinds have no labels
of their own and no word list names them: rows labelled toxic are parted by k-means
on the features that tell them best from the others, and each part is a kind.

Results for odd input: a null text counts as empty; a text without letters has
the probabilities of an empty feature row and is never toxic. Labels that are
null, or of documents without text, are not learnt from; a quality that is null or
lacking counts as good. Repeated labels of a document count once (toxic if one is,
of low quality if one is), of texts that share an id the one that sorts first. Without both kinds of label in the sample no
link is trained and every probability is zero. Rows that share an id, or have
none, are each scored. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds of toxicity that are told apart, and the features by which they are.
KINDS, TELLING = 2, 64
#: The categories in the order of the chain.
CATEGORIES = ("low_quality", *(f"kind_{k + 1}" for k in range(KINDS)), "toxic")
#: Beginnings of a word, in letters, that are features besides the word itself.
STEMS = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None, bits: int = 18, known: dict | None = None) -> np.ndarray:
    """Sorted distinct feature numbers of a whole text."""
    found: set[int] = set()
    mask = (1 << bits) - 1
    known = {} if known is None else known
    for w in set(_WORD.findall(text.lower())) if text else ():
        own = known.get(w)
        if own is None:
            own = tuple(zlib.crc32(x.encode("utf-8", "replace")) & mask for x in (w, *(f"{w[:n]}*" for n in STEMS if len(w) > n)))
            if len(known) > 100_000:
                known.clear()
            known[w] = own
        found.update(own)
    return np.fromiter(sorted(found), dtype=np.int64, count=len(found))


@dataclass
class Rows:
    """Sparse binary rows; ``at`` are the starts of the rows in ``cols``."""

    cols: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, rows: list[np.ndarray]) -> Rows:
        return cls(np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64), np.cumsum([0, *map(len, rows)]))

    def pick(self, which: np.ndarray) -> Rows:
        return Rows.of([self.cols[self.at[i] : self.at[i + 1]] for i in which.tolist()])

    def sums(self, w: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(w[self.cols])])
        return total[self.at[1:]] - total[self.at[:-1]]


def _p(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Link:
    """A logistic regression on sparse features and on earlier probabilities."""

    name: str
    weights: np.ndarray
    chain: np.ndarray
    bias: float

    def score(self, rows: Rows, before: np.ndarray) -> np.ndarray:
        return _p(rows.sums(self.weights) + before @ self.chain + self.bias)


def telling(rows: Rows, y: np.ndarray, width: int) -> np.ndarray:
    """By how many standard errors the share of rows with a feature differs between the two labels; -1 if none has it."""
    have = np.bincount(rows.cols, minlength=width)
    with_y = np.bincount(rows.cols, weights=y[np.repeat(np.arange(len(y)), np.diff(rows.at))], minlength=width)
    n1 = max(y.sum(), 1)
    n0 = max(len(y) - n1, 1)
    share = np.clip(have / len(y), 0.5 / len(y), 1 - 0.5 / len(y))
    apart = (with_y / n1 - (have - with_y) / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    return np.where(have > 0, apart, 0)


def kinds(rows: Rows, y: np.ndarray, width: int, n: int = KINDS, steps: int = 20) -> np.ndarray:
    """[row, kind]: 1 for the kind of each row labelled ``y``, by k-means on the features that are most in its favour.

    The first centre is the row with most of them, each other the row farthest from those before; the same input gives the same kinds.
    """
    out = np.zeros((len(y), n))
    best = np.argsort(-telling(rows, y, width), kind="stable")[:TELLING]
    number = np.full(width, -1)
    number[best] = np.arange(len(best))
    own = np.flatnonzero(y > 0)
    v = np.zeros((len(own), len(best)))
    for i, r in enumerate(own.tolist()):
        cols = number[rows.cols[rows.at[r] : rows.at[r + 1]]]
        v[i, cols[cols >= 0]] = 1
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    centres = v[[int(np.argmax((v > 0).sum(axis=1)))]]
    while len(centres) < n:
        centres = np.concatenate([centres, v[[int(np.argmin((v @ centres.T).max(axis=1)))]]])
    for _ in range(steps):
        kind = np.argmax(v @ centres.T, axis=1)
        centres = np.stack([v[kind == k].mean(axis=0) if (kind == k).any() else centres[k] for k in range(n)])
    out[own, kind] = 1
    return out


def fit(name: str, rows: Rows, before: np.ndarray, y: np.ndarray, width: int, best: int = 3000, steps: int = 120, l2: float = 2e-4, rate: float = 0.15) -> Link:
    """Full-batch Adam on the mean log loss with an L2 penalty; the same input gives the same weights.

    Of the features, the ``best`` whose share of rows differs most between the two labels (in standard errors) get a
    weight. A feature's value is the logarithm of the ratio of its shares, so a rare one that is sure counts for much.
    """
    n, k = len(y), before.shape[1]
    row = np.repeat(np.arange(n), np.diff(rows.at))
    have = np.bincount(rows.cols, minlength=width)
    with_y = np.bincount(rows.cols, weights=y[row], minlength=width)
    n1 = max(y.sum(), 1)
    n0 = max(n - n1, 1)
    apart = np.abs(telling(rows, y, width))
    seen = np.sort(np.argsort(-np.where(have > 0, apart, -1), kind="stable")[: min(best, int((have > 0).sum()))])
    number = np.full(width, -1)
    number[seen] = np.arange(len(seen))
    cols = number[rows.cols]
    row, cols = row[cols >= 0], cols[cols >= 0]
    ratio = np.log((with_y + 1) / (n1 + 2) / ((have - with_y + 1) / (n0 + 2)))[seen]
    value = ratio[cols]
    w = np.zeros(len(seen) + k + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        p = _p(np.bincount(row, weights=w[cols] * value, minlength=n) + before @ w[len(seen) : -1] + w[-1])
        d = (p - y) / n
        g = np.concatenate([np.bincount(cols, weights=d[row] * value, minlength=len(seen)), before.T @ d, [d.sum()]])
        g[:-1] += l2 * w[:-1]
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    full = np.zeros(width)
    full[seen] = w[: len(seen)] * ratio
    return Link(name, full, w[len(seen) : -1], float(w[-1]))


@dataclass
class Chain:
    bits: int
    links: list[Link] = field(default_factory=list)
    threshold: float = 0.5

    @property
    def names(self) -> list[str]:
        return [link.name for link in self.links]

    def scores(self, rows: Rows) -> np.ndarray:
        out = np.zeros((len(rows.at) - 1, 0))
        for link in self.links:
            out = np.column_stack([out, link.score(rows, out)])
        return out


def train(rows: Rows, targets: dict[str, np.ndarray], bits: int, folds: int = 3) -> Chain:
    """A chain over ``targets`` in their order; row i belongs to fold i mod ``folds``."""
    n = len(rows.at) - 1
    fold = np.arange(n) % folds
    before, chain = np.zeros((n, 0)), Chain(bits)
    for name, y in targets.items():
        chain.links.append(fit(name, rows, before, y, 1 << bits))
        out = np.zeros(n)
        for f in range(folds):
            seen, left = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
            if len(seen) and len(left):
                out[left] = fit(name, rows.pick(seen), before[seen], y[seen], 1 << bits).score(rows.pick(left), before[left])
        before = np.column_stack([before, out])
    last = list(targets.values())[-1].astype(bool)
    chain.threshold = best_threshold(before[:, -1], last)
    return chain


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut in 0.05 ... 0.95 with the most right out-of-fold predictions; of equals the middle one."""
    cuts = np.arange(0.05, 0.96, 0.05)
    right = np.array([((p >= c) == y).sum() for c in cuts])
    return float(np.median(cuts[right == right.max()]))


def learn(docs: DataFrame, labels: DataFrame, most: int = 6000, bits: int = 18, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", quality_col: str = "quality") -> Chain:
    """Fit the chain on at most ``most`` labelled rows, those with the smallest hash of their id.

    Only feature numbers of the sample reach the driver, not texts.
    """
    low = (F.col(quality_col) == 0) if quality_col in labels.columns else F.lit(False)
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"), F.max(F.coalesce(low, F.lit(False)).cast("int")).alias("low"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [features(t.as_py(), bits).tolist() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(cols, pa.list_(pa.int32()))], names=["id", "y", "low", "cols"])

    chosen = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    chosen = chosen.join(F.broadcast(known), "id").groupBy("id", "y", "low").agg(F.min("text").alias("text"))  # at most ``most`` rows
    kind = chosen.schema["id"].dataType.simpleString()
    sample = chosen.mapInArrow(run, f"id {kind}, y int, low int, cols array<int>").toArrow()
    order = sorted(range(sample.num_rows), key=lambda i: (zlib.crc32(str(sample["id"][i].as_py()).encode()), str(sample["id"][i].as_py())))
    rows = Rows.of([sample["cols"][i].values.to_numpy(zero_copy_only=False) for i in order])
    y, poor = (np.array([sample[c][i].as_py() > 0 for i in order], dtype=float) for c in ("y", "low"))
    if len(set(y.tolist())) < 2:  # also if there is no row
        return Chain(bits)
    parted = kinds(rows, y, 1 << bits)
    return train(rows, dict(zip(CATEGORIES, [poor, *parted.T, y], strict=True)), bits)


def _scored(docs: DataFrame, inputs: list[str], text_col: str, chain: Chain) -> DataFrame:
    """The input columns, numbered (``_0`` ...), then p_<category> of each and ``rejected``, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # 2 ** bits weights for each link

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                rows = Rows.of([features(t.as_py(), model.bits, known) for t in part.column(part.num_columns - 1)])
                p = model.scores(rows) if model.links else np.zeros((part.num_rows, len(CATEGORIES)))
                bad = (p[:, -1] >= model.threshold) & (np.diff(rows.at) > 0) & bool(model.links)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *[pa.array(np.ascontiguousarray(p[:, k])) for k in range(len(CATEGORIES))], pa.array(bad)], names=out)

    rows = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(inputs)], F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("_text"))
    out = [f"_{i}" for i in range(len(inputs))] + [f"p_{n}" for n in CATEGORIES] + ["rejected"]
    types = [f"_{i} {rows.schema[i].dataType.simpleString()}" for i in range(len(inputs))] + [f"p_{n} double" for n in CATEGORIES] + ["rejected boolean"]
    return rows.mapInArrow(run, ", ".join(types))


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id of every row with p_<category> for each category and ``rejected``. Other columns are ignored."""
    return _scored(docs, [id_col], text_col, chain).withColumnRenamed("_0", id_col)


def accepted(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the chain does not reject, with all their columns, whatever their names."""
    left = _scored(docs, docs.columns, text_col, chain).where("not rejected")
    return left.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def detect(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Scores of every document by a chain learnt from ``labels``."""
    return score(docs, learn(docs, labels, **options), options.get("id_col", "doc_id"), options.get("text_col", "text"))
