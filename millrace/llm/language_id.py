"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds a sample of labelled text. A text is
parsed greedily against each automaton: a phrase is the longest match from where
the last one ended, and one character more. The fewer phrases a language needs,
the nearer the text is to its sample; phrases are multiplied by the logarithm of
the sample's length, which makes samples of unlike size comparable, and divided
by the text's length. The language with the smallest rate wins.

Texts are normalised first: lower case, and every run of characters that are not
letters becomes one space. Whole texts are parsed. So that all texts of a batch can be
parsed in step, long ones are cut in blocks, each first parsed as if a phrase began with
it; then the phrase that the block before leaves open is carried on until it ends where
one of the block's own does, from where on both parses are one. Any number of different
letters is told apart.

Results for odd input: a null text, or one without a letter, is ``und`` with score
zero. Without a labelled sample every text is ``und``. Equal rates go to the
language that sorts first. Labels that are null and texts without letters are not
learnt from. Repeated rows are each predicted. Other columns are ignored. An empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Characters that are parsed in step as one block, and characters of texts that are worked on at once.
BLOCK, AT_ONCE = 2048, 1 << 22
#: Letters with a column of their own in the table of moves; moves by others are looked up by key.
COLUMNS = 255
_OTHER = re.compile(r"[\W\d_]+")


def normalised(text: str | None) -> str:
    out = _OTHER.sub(" ", text.lower()).strip() if text else ""
    signs = [c for c in set(out) if c != " " and not c.isalpha()]  # numeric signs that are no digits
    if signs:
        for c in signs:
            out = out.replace(c, " ")
        out = re.sub(" +", " ", out).strip()
    return out


def automaton(codes: list[int]) -> list[dict[int, int]]:
    """Moves of the suffix automaton of a sequence; state 0 is the start, to which no move leads."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = cur
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return moves


@dataclass
class Model:
    """Letters have codes from 1 on, in the order of ``letters``; 0 is a letter that no sample has.

    ``table`` holds the moves by the first ``columns`` codes, state by state; ``keys`` (state times the number of codes,
    plus the code, sorted) and ``targets`` those by other codes. A move to 0 is none.
    """

    languages: list[str]
    letters: str
    columns: int
    offsets: np.ndarray
    table: np.ndarray
    keys: np.ndarray
    targets: np.ndarray
    weights: np.ndarray

    def codes(self, text: str) -> np.ndarray:
        if not hasattr(self, "_codes"):
            self._codes = np.zeros(0x110000, dtype=np.int64)
            self._codes[[ord(c) for c in self.letters]] = np.arange(1, len(self.letters) + 1)
        return self._codes[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]

    def move(self, state: np.ndarray, code: np.ndarray, rare: bool) -> np.ndarray:
        """Next states of [language, place]; ``rare``: some code may be beyond the table."""
        if not rare:
            return self.table[state * (self.columns + 1) + code]
        now = self.table[state * (self.columns + 1) + np.where(code > self.columns, 0, code)]
        far = np.flatnonzero(code > self.columns)
        if len(far) and len(self.keys):
            key = state[:, far] * (len(self.letters) + 1) + code[far]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            now[:, far] = np.where(self.keys[at] == key, self.targets[at], 0)
        return now

    def _parsed(self, flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For blocks of ``flat``, each parsed from its start: whether a phrase ends at a place [language, place], and the last state [language, block]."""
        order = np.argsort(-size, kind="stable")
        first, held = begin[order], size[order]
        start = np.repeat(self.offsets[:, None], len(held), axis=1)
        state, ends, rare = start.copy(), np.zeros((len(self.languages), len(flat)), dtype=bool), bool((flat > self.columns).any())
        live = np.searchsorted(-held, -np.arange(int(held.max())), side="left")  # blocks longer than each step
        for t, m in enumerate(live.tolist()):
            at = first[:m] + t
            now = self.move(state[:, :m], flat[at], rare)
            missed = now == 0
            ends[:, at] = missed
            state[:, :m] = np.where(missed, start[:, :m], now)
        last = np.empty_like(state)
        last[:, order] = state
        return ends, last

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases [text, language] of texts that are not empty."""
        total = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        pieces = [(i, lo, min(lo + AT_ONCE, len(t))) for i, t in enumerate(texts) for lo in range(0, len(t), AT_ONCE)]
        open_: np.ndarray | None = None  # states at the end of the piece before, if of the same text
        while pieces:
            now, room = [], AT_ONCE
            while pieces and (not now or pieces[0][2] - pieces[0][1] <= room):
                now.append(pieces.pop(0))
                room -= now[-1][2] - now[-1][1]
            flat = self.codes("".join(texts[i][lo:hi] for i, lo, hi in now))
            length = np.array([hi - lo for _, lo, hi in now])
            parts = -(-length // BLOCK)
            owner = np.repeat(np.arange(len(now)), parts)
            begin = np.repeat(np.cumsum(length) - length, parts) + BLOCK * (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts))
            size = np.minimum(BLOCK, np.repeat(np.cumsum(length), parts) - begin)
            ends, last = self._parsed(flat, begin, size)
            b = 0
            for (i, lo, hi), n in zip(now, parts.tolist(), strict=True):
                state = open_ if lo else self.offsets
                for k in range(len(self.languages)):
                    s = int(state[k])
                    for x in range(b, b + n):
                        s = self._carried(k, s, flat, ends, int(begin[x]), int(begin[x] + size[x]), int(last[k, x]))
                    last[k, b + n - 1] = s
                open_ = last[:, b + n - 1].copy()
                total[i] += ends[:, begin[b] : begin[b] + hi - lo].sum(axis=1)
                if hi == len(texts[i]):
                    total[i] += open_ != self.offsets  # the last phrase
                b += n
        return total

    def _carried(self, k: int, state: int, flat: np.ndarray, ends: np.ndarray, at: int, end: int, last: int) -> int:
        """The state after a block that is entered in ``state``; ``ends`` is set right up to where its own parse agrees."""
        start = int(self.offsets[k])
        if state == start:
            return last
        row, item, code, width = ends[k], self.table.item, flat.item, self.columns + 1
        while at < end:
            c = code(at)
            state = item(state * width + c) if c <= self.columns else int(self.move(np.array([[state]]), flat[at : at + 1], True)[0, 0])
            own = row.item(at)
            row[at] = state == 0
            if state == 0:
                state = start
                if own:
                    return last
            at += 1
        return state

    def rates(self, texts: list[str]) -> np.ndarray:
        """Rates [text, language] of normalised texts that are not empty."""
        return self.phrases(texts) * self.weights / np.array([len(t) for t in texts])[:, None]


def build(samples: dict[str, str]) -> Model:
    """Automata of normalised texts by language, over all their characters."""
    languages = sorted(k for k, v in samples.items() if v)
    times = Counter()
    for k in languages:
        times.update(samples[k])
    letters = "".join(sorted(times, key=lambda c: (-times[c], c)))
    columns, code = min(COLUMNS, len(letters)), {c: i + 1 for i, c in enumerate(letters)}
    tables, keys, offsets, at = [], [], [], 0
    for k in languages:
        moves = automaton([code[c] for c in samples[k]])
        own = np.zeros((len(moves), columns + 1), dtype=np.int32)
        for s, m in enumerate(moves):
            for c, t in m.items():
                if c <= columns:
                    own[s, c] = t + at
                else:
                    keys.append(((s + at) * (len(letters) + 1) + c, t + at))
        tables.append(own.ravel())
        offsets.append(at)
        at += len(moves)
    far = np.array(sorted(keys), dtype=np.int64).reshape(-1, 2)
    weights = np.array([np.log2(max(2, len(samples[k]))) for k in languages])
    return Model(languages, letters, columns, np.array(offsets, dtype=np.int64), np.concatenate([*tables, np.zeros(0, np.int32)]), far[:, 0].copy(), far[:, 1].copy(), weights)


def learn(labelled: DataFrame, sample_chars: int = 40_000, sample_rows: int = 64, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of at most ``sample_rows`` texts and ``sample_chars`` normalised characters for each language.

    The texts are those with the smallest hash of id; which they are is found from ids and labels alone. Of rows
    that share an id and a label the text that sorts first counts.
    """
    ids = labelled.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = ids.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= sample_rows).drop("_rank").distinct()
    texts = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    texts = texts.join(F.broadcast(chosen), ["id", "lang"]).groupBy("lang", "id").agg(F.min(F.left("text", F.lit(sample_chars))).alias("text"))
    rows = texts.select("lang", F.xxhash64("id").alias("h"), "text").collect()  # sample_rows for each language
    samples: dict[str, str] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"], r["text"] or "")):
        held = samples.get(r["lang"], "")
        samples[r["lang"]] = f"{held} {normalised(r['text'])}".strip()[:sample_chars]
    return build(samples)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score (how much lower the best rate is than the next, 0 to 1) and rate of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                texts = [normalised(t.as_py()) for t in part.column(1)]
                full = [i for i, t in enumerate(texts) if t] if own.languages else []
                lang, score, rate = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
                if full:
                    rates = own.rates([texts[i] for i in full])
                    best = rates.argmin(axis=1)
                    ranked = np.sort(rates, axis=1)
                    gap = 1 - ranked[:, 0] / np.maximum(ranked[:, 1], 1e-12) if rates.shape[1] > 1 else np.ones(len(full))
                    for i, b, g, r in zip(full, best.tolist(), gap.tolist(), ranked[:, 0].tolist(), strict=True):
                        lang[i], score[i], rate[i] = own.languages[b], g, r
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang), pa.array(score), pa.array(rate, pa.float64())], names=["id", "lang_pred", "score", "rate"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double, rate double").withColumnRenamed("id", id_col)
