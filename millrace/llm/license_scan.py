"""Licence notices found by a trained paragraph classifier and confirmed against templates.

A multinomial logistic regression on sparse word n-grams (one to three words) gives
each paragraph probabilities of licence families and of "unknown". It is trained on
variations of the notice templates below (words dropped, notices embedded in other
words, versions changed) and, as unknowns, on a bounded sample of the corpus' own
paragraphs without a licence word, on shuffled template words and on parts of
notices. A temperature fitted on held-out examples calibrates the probabilities, so
the unknown class takes what is uncertain. A prediction is confirmed if enough of
the words of one of the family's templates appear in the paragraph in their order.

A paragraph is a line, or adjacent lines without a blank one between them, as notices
are often wrapped. Lines are joined from one that has two words of a template next to
each other, as long as what is joined has at most twice the words of the longest
template; a joined paragraph is reported only if it is confirmed, has at most twice the
words of its template, and shows more of the template than each of its lines does
alone. Of those that overlap, the one with the largest share, then the fewest lines, then
the first is reported.

N-grams outside the vocabulary weigh nothing; a paragraph without any is unknown by
the intercepts alone, so only paragraphs with an n-gram of weight are scored.

Results for odd input: null and empty texts have no paragraphs. Rows without an id
are scanned and reported with a null id; repeated rows are each reported. Other
columns are ignored. An empty table gives no rows; a corpus without unknowns is
trained on the synthetic ones alone.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Usual notices of licence families (fixed values).
TEMPLATES = {
    "apache": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "SPDX-License-Identifier: Apache-2.0"),
    "mit": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.", "SPDX-License-Identifier: MIT"),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.", "SPDX-License-Identifier: GPL-3.0-only"),
    "lgpl": ("This library is licensed under the GNU Lesser General Public License, version 2.1.", "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.", "SPDX-License-Identifier: LGPL-2.1-only"),
    "bsd": ("Released under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.", "SPDX-License-Identifier: BSD-3-Clause"),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "cc0": ("This work has been dedicated to the public domain under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0 Universal."),
    "proprietary": ("All rights reserved.", "Copyright 2024 Example Inc. All rights reserved.", "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential."),
}
UNKNOWN = "unknown"
_WORD = re.compile(r"[^\W_]+")
#: Words by which a corpus paragraph is left out of the sample of unknowns (fixed values).
_HINTS = frozenset("license licensed licence licenced copyright copyrighted rights permission redistribute redistribution spdx proprietary apache mit gnu gpl lgpl bsd mozilla creative commons cc0 cc".split())


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(parts: list[str], known: dict[str, int], single: frozenset) -> list[int]:
    """Numbers of the distinct n-grams that ``known`` has; n-grams are made only of words in ``single``."""
    found: set[int] = set()
    one = two = None
    for w in parts:
        if w not in single:
            one = two = None
            continue
        for g in (w, f"{one} {w}" if one else None, f"{two} {one} {w}" if two else None):
            i = known.get(g) if g else None
            if i is not None:
                found.add(i)
        two, one = one, w
    return sorted(found)


@dataclass
class Model:
    families: list[str]
    known: dict[str, int]
    single: frozenset
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: list[tuple[str, int, list[str]]]

    def probabilities(self, found: list[int]) -> np.ndarray:
        z = (self.bias + self.weights[found].sum(axis=0)) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()

    def pairs(self) -> frozenset:
        """Adjacent words of templates."""
        if not hasattr(self, "_pairs"):
            self._pairs = frozenset(f"{a} {b}" for *_, own in self.templates for a, b in zip(own, own[1:], strict=False))
        return self._pairs

    def compare(self, parts: list[str], family: str) -> tuple[int, float]:
        """(template, share of its words that ``parts`` has in their order) of the family's best template."""
        best = (-1, 0.0)
        for name, number, own in self.templates:
            if name == family and (share := common(own, parts) / len(own)) > best[1]:
                best = (number, share)
        return best


def common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence (bit-parallel)."""
    places: dict[str, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & places.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def examples(unknown: list[str], copies: int, seed: int) -> tuple[list[list[str]], list[str]]:
    """Training paragraphs as words, with their families."""
    rng = random.Random(seed)
    filler = [w for t in unknown for w in words(t)][:20_000] or ["lorem", "ipsum", "dolor"]
    xs, ys = [], []
    for family, notices in TEMPLATES.items():
        for notice in notices:
            base = words(notice)
            for k in range(copies):
                w = [x for x in base if k == 0 or rng.random() > 0.06]
                if k % 3 == 1:
                    w = [rng.choice(filler) for _ in range(rng.randrange(12))] + w + [rng.choice(filler) for _ in range(rng.randrange(12))]
                if k % 3 == 2:
                    w = [str(rng.randrange(1, 30)) if x.isdigit() and rng.random() < 0.3 else x for x in w]
                xs.append(w)
                ys.append(family)
            for _ in range(max(1, copies // 3)):  # parts that name no family, and the notice's words out of order
                part = [x for x in base if x in ("the", "under", "of", "this", "work", "is", "to", "in", "and", "version", "all", "you", "use", "file", "for", "a")]
                xs.append([rng.choice(filler) for _ in range(10)] + rng.sample(part, min(len(part), 4)))
                ys.append(UNKNOWN)
    for t in unknown:
        xs.append(words(t))
        ys.append(UNKNOWN)
    return xs, ys


def train(unknown: list[str], copies: int = 24, steps: int = 250, l2: float = 1e-4, rate: float = 0.3, seed: int = 3) -> Model:
    """Fit by full-batch gradient steps (Adam); every fourth example is held out to fit the temperature."""
    xs, ys = examples(unknown, copies, seed)
    single = frozenset(w for notices in TEMPLATES.values() for t in notices for w in words(t))
    known: dict[str, int] = {}
    for notices in TEMPLATES.values():
        for t in notices:
            w = words(t)
            for n in (1, 2, 3):
                for i in range(len(w) - n + 1):
                    known.setdefault(" ".join(w[i : i + n]), len(known))
    families = [*TEMPLATES, UNKNOWN]
    x = np.zeros((len(xs), len(known)), dtype=np.float32)
    for i, w in enumerate(xs):
        x[i, grams(w, known, single)] = 1
    y = np.zeros((len(xs), len(families)), dtype=np.float32)
    y[np.arange(len(xs)), [families.index(f) for f in ys]] = 1
    held = np.arange(len(xs)) % 4 == 3
    w, b = np.zeros((len(known), len(families)), np.float32), np.zeros(len(families), np.float32)
    m, v = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    fit_x, fit_y = x[~held], y[~held]
    for t in range(1, steps + 1):
        z = fit_x @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        d = (p - fit_y) / len(fit_x)
        for k, (value, g) in enumerate(((w, fit_x.T @ d + l2 * w), (b, d.sum(axis=0)))):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            value -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)

    def loss(temperature: float) -> float:
        z = (x[held] @ w + b) / temperature
        z -= z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - (z * y[held]).sum(axis=1)))

    temperature = min((0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0), key=loss)
    templates = [(f, i, words(t)) for f, notices in TEMPLATES.items() for i, t in enumerate(notices)]
    return Model(families, known, single, w, b, temperature, templates)


def learn(docs: DataFrame, sample_rows: int = 400, sample_paragraphs: int = 4000, sample_chars: int = 600, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Train with unknowns from the ``sample_rows`` texts with the smallest hash of id: ``sample_paragraphs`` lines at most, of each at most ``sample_chars`` characters.

    Of texts that share an id, the one that sorts first counts.
    """
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct().orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(ids), "id").groupBy("id").agg(F.min("text").alias("text"))
    lines = texts.select("id", F.posexplode(F.split("text", "\n")).alias("line", "paragraph"))
    rows = lines.orderBy(F.xxhash64("id", "line"), "id", "line").limit(sample_paragraphs).select(F.left("paragraph", F.lit(sample_chars)).alias("paragraph")).collect()
    return train(sorted(r[0] for r in rows if r[0].strip() and not _HINTS & set(words(r[0]))))


@dataclass
class Found:
    """A paragraph with a family: lines ``first`` to ``last``."""

    first: int
    last: int
    family: str
    probability: float
    template: int
    share: float


def judged(model: Model, parts: list[str], first: int, last: int, least_probability: float) -> Found | None:
    """What the classifier makes of the words of some lines, if not unknown."""
    found = grams(parts, model.known, model.single)
    if not found:
        return None
    p = model.probabilities(found)
    best = int(p.argmax())
    if model.families[best] == UNKNOWN or p[best] < least_probability:
        return None
    return Found(first, last, model.families[best], float(p[best]), *model.compare(parts, model.families[best]))


def notices(model: Model, text: str, least_probability: float = 0.5, least_share: float = 0.8) -> list[Found]:
    """The paragraphs of a text that have a family, by their first line: lines, and confirmed joined lines."""
    lines = [words(line) for line in text.split("\n")]
    alone = [judged(model, parts, k, k, least_probability) if parts else None for k, parts in enumerate(lines)]
    size = {(f, i): len(own) for f, i, own in model.templates}
    most, pairs = 2 * max(size.values()), model.pairs()
    joined = []
    for k, parts in enumerate(lines):
        if len(parts) >= most or not any(f"{a} {b}" in pairs for a, b in zip(parts, parts[1:], strict=False)):
            continue
        wrapped, last = list(parts), k
        while last + 1 < len(lines) and lines[last + 1] and len(wrapped) + len(lines[last + 1]) <= most:
            last += 1
            wrapped += lines[last]
            one = judged(model, wrapped, k, last, least_probability)
            if one and one.share >= least_share and len(wrapped) <= 2 * size[one.family, one.template] and all(a is None or a.share < one.share for a in alone[k : last + 1]):
                joined.append(one)
    out: list[Found] = []
    for one in sorted(joined, key=lambda f: (-f.share, f.last - f.first, f.first)):
        if all(one.last < o.first or o.last < one.first for o in out):
            out.append(one)
    inside = {k for o in out for k in range(o.first, o.last + 1)}
    return sorted([*out, *(a for k, a in enumerate(alone) if a and k not in inside)], key=lambda f: f.first)


def scan(docs: DataFrame, model: Model, least_probability: float = 0.5, least_share: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Paragraphs that the classifier gives a family.

    Columns: id, paragraph (number of its first line), lines, start and length (characters), family, probability,
    template (number in the family), share (of the template's words found in order) and confirmed.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        out_types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.float64(), pa.bool_()]
        out_names = ["paragraph", "lines", "start", "length", "family", "probability", "template", "share", "confirmed"]
        for batch in batches:
            row, rows = [], []
            for i, t in enumerate(batch.column(1)):
                text = t.as_py() or ""
                if not (found := notices(own, text, least_probability, least_share)):
                    continue
                sizes = [len(line) for line in text.split("\n")]
                for f in found:
                    row.append(i)
                    rows.append((f.first, f.last - f.first + 1, sum(sizes[: f.first]) + f.first, sum(sizes[f.first : f.last + 1]) + f.last - f.first, f.family, f.probability, f.template, f.share, f.share >= least_share))
            cols = [pa.array(c, x) for c, x in zip(zip(*rows, strict=True) if rows else [[]] * len(out_names), out_types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), *cols], names=["id", *out_names])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, paragraph int, lines int, start long, length long, family string, probability double, template int, share double, confirmed boolean").withColumnRenamed("id", id_col)
