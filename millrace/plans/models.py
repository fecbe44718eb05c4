"""Model interfaces and their deterministic offline forms.

An embedder, an extractor and a merger are plain objects with one method each; they
run inside executors. The HTTP ones call a service with retries and are not tested
here, as there is no network.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
import time
import urllib.error
import urllib.request
from collections import Counter
from dataclasses import dataclass, field
from typing import Protocol
from xml.sax.saxutils import escape, unescape

import pandas as pd
from pyspark.sql import Column
from pyspark.sql.functions import pandas_udf


class Embedder(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class Extractor(Protocol):
    def extract(self, chunk: str) -> str: ...


class Merger(Protocol):
    def merge(self, blocks: list[dict]) -> list[dict]: ...


@dataclass(frozen=True)
class HashingEmbedder:
    """Counts of words of a-z by the first 15 hex digits of their MD5, at length one; no word gives a zero vector."""

    width: int = 256

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = [0.0] * self.width
            for w, n in Counter(re.findall(r"[a-z]+", (t or "").lower())).items():
                v[int(hashlib.md5(w.encode()).hexdigest()[:15], 16) % self.width] += n
            length = math.sqrt(sum(x * x for x in v))
            out.append([x / length if length else 0.0 for x in v])
        return out


@dataclass(frozen=True)
class ExtractiveExtractor:
    """One block for each chunk: its first sentence names it, a fixed question asks for it, the chunk answers."""

    keywords: int = 5

    def extract(self, chunk: str) -> str:
        name = chunk.split(". ")[0].strip()[:100] or "Untitled"
        words = Counter(w for w in re.findall(r"[a-z]+", chunk.lower()) if len(w) > 4)
        top = [w for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0]))[: self.keywords]]
        question = f"What is said about {name[:150]}?"
        return (
            f"<ideablock><name>{escape(name)}</name><critical_question>{escape(question)}</critical_question>"
            f"<trusted_answer>{escape(chunk)}</trusted_answer><tags>EXTRACT</tags><keywords>{', '.join(top)}</keywords></ideablock>"
        )


@dataclass(frozen=True)
class CanonicalMerger:
    """One block: that with the longest answer (then the smallest id), with all tags and keywords. Merging in parts gives the same."""

    def merge(self, blocks: list[dict]) -> list[dict]:
        best = min(blocks, key=lambda b: (-len(b["trusted_answer"]), b["id"]))
        union = {k: sorted({x for b in blocks for x in (b.get(k) if b.get(k) is not None else [])}) for k in ("tags", "keywords")}
        return [{k: best[k] for k in ("name", "critical_question", "trusted_answer")} | union]


@dataclass(frozen=True)
class PlaceholderMerger:
    """One block with empty fields for any blocks: a stand-in that shows what would be merged."""

    def merge(self, blocks: list[dict]) -> list[dict]:
        return [{"name": "", "critical_question": "", "trusted_answer": "", "tags": [], "keywords": []}] if blocks else []


@dataclass(frozen=True)
class RetryingMerger:
    """Another merger, asked up to ``tries`` times; the wait doubles after each failure. The last error is raised."""

    inner: Merger
    tries: int = 3
    wait: float = 2.0

    def merge(self, blocks: list[dict]) -> list[dict]:
        for attempt in range(self.tries - 1):
            try:
                return self.inner.merge(blocks)
            except Exception:
                time.sleep(self.wait * 2**attempt)
        return self.inner.merge(blocks)


@dataclass(frozen=True)
class HttpClient:
    """POST of JSON with retries: the wait doubles after each failure."""

    url: str
    headers: dict = field(default_factory=dict)
    tries: int = 3
    timeout: float = 60.0

    def post(self, body: dict) -> dict:
        for attempt in range(self.tries):
            try:
                request = urllib.request.Request(self.url, json.dumps(body).encode(), {"Content-Type": "application/json", **self.headers})
                with urllib.request.urlopen(request, timeout=self.timeout) as r:
                    return json.load(r)
            except (urllib.error.URLError, TimeoutError):
                if attempt + 1 == self.tries:
                    raise
                time.sleep(2**attempt)
        raise AssertionError("unreachable")


@dataclass(frozen=True)
class HttpEmbedder:
    client: HttpClient
    model: str
    batch: int = 100

    def embed(self, texts: list[str]) -> list[list[float]]:
        out: list[list[float]] = []
        for lo in range(0, len(texts), self.batch):
            answer = self.client.post({"model": self.model, "input": texts[lo : lo + self.batch]})
            out += [d["embedding"] for d in sorted(answer["data"], key=lambda d: d["index"])]
        return out


@dataclass(frozen=True)
class HttpExtractor:
    client: HttpClient
    model: str

    def extract(self, chunk: str) -> str:
        answer = self.client.post({"model": self.model, "messages": [{"role": "user", "content": chunk}]})
        return answer["choices"][0]["message"]["content"]


@dataclass(frozen=True)
class HttpMerger:
    """A model that answers with blocks as XML or JSON."""

    client: HttpClient
    model: str

    def merge(self, blocks: list[dict]) -> list[dict]:
        names = ("name", "critical_question", "trusted_answer")
        tag = lambda k, v: f"<{k}>{escape(v or '')}</{k}>"
        asked = "".join("<ideablock>" + "".join(tag(k, b[k]) for k in names) + "</ideablock>" for b in blocks)
        answer = self.client.post({"model": self.model, "messages": [{"role": "user", "content": asked}]})
        out = []
        for block in re.findall(r"(?is)<ideablock\b[^>]*>(.*?)</ideablock>", answer["choices"][0]["message"]["content"]):
            found = {k: re.search(rf"(?is)<{k}\b[^>]*>(.*?)</{k}>", block) for k in (*names, "tags", "keywords")}
            text = {k: unescape(m[1]).strip() if m else "" for k, m in found.items()}
            if all(text[k] for k in names):
                out.append({k: text[k] for k in names} | {k: [x.strip() for x in text[k].split(",") if x.strip()] for k in ("tags", "keywords")})
        return out


def embedded(text: Column, embedder: Embedder) -> Column:
    @pandas_udf("array<double>")
    def run(t: pd.Series) -> pd.Series:
        return pd.Series(embedder.embed(t.fillna("").tolist()))

    return run(text)


def extracted(chunk: Column, extractor: Extractor) -> Column:
    @pandas_udf("string")
    def run(t: pd.Series) -> pd.Series:
        return t.map(lambda x: extractor.extract(x) if x else None)

    return run(chunk)
