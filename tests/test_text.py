import hashlib
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import report as R

CASES = ["", "   ", "no end", "x" * 2500, "a. " * 900, "y" * 1998 + ". b. c", "a.  b", "tab\t.  edge . z", "\U0001f600 one. two\nthree. four.", "line\n\nline. " * 300, "." * 50, ". . . ", "trailing. "]


def fold(text, size=2000, overlap=200):
    """The chunking rules said plainly."""
    out, cur = [], ""
    for s in text.replace("\n", " ").split(". "):
        s = s.strip()
        if not s:
            continue
        s += ". "
        if cur and len(cur) + len(s) > size:
            out.append(cur)
            cur = cur[-overlap:] + s
        else:
            cur += s
    return out + [cur] if cur else out


@pytest.mark.parametrize(("size", "overlap"), [(2000, 200), (100, 20), (30, 40)])
def test_chunks(spark, size, overlap):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*CASES, None])], "i int, t string")
    got = {r.i: r.c for r in df.select("i", T.chunks(F.col("t"), size, overlap).alias("c")).collect()}
    assert got == {i: fold(t or "", size, overlap) for i, t in enumerate([*CASES, None])}


def test_counts(spark):
    df = spark.createDataFrame([("Hello world test",), ("Hello\nworld\ttest",), ("",), (None,), ("a b",)], "t string")
    assert [(r.w, r.c) for r in df.select(T.word_count(F.col("t")).alias("w"), T.char_count(F.col("t")).alias("c")).collect()] == [(3, 16), (3, 16), (0, 0), (0, 0), (2, 3)]


def test_tokens_round_halves_to_even(spark):
    df = spark.createDataFrame([(2,), (6,), (10,), (9,)], "n int")
    assert [r.t for r in df.select(T.tokens(F.col("n")).alias("t")).collect()] == [0, 2, 2, 2]


def test_word_frequencies(spark):
    df = spark.createDataFrame([(0, "apple banana apple cherry apple banana the of Über x9 ab")], "doc_id int, text string")
    assert [(r.word, r.n) for r in R.word_frequencies(df).collect()] == [("apple", 3), ("banana", 2), ("cherry", 1)]


def test_hash_and_embed_text(spark):
    df = spark.createDataFrame([(" n ", None, "a", "1"), (None, "", " ", "2")], "n string, q string, a string, id string")
    rows = df.select(T.embed_text(*[F.col(c) for c in "nqa"], F.col("id")).alias("e"), T.stored_text(*[F.col(c) for c in "nqa"]).alias("s"), T.short_hash(F.col("id")).alias("h")).collect()
    assert [r.e for r in rows] == ["n a", "block-2"]
    assert [r.s for r in rows] == [" n   a", "   "]
    assert rows[0].h == hashlib.sha256(b"1").hexdigest()[:16]


def test_chunk_documents_numbers_and_hashes(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {(r.doc_id, r.chunk_index): (r.text, r.chunk_hash) for r in R.chunk_documents(docs).collect()}
    want = {(d.doc_id, i): (c, hashlib.sha256(c.encode()).hexdigest()[:16]) for d in docs.collect() for i, c in enumerate(fold(d.text))}
    assert got == want and not any(re.search("\n", t) for t, _ in got.values())


def test_sql_functions(spark):
    from millrace.functions.sql import register

    register(spark)
    row = spark.sql("SELECT cosine_similarity_of(array(1D, 0D), array(2D, 0D)) AS c, cosine_similarity_of(array(0D), array(1D)) AS z, seq_ratio('abc', 'ABD') AS r, size(lsh_signature(array(1D, 2D))) AS n").first()
    assert (row.c, row.z, round(row.r, 3), row.n) == (1, 0, 0.667, 10)
    df = spark.createDataFrame([(t,) for t in CASES], "t string")
    assert all(r.a == r.b for r in df.select(F.expr("chunk_text(t)").alias("a"), T.chunks(F.col("t")).alias("b")).collect())
