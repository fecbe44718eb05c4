"""Comparison of a corpus' chunks with its blocks before and after distillation."""

from __future__ import annotations

import html
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import metrics as M
from millrace.functions.blocks import keep_first
from millrace.functions.text import all_words, block_chars, char_count, chunks, counted, short_hash, tokens, word_count


def chunk_documents(docs: DataFrame, size: int = 2000, overlap: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, chunk_index from 0, text, chunk_hash) of every chunk, repeats included."""
    rows = docs.select(id_col, F.posexplode(chunks(F.col(text_col), size, overlap)).alias("chunk_index", "text"))
    return rows.withColumn("chunk_hash", short_hash(F.col("text")))


def unique_chunks(blocks: DataFrame, *order: str) -> DataFrame:
    """The first block of each source chunk; blank hashes and texts are left out."""
    rows = blocks.where((F.coalesce(F.trim("chunk_hash"), F.lit("")) != "") & (F.coalesce(F.trim("text"), F.lit("")) != ""))
    return keep_first(rows, "chunk_hash", *order)


def neighbours(chunked: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Chunks with the one before and the one after in their document."""
    w = Window.partitionBy(id_col).orderBy("chunk_index")
    return chunked.withColumn("preceding", F.lag("text").over(w)).withColumn("following", F.lead("text").over(w))


def word_frequencies(docs: DataFrame, top: int = 30, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the ``top`` words, ties by first occurrence."""
    rows = docs.select(F.col(id_col).alias("d"), F.posexplode(all_words(F.col(text_col))).alias("p", "word")).where(counted(F.col("word")))
    return rows.groupBy("word").agg(F.count("*").alias("n"), F.min(F.struct("d", "p")).alias("_first")).orderBy(F.desc("n"), "_first").limit(top).select("word", "n")


def compare_words(left: DataFrame, right: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` words of ``left`` with both counts (0 where ``right`` has none) and their ratio."""
    first = left.orderBy(F.desc("n"), "word").limit(top).select("word", F.col("n").alias("n_left"))
    joined = first.join(right.select("word", F.col("n").alias("n_right")), "word", "left").withColumn("n_right", F.coalesce("n_right", F.lit(0)))
    return joined.withColumn("ratio", F.try_divide(F.col("n_left").cast("double"), F.col("n_right").cast("double")))


def text_stats(df: DataFrame, text_col: str = "text") -> DataFrame:
    """One row: rows, words and characters of all texts joined by single spaces."""
    t = F.col(text_col)
    return df.agg(F.count("*").alias("n"), F.coalesce(F.sum(word_count(t)), F.lit(0)).alias("words"), F.greatest(F.coalesce(F.sum(char_count(t)), F.lit(0)) + F.count("*") - 1, F.lit(0)).alias("chars"))


def _mean_tokens(chars: Column) -> Column:
    return F.coalesce(F.bround(F.avg(tokens(chars)), 0), F.lit(0)).cast("long")


def token_stats(chunked: DataFrame, raw: DataFrame, distilled: DataFrame, queries: int = 1000, dollars: float = M.DOLLARS_PER_MILLION) -> DataFrame:
    """One row of totals, means, yearly tokens and costs of chunks, blocks and distilled blocks."""
    size = block_chars(F.col("name"), F.col("critical_question"), F.col("trusted_answer"))
    parts = []
    for name, df, chars in (("chunk", chunked, char_count(F.col("text"))), ("raw", raw, size), ("distilled", distilled, size)):
        parts.append(df.agg(F.coalesce(F.sum(tokens(chars)), F.lit(0)).alias(f"{name}_tokens"), _mean_tokens(chars).alias(f"{name}_mean")))
    row = parts[0].crossJoin(parts[1]).crossJoin(parts[2])  # one row each
    for name in ("chunk", "raw", "distilled"):
        row = row.withColumn(f"{name}_year", M.annual_tokens(F.col(f"{name}_mean"), queries)).withColumn(f"{name}_cost", M.cost(F.col(f"{name}_year"), dollars))
    return row.withColumn("token_improvement", M.improvement(F.col("chunk_year"), F.col("distilled_year"))).withColumn("cost_saving", F.col("chunk_cost") - F.col("distilled_cost"))


def comparison(distances: DataFrame, document_words: int, distilled_words: int) -> DataFrame:
    """One row of improvements from per-query chunk_distance, raw_distance and distilled_distance."""
    row = distances.agg(*[M.mean_distance(F.col(c)).alias(c) for c in ("chunk_distance", "raw_distance", "distilled_distance")], F.count("*").alias("queries"))
    row = row.withColumn("vector_improvement", M.improvement(F.col("chunk_distance"), F.col("distilled_distance")))
    row = row.withColumn("word_improvement", M.improvement(F.lit(document_words), F.lit(distilled_words)))
    row = row.withColumn("aggregate", M.aggregate(F.col("vector_improvement"), F.col("word_improvement")))
    row = row.withColumn("projected", M.projected(F.col("vector_improvement"), F.col("word_improvement")))
    return row.withColumn("raw_gain_percent", M.gain(F.col("chunk_distance"), F.col("raw_distance"))).withColumn("distilled_gain_percent", M.gain(F.col("raw_distance"), F.col("distilled_distance")))


def report_json(row: DataFrame) -> str:
    """The only row as JSON; nulls stay null."""
    return json.dumps(row.first().asDict(True), default=str, indent=2, sort_keys=True)


def report_html(row: DataFrame, title: str, sections: tuple[str, ...] = ()) -> str:
    """The only row as a table; ``sections`` picks and orders columns. Missing numbers are "n/a"."""
    values = row.first().asDict(True)
    names = sections or tuple(values)
    show = lambda v: "n/a" if v is None else f"{v:.4f}" if isinstance(v, float) else html.escape(str(v))
    lines = "".join(f"<tr><th>{html.escape(n)}</th><td>{show(values.get(n))}</td></tr>" for n in names)
    return f"<!doctype html><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1><table>{lines}</table>"


def accuracy_chart(row: DataFrame) -> DataFrame:
    """(label, distance, accuracy) of the three corpora of a ``comparison`` row; unknown distances are left out."""
    labels = {"chunk_distance": "chunks", "raw_distance": "blocks", "distilled_distance": "distilled"}
    bars = F.array(*[F.struct(F.lit(label).alias("label"), F.col(c).alias("distance")) for c, label in labels.items()])
    flat = row.select(F.explode(bars).alias("b")).select("b.*").where("distance IS NOT NULL")
    return flat.withColumn("accuracy", F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.col("distance"))))


def performance_chart(row: DataFrame) -> DataFrame:
    """(label, value) of the improvement factors."""
    names = ("vector_improvement", "word_improvement", "aggregate", "projected")
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("label"), F.col(n).alias("value")) for n in names])).alias("b")).select("b.*")


def token_chart(row: DataFrame) -> DataFrame:
    """(label, tokens a year, cost) of a ``token_stats`` row."""
    bars = [F.struct(F.lit(n).alias("label"), F.col(f"{n}_year").alias("tokens"), F.col(f"{n}_cost").alias("cost")) for n in ("chunk", "raw", "distilled")]
    return row.select(F.explode(F.array(*bars)).alias("b")).select("b.*")


def scatter(distances: DataFrame, points: int = 20) -> DataFrame:
    """The first ``points`` queries with both distances and their ratio, for a chart."""
    rows = distances.where(M.valid(F.col("chunk_distance"), F.col("distilled_distance"))).orderBy("query").limit(points)
    return rows.select("query", "chunk_distance", "distilled_distance", M.improvement(F.col("chunk_distance"), F.col("distilled_distance")).alias("ratio"))


def word_table(documents: DataFrame, raw: DataFrame, distilled: DataFrame, top: int = 10) -> DataFrame:
    """(word, documents, raw, distilled, ratio): the documents' top words in all three lists, 0 where one lacks it."""
    first = documents.orderBy(F.desc("n"), "word").limit(top).select("word", F.col("n").alias("documents"))
    for name, other in (("raw", raw), ("distilled", distilled)):
        first = first.join(other.select("word", F.col("n").alias(name)), "word", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return first.withColumn("ratio", F.try_divide(F.col("documents").cast("double"), F.col("distilled").cast("double")))
