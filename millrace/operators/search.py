"""Retrieval by words, by both words and vectors, and by entities."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from millrace.functions.vectors import distance, literal, similarity_of
from millrace.operators.clusters import sequence_ratio


def boosts(query: str, name: Column, question: Column, keywords: Column, phrase: float = 0.4, in_name: float = 0.15, in_question: float = 0.10, in_keywords: float = 0.05, whole: Column | None = None) -> Column:
    """What a query's phrase and distinct words add to a score."""
    q = query.lower()
    low = [F.lower(F.coalesce(c, F.lit(""))) for c in (name, question, keywords)]
    score = F.when(F.coalesce(F.lower(whole).contains(q), F.lit(False)), phrase).otherwise(0.0) if whole is not None else F.lit(0.0)
    for w in sorted(set(q.split())):
        for c, weight in zip(low, (in_name, in_question, in_keywords), strict=True):
            score = score + F.when(c.contains(w), weight).otherwise(0.0)
    return score


def keyword_search(df: DataFrame, query: str, k: int = 5, id_col: str = "id", **weights: float) -> DataFrame:
    """Similarity of the query to the block's text in order, plus ``boosts``; the best ``k``, then the smallest id."""
    q = query.lower()

    @pandas_udf("double")
    def ratio(t: pd.Series) -> pd.Series:
        return t.map(lambda x: sequence_ratio(q, x))

    words = F.array_join("keywords", ", ")
    text = F.concat_ws(" ", F.coalesce("name", F.lit("")), F.coalesce("critical_question", F.lit("")), F.coalesce("trusted_answer", F.lit("")), F.coalesce(words, F.lit("")))
    score = ratio(text) + boosts(query, F.col("name"), F.col("critical_question"), words, whole=text, **weights)
    return df.withColumn("score", score).orderBy(F.desc("score"), id_col).limit(k)


def substring_search(df: DataFrame, query: str) -> DataFrame:
    """Blocks with the query in name, answer or keywords, in any case."""
    text = F.lower(F.concat_ws(" ", "name", "trusted_answer", F.array_join("keywords", ", ")))
    return df.where(text.contains(query.lower()))


def hybrid_search(df: DataFrame, vector: list[float], query: str, k: int = 10, semantic: float = 0.7, text: Column | None = None, id_col: str = "id", vector_col: str = "embedding") -> DataFrame:
    """The 2k nearest, by ``semantic`` times similarity and the rest times the share of query words in the text."""
    words = sorted(set(query.lower().split()))
    low = F.lower(text if text is not None else F.concat_ws(" ", "name", "trusted_answer"))
    hits = reduce(lambda a, b: a + b, [F.when(low.contains(w), 1.0).otherwise(0.0) for w in words], F.lit(0.0)) / max(1, len(words))
    near = df.withColumn("distance", distance(F.col(vector_col), literal(vector))).orderBy("distance", id_col).limit(2 * k)
    return near.withColumn("score", semantic * similarity_of(F.col("distance")) + (1 - semantic) * hits).orderBy(F.desc("score"), id_col).limit(k)


def ranked(df: DataFrame, score: Column, id_col: str, window: int | None = None) -> DataFrame:
    """(id, rank from 0) by falling score, then id; only the first ``window``."""
    top = df.select(F.col(id_col).alias("id"), score.alias("_s")).orderBy(F.desc("_s"), "id")
    top = top.limit(window) if window else top
    return top.select("id", (F.row_number().over(Window.orderBy(F.desc("_s"), "id")) - 1).alias("rank"))


def fuse(lists: list[DataFrame], constant: float = 60, weights: list[float] | None = None) -> DataFrame:
    """(id, score): sums of weight / (constant + rank) over ranked lists."""
    weights = weights or [1.0] * len(lists)
    parts = [r.select("id", (F.lit(float(w)) / (F.lit(float(constant)) + F.col("rank"))).alias("s")) for r, w in zip(lists, weights, strict=True)]
    return reduce(DataFrame.unionByName, parts).groupBy("id").agg(F.sum("s").alias("score"))


def _count(tokens: Column, word: str) -> Column:
    return F.size(F.filter(tokens, lambda x: x == F.lit(word)))


def bm25(df: DataFrame, query: str, fields: dict[str, float], k: int = 10, id_col: str = "id", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(id, score) of the best ``k`` by BM25 of each field times its weight; words are runs of letters and digits in lower case."""
    words = sorted(set(query.lower().split()))
    tokens = [F.regexp_extract_all(F.lower(F.coalesce(F.col(f), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)) for f in fields]
    counted = df.select(F.col(id_col).alias("id"), *[F.size(t).alias(f"n{i}") for i, t in enumerate(tokens)], *[_count(t, w).alias(f"c{i}_{j}") for i, t in enumerate(tokens) for j, w in enumerate(words)])
    sums = [F.count("*").alias("docs"), *[F.avg(f"n{i}").alias(f"a{i}") for i in range(len(fields))], *[F.count_if(F.col(f"c{i}_{j}") > 0).alias(f"d{i}_{j}") for i in range(len(fields)) for j in range(len(words))]]
    rows = counted.crossJoin(F.broadcast(counted.agg(*sums)))  # one row
    score = F.lit(0.0)
    for i, weight in enumerate(fields.values()):
        length = F.lit(1 - b) + b * F.try_divide(F.col(f"n{i}"), F.col(f"a{i}"))
        for j in range(len(words)):
            c, d = F.col(f"c{i}_{j}"), F.col(f"d{i}_{j}")
            idf = F.log(1 + (F.col("docs") - d + 0.5) / (d + 0.5))
            score = score + F.when(c > 0, weight * idf * c * (k1 + 1) / (c + k1 * length)).otherwise(0.0)
    return rows.select("id", score.alias("score")).where("score > 0").orderBy(F.desc("score"), "id").limit(k)


def by_entity(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col("primary_entity") == name.upper())


def list_entities(df: DataFrame, entity_type: str | None = None, id_col: str = "id") -> DataFrame:
    """(primary_entity, entity_type of the first block, blocks) of each entity."""
    rows = df.where(F.col("primary_entity_type") == entity_type.upper()) if entity_type else df
    return rows.where("primary_entity <> ''").groupBy("primary_entity").agg(F.min_by("primary_entity_type", id_col).alias("entity_type"), F.count("*").alias("blocks"))


def co_mentions(edges: DataFrame, node: str = "id", shared: str = "entity") -> DataFrame:
    """(a, b, n): pairs of ``shared`` that occur on the same ``node``, and on how many."""
    once = edges.select(node, shared).distinct()
    left, right = once.select(node, F.col(shared).alias("a")), once.select(node, F.col(shared).alias("b"))
    return left.join(right, node).where("a < b").groupBy("a", "b").agg(F.count("*").alias("n"))


def hops(edges: DataFrame, start: DataFrame, most: int = 3) -> DataFrame:
    """(id, hops) of what lies within ``most`` undirected steps of ``start``."""
    both = edges.select(F.col("a").alias("s"), F.col("b").alias("t")).union(edges.select("b", "a")).distinct()
    seen = start.select(F.col(start.columns[0]).alias("id")).distinct().withColumn("hops", F.lit(0))
    front = seen
    for k in range(1, most + 1):
        front = front.join(both, front["id"] == both["s"]).select(F.col("t").alias("id")).distinct().join(seen.select("id"), "id", "left_anti").withColumn("hops", F.lit(k))
        seen = seen.unionByName(front)
    return seen


def retrieval_quality(hits: DataFrame, k: int) -> DataFrame:
    """recall_at_k, precision_at_k and mrr of (query, rank from 1, relevant, n_relevant)."""
    per = hits.where(F.col("rank") <= k).groupBy("query").agg(F.count_if("relevant").alias("got"), F.max("n_relevant").alias("all"), F.min(F.when(F.col("relevant"), F.col("rank"))).alias("first"))
    return per.agg(F.avg(F.try_divide("got", "all")).alias("recall_at_k"), F.avg(F.col("got") / k).alias("precision_at_k"), F.avg(F.coalesce(1 / F.col("first"), F.lit(0.0))).alias("mrr"))


def multi_vector_search(df: DataFrame, vector: list[float], vector_cols: dict[str, float], k: int = 10, window: int = 50, constant: float = 60, id_col: str = "id") -> DataFrame:
    """(id, score): ranked lists by each vector column, fused with the columns' weights."""
    lists = [ranked(df, -distance(F.col(c), literal(vector)), id_col, window) for c in vector_cols]
    return fuse(lists, constant, list(vector_cols.values())).orderBy(F.desc("score"), "id").limit(k)


def semantic_chunks(sentences: DataFrame, threshold: float = 0.7, doc: str = "doc_id", position: str = "position", vector_col: str = "embedding") -> DataFrame:
    """``sentences`` with ``chunk``: a new one begins where a sentence's similarity to the one before is below the threshold."""
    w = Window.partitionBy(doc).orderBy(position)
    before = F.lag(vector_col).over(w)
    cut = sentences.withColumn("_cut", F.when(before.isNotNull() & (1 - distance(F.col(vector_col), before) < threshold), 1).otherwise(0))
    return cut.withColumn("chunk", F.sum("_cut").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_cut")


def visible_to(df: DataFrame, tenant: str, role: str, tenant_col: str = "org_id", tags_col: str = "tags") -> DataFrame:
    """Rows of the tenant whose tags hold the role."""
    return df.where((F.col(tenant_col) == tenant) & F.array_contains(tags_col, role))


def governed(df: DataFrame, tag: str, sources: list[str], source_col: str = "source_document", tags_col: str = "tags") -> DataFrame:
    return df.where(F.array_contains(tags_col, tag) & F.col(source_col).isin(sources))


def search_knowledge(df: DataFrame, vector: list[float], k: int = 5, **filters) -> DataFrame:
    """Nearest blocks with score and a short answer."""
    from millrace.functions.text import truncated
    from millrace.operators.similarity import conditions, vector_search

    found = vector_search(df, vector, k, conditions(**filters))
    return found.select("id", "name", truncated(F.col("trusted_answer")).alias("answer"), F.slice("tags", 1, 5).alias("tags"), similarity_of(F.col("distance")).alias("score"))


def get_block_by_id(df: DataFrame, block_id: str) -> DataFrame:
    return df.where(F.col("id") == block_id)
