"""Toxicity, near-duplicate, repeated-passage and benchmark filters, then packing, over ``documents``.

Every stage works on all rows its predecessor kept, and all but the last return the columns of
``documents``. Odd input has these results:

* Null or empty texts, and texts without words, are never toxic, repeated or leaked; as near duplicates they are
  copies of each other, so one row of them stays. Packing gives each its end token.
* A row without an id is judged like any other; as a near duplicate it is the first of its group. Rows equal in id
  and text are one near duplicate, so one stays.
* Extra columns, whatever their names, pass through the first four stages unchanged; packing returns its own columns.
* Texts of any length are read whole. An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, packing, paragraphs, registry, simhash, toxicity
from millrace.plans.scratch import keep


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, learnt from ``labels`` on these documents, does not reject."""
    return toxicity.accepted(docs, toxicity.learn(docs, registry.table(spark, sf_dir, "labels")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies (five-word shingles, Jaccard similarity of 0.8 or more)."""
    return simhash.without_near_duplicates(docs, size=5, threshold=0.8)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; a repeated passage stays in the first that has it. ``n_chars``, if there, follows the text."""
    left = paragraphs.without_copies(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return decontaminate.without_leaks(docs, registry.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, registry.tokenizer_path(), most=1024, end_id=2)


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_near_duplicates),
    ("substring_dedup", without_repeated_passages),
    ("benchmark_decontamination", without_benchmark),
    ("best_fit_packing", packed),
]

#: Trained models, fingerprints and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written once and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
