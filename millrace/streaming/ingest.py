"""Micro-batch ingest: text rows to blocks, upserted into a collection as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.blocks import keep_first, parse
from millrace.functions.text import stored_text
from millrace.operators.report import chunk_documents
from millrace.plans.models import Embedder, ExtractiveExtractor, Extractor, embedded, extracted
from millrace.sources.store import Collection


def extract_blocks(docs: DataFrame, extractor: Extractor | None = None, id_col: str = "doc_id", text_col: str = "text", size: int = 2000, overlap: int = 200) -> DataFrame:
    """Raw blocks of (id, text) rows, with where each came from."""
    chunked = chunk_documents(docs, size, overlap, id_col, text_col)
    answers = chunked.withColumn("xml", extracted(F.col("text"), extractor or ExtractiveExtractor()))
    named = answers.select(F.col(id_col).cast("string").alias("source_document"), F.col("text").alias("source_chunk_text"), F.col("chunk_index").alias("source_chunk_index"), F.col("chunk_hash").alias("source_chunk_hash"), "xml")
    return parse(named, "xml").withColumn("block_type", F.lit("raw")).withColumn("distilled", F.lit(False))


def ingest(docs: DataFrame, collection: Collection, extractor: Extractor | None = None, embedder: Embedder | None = None, **options) -> DataFrame:
    """Extract, keep the first of each id, embed, and upsert; running it again changes nothing."""
    blocks = keep_first(extract_blocks(docs, extractor, **options), "id", "source_document", "source_chunk_index", "block_index")
    if embedder:
        blocks = blocks.withColumn("embedding", embedded(stored_text(F.col("name"), F.col("critical_question"), F.col("trusted_answer")), embedder))
    return collection.upsert(blocks)


def ingest_stream(docs: DataFrame, collection: Collection, checkpoint: str, extractor: Extractor | None = None, embedder: Embedder | None = None, available_now: bool = True, time_col: str | None = None, late: str = "1 hour", **options) -> StreamingQuery:
    """Ingest a streaming DataFrame. An upsert repeated after a failure gives the same collection.

    With ``time_col`` rows that repeat an id and text within ``late`` of event time are dropped before they are extracted.
    """
    if time_col:
        docs = docs.withWatermark(time_col, late).dropDuplicatesWithinWatermark([options.get("id_col", "doc_id"), options.get("text_col", "text")])
    writer = docs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: ingest(batch, collection, extractor, embedder, **options) and None)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def windowed_counts(events: DataFrame, time_col: str = "ts", key: str = "event_type", size: str = "1 day", late: str = "1 day") -> DataFrame:
    """Rows for each window and key; on a stream, rows later than ``late`` are not waited for."""
    return events.withWatermark(time_col, late).groupBy(F.window(time_col, size), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")
