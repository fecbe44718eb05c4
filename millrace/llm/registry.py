"""The thin queries over the test tables, one for each operator, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, hnsw, language_id, license_scan, packing, paragraphs, simhash, toxicity, url_filter, warc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), size=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), most=1024, end_id=2)


@query
def op2_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, p_low_quality, p_kind_1, p_kind_2, p_toxic, rejected of every document."""
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id and the place and size of the overlap, for every text and item that overlap."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of a repeated passage (kind "line") and every repeated run of words (kind "run"): doc_id, place, component, number of copies, and whether it is the one kept."""
    return paragraphs.repeated(table(spark, sf_dir, "documents")).drop("text_hash")


#: (host, path, verdict) of the contract's rules, and the hosts whose pages are listed (fixed values).
URL_RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]
LISTED_HOSTS = r"(^|\.)(casino-win|cheap-pills|free-bets|spam-farm)\.example\.(com|net|org)$"


@query
def op8_blocked_bloom_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict; the list is every page address on the listed hosts."""
    pages = table(spark, sf_dir, "pages")
    listed = pages.where(F.regexp_like(url_filter.host(F.col("url")), F.lit(LISTED_HOSTS))).select("url")
    return url_filter.judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL["op8_blocked_bloom_url_filter"] = r"""
WITH p AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path,
    list_sort(list_filter(string_split(regexp_extract(url, '^[^#]*?\?([^#]*)', 1, 's'), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$'))) AS args
  FROM pages
), c AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':(80|443)?$', ''), '^www\.', '')
    || regexp_replace(path, '/+$', '') || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS canonical
  FROM p
), listed AS (
  SELECT DISTINCT canonical FROM c WHERE regexp_matches(host, '(^|\.)(casino-win|cheap-pills|free-bets|spam-farm)\.example\.(com|net|org)$')
), r AS (
  SELECT c.*, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM c
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


@query
def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to."""
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


ORACLE_SQL["op9_arc_to_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query
def op4_hnsw_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    return hnsw.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


@query
def op7_cross_parsing_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    model = language_id.learn(docs.where(~held_out))
    return language_id.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of every document: doc_id, paragraph, place, family, probability, best template, share of it found, confirmed."""
    docs = table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.learn(docs))
