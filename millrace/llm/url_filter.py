"""URL verdicts: host and path rules, and a list of URLs behind a blocked Bloom filter.

The filter of the listed canonical URLs is a table: one row of eight 64-bit words
for each block. A URL's hash names its block and one bit in each word, so a probe
touches one row. It is built with bit-wise aggregates and probed by a join: a
broadcast one while the table is small (its size is known from the count of
listed URLs), else an ordinary one on the block. What passes goes to an exact
join with the list, which removes false positives. All of it is DataFrame code.

Canonical form: no scheme, user, default port, leading ``www.`` or fragment; host in
lower case; no trailing slash; no tracking parameters; the others sorted.

Results for odd input: a null URL, or one without ``://``, has an empty host and
path and no canonical form; it fits no rule and is never listed. Repeated rows are
each judged. Ties between rules of equal length go to the first. Null or malformed
listed URLs are ignored; an empty list lists nothing. An empty table gives no rows.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Listed URLs for each 512-bit block, and the most blocks (of 72 bytes) that are broadcast.
PER_BLOCK, BROADCAST_BLOCKS = 24, 131_072
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str


def _lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host(url: Column) -> Column:
    """After the first ``://``; empty if there is none."""
    return F.coalesce(_lower(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """The form under which URLs are listed; null if there is no host."""
    name = F.regexp_replace(F.regexp_replace(F.regexp_replace(host(url), r"^.*@", ""), r":(80|443)?$", ""), r"^www\.", "")
    asked = F.regexp_extract(url, r"(?s)^[^#]*?\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~F.regexp_like(p, F.lit(_TRACKING))))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(name != "", F.concat(name, F.regexp_replace(path(url), "/+$", ""), tail))


def rule_of(host_col: Column, path_col: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none fits."""
    text = verdict = F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.host) + len(r.path)):
        fits = ((host_col == r.host) | host_col.endswith(f".{r.host}")) & path_col.startswith(r.path)
        text = F.when(fits, F.lit(r.host + r.path)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def _block(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n).cast("long"))


def _bits(key: Column) -> list[Column]:
    """One bit for each of a block's eight words, from 48 bits of a second hash."""
    h = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(8)]


def build_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter's rows: block and words w0 ... w7. Blocks without a listed URL have no row."""
    bits = _bits(F.col(key))
    return listed.groupBy(_block(F.col(key), blocks).alias("block")).agg(*[F.bit_or(b).alias(f"w{i}") for i, b in enumerate(bits)])


def possible(rows: DataFrame, key: str, filter_: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with ``possible``: whether the filter passes ``key``."""
    table = F.broadcast(filter_) if blocks <= BROADCAST_BLOCKS else filter_
    hit = F.lit(True)
    for i, b in enumerate(_bits(F.col(key))):
        hit = hit & (F.col(f"w{i}").bitwiseAND(b) != 0)
    probed = rows.withColumn("block", F.coalesce(_block(F.col(key), blocks), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks).cast("long"))))
    probed = probed.join(table, "block", "left")
    return probed.withColumn("possible", F.coalesce(hit & F.col(key).isNotNull(), F.lit(False))).drop("block", *[f"w{i}" for i in range(8)])


def judge(pages: DataFrame, listed: DataFrame, rules: list[Rule], listed_verdict: str = "block", other_verdict: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, canonical, listed (boolean) and verdict of every row of ``pages``; ``listed`` has a column of URLs."""
    known = listed.select(canonical(F.col(listed.columns[0]).cast("string")).alias("canonical")).where("canonical is not null").distinct()
    blocks = max(1, -(-known.count() // PER_BLOCK))
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), host(url).alias("host"), path(url).alias("path"), canonical(url).alias("canonical"))
    probed = possible(rows, "canonical", build_filter(known, "canonical", blocks), blocks)
    sure = probed.where("not possible").withColumn("listed", F.lit(False))
    checked = probed.where("possible").join(known.hint("shuffle_hash").withColumn("listed", F.lit(True)), "canonical", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), F.lit(listed_verdict)).otherwise(F.lit(other_verdict))
    return sure.unionByName(checked).select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), "canonical", "listed", F.coalesce(verdict, own).alias("verdict"))
