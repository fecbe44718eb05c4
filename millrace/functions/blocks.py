"""Question-and-answer blocks: parsing from XML or JSON, writing, identity, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import short_hash, strip

#: Column names and their spellings in model answers (fixed values).
FIELDS = {"name": "name|n", "critical_question": "critical_question|criticalQuestion|question", "trusted_answer": "trusted_answer|trustedAnswer|answer"}
_JSON = "array<struct<name:string,n:string,critical_question:string,criticalQuestion:string,question:string,trusted_answer:string,trustedAnswer:string,answer:string>>"


def unescaped(c: Column) -> Column:
    for entity, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return c


def escaped(c: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def field(text: Column, tag: str) -> Column:
    """Stripped content of the first ``tag``; empty if there is none."""
    return unescaped(strip(F.regexp_extract(text, rf"(?s)<{tag}>(.*?)</{tag}>", 1)))


def listed(csv: Column) -> Column:
    """Comma-separated values, stripped, without empty ones."""
    return F.filter(F.transform(F.split(csv, ","), strip), lambda x: x != "")


def block_id(name: Column, question: Column, answer: Column, prefix: str = "ib_") -> Column:
    return F.concat(F.lit(prefix), short_hash(F.concat(name, question, answer)))


def required(df: DataFrame) -> DataFrame:
    return df.where((F.col("name") != "") & (F.col("critical_question") != "") & (F.col("trusted_answer") != ""))


def parse(df: DataFrame, xml: str, strict: bool = True) -> DataFrame:
    """One row for each block in the column ``xml``: the other columns, then the block's.

    ``strict`` drops blocks without name, question or answer.
    """
    rest = [c for c in df.columns if c != xml]
    found = df.select(*rest, F.posexplode(F.regexp_extract_all(xml, F.lit(r"(?s)<ideablock>(.*?)</ideablock>"), F.lit(1))).alias("block_index", "_b"))
    b = F.col("_b")
    entities = F.transform(
        F.regexp_extract_all(b, F.lit(r"(?s)<entity>(.*?)</entity>"), F.lit(1)),
        lambda e: F.struct(field(e, "entity_name").alias("name"), field(e, "entity_type").alias("type")),
    )
    out = found.select(*rest, "block_index", field(b, "name").alias("name"), field(b, "critical_question").alias("critical_question"), field(b, "trusted_answer").alias("trusted_answer"), listed(field(b, "tags")).alias("tags"), listed(field(b, "keywords")).alias("keywords"), entities.alias("entities"))
    first = F.get("entities", F.lit(0))
    out = out.withColumn("id", block_id(F.col("name"), F.col("critical_question"), F.col("trusted_answer")))
    out = out.withColumn("primary_entity", F.coalesce(first["name"], F.lit(""))).withColumn("primary_entity_type", F.coalesce(first["type"], F.lit("")))
    return required(out) if strict else out


def parse_answers(df: DataFrame, answer: str) -> DataFrame:
    """Blocks in a model's answer: tags in any case, with attributes and other spellings; else a last block that is cut off; else JSON, also fenced; else bare fields."""
    rest = [c for c in df.columns if c != answer]
    text = F.col(answer)
    whole = F.regexp_extract_all(text, F.lit(r"(?is)<ideablock\b[^>]*>(.*?)</ideablock>"), F.lit(1))
    cut = F.filter(F.array(F.regexp_extract(text, r"(?is)<ideablock\b[^>]*>(.*)$", 1)), lambda x: x != "")
    bare = F.array(text)

    def tagged(b: Column) -> Column:
        cols = [unescaped(strip(F.regexp_extract(b, rf"(?is)<({names})\b[^>]*>(.*?)</\1>", 2))).alias(c) for c, names in FIELDS.items()]
        return F.struct(*cols)

    def complete(blocks: Column) -> Column:
        return F.filter(blocks, lambda b: (b["name"] != "") & (b["critical_question"] != "") & (b["trusted_answer"] != ""))

    def from_json(source: Column) -> Column:
        rows = F.from_json(F.when(strip(source).startswith("{"), F.concat(F.lit("["), source, F.lit("]"))).otherwise(source), _JSON)
        cols = lambda r: [F.coalesce(strip(F.coalesce(*[r[n] for n in names.split("|")])), F.lit("")).alias(c) for c, names in FIELDS.items()]
        return complete(F.coalesce(F.transform(rows, lambda r: F.struct(*cols(r))), F.array().cast("array<struct<name:string,critical_question:string,trusted_answer:string>>")))

    fenced = F.regexp_extract(text, r"(?is)```(?:json)?\s*(.*?)```", 1)
    ways = [complete(F.transform(whole, tagged)), complete(F.transform(cut, tagged)), from_json(text), from_json(fenced), complete(F.transform(bare, tagged))]
    chosen = ways[-1]
    for way in reversed(ways[:-1]):
        chosen = F.when(F.size(way) > 0, way).otherwise(chosen)
    out = df.select(*rest, F.posexplode(chosen).alias("block_index", "_b")).select(*rest, "block_index", "_b.*")
    return out.withColumn("id", block_id(F.col("name"), F.col("critical_question"), F.col("trusted_answer")))


def to_xml(name: Column, question: Column, answer: Column, tags: Column | None = None, keywords: Column | None = None, entities: Column | None = None) -> Column:
    parts = [F.lit("<ideablock><name>"), escaped(name), F.lit("</name><critical_question>"), escaped(question), F.lit("</critical_question><trusted_answer>"), escaped(answer), F.lit("</trusted_answer>")]
    if tags is not None:
        parts += [F.lit("<tags>"), escaped(F.array_join(tags, ", ")), F.lit("</tags>")]
    if entities is not None:
        one = lambda e: F.concat(F.lit("<entity><entity_name>"), escaped(e["name"]), F.lit("</entity_name><entity_type>"), escaped(e["type"]), F.lit("</entity_type></entity>"))
        parts.append(F.array_join(F.transform(entities, one), ""))
    if keywords is not None:
        parts += [F.lit("<keywords>"), escaped(F.array_join(keywords, ", ")), F.lit("</keywords>")]
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts], F.lit("</ideablock>"))


def keep_first(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key, by ascending columns that make a total order; found before rows are shuffled."""
    first = F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), F.struct(*[F.col(f"`{c}`") for c in order]))
    return df.groupBy(F.col(f"`{key}`").alias("_key")).agg(first.alias("_row")).select("_row.*")


def validate(df: DataFrame) -> DataFrame:
    """``df`` with ``problems``: which of the advised limits a block breaks."""
    rules = {
        "name_long": F.length("name") > 100,
        "question_long": F.length("critical_question") > 200,
        "question_mark": ~F.col("critical_question").endswith("?"),
        "answer_long": F.length("trusted_answer") > 500,
        "tags_many": F.size("tags") > 10,
        "tags_case": F.exists("tags", lambda t: t != F.upper(t)),
        "keywords_many": F.size("keywords") > 15,
    }
    return df.withColumn("problems", F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull()))
