"""Text columns: chunking, identities, counts. All expressions, no Python at run time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that word counts leave out (fixed values).
STOP_WORDS = (
    "a an the and or but in on at to for with by of is are was were can that as be use more this their from it have how "
    "using new across into between among over under again further then once here there when where why all any some "
    "one two three four five six seven eight nine ten not they other another such no yes out up down back off onto via "
    "our your its has had been being do does did will would could should may might must shall if than so just also only "
    "very too each which who whom what these those"
).split()


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def short_hash(c: Column) -> Column:
    """First 16 hex digits of SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 16)


def chunks(text: Column, size: int = 2000, overlap: int = 200) -> Column:
    """Array of overlapping chunks.

    Line ends become spaces; sentences end at ". ". Sentences are gathered until the next would make
    the chunk longer than ``size``; the next chunk begins with the last ``overlap`` characters of the
    one before. A null text has no chunks, as has one of white space.
    """
    sentences = F.filter(F.transform(F.split(F.regexp_replace(text, "\n", " "), "[.] "), strip), lambda s: s != "")
    ended = F.transform(sentences, lambda s: F.concat(s, F.lit(". ")))
    empty = F.struct(F.array().cast("array<string>").alias("out"), F.lit("").alias("cur"))

    def step(acc: Column, s: Column) -> Column:
        full = (F.length(acc["cur"]) + F.length(s) > size) & (acc["cur"] != "")
        return F.struct(
            F.when(full, F.concat(acc["out"], F.array(acc["cur"]))).otherwise(acc["out"]).alias("out"),
            F.when(full, F.concat(F.right(acc["cur"], F.lit(overlap)), s)).otherwise(F.concat(acc["cur"], s)).alias("cur"),
        )

    def finish(acc: Column) -> Column:
        return F.when(acc["cur"] != "", F.concat(acc["out"], F.array(acc["cur"]))).otherwise(acc["out"])

    return F.coalesce(F.aggregate(ended, empty, step, finish), F.array().cast("array<string>"))


def embed_text(name: Column, question: Column, answer: Column, block_id: Column) -> Column:
    """The non-empty stripped fields, joined; a block without any stands for its id."""
    parts = F.filter(F.array(*[strip(F.coalesce(c, F.lit(""))) for c in (name, question, answer)]), lambda x: x != "")
    return F.when(F.size(parts) > 0, F.array_join(parts, " ")).otherwise(F.concat(F.lit("block-"), block_id))


def stored_text(name: Column, question: Column, answer: Column) -> Column:
    """All three fields joined, empty ones too."""
    return F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in (name, question, answer)])


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)\S+"), F.lit(0)))


def char_count(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def tokens(chars: Column) -> Column:
    """A quarter of the characters, halves rounded to even."""
    return F.bround(chars / 4, 0).cast("long")


def block_chars(name: Column, question: Column, answer: Column) -> Column:
    return char_count(name) + char_count(question) + char_count(answer)


def all_words(text: Column) -> Column:
    """Lower-case runs of letters, digits and underscores, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def counted(word: Column) -> Column:
    """Whether a word counts: only a-z, more than two letters, no stop word."""
    return (F.length(word) > 2) & word.rlike("^[a-z]+$") & ~word.isin(*STOP_WORDS)


def counted_words(text: Column) -> Column:
    """The words of ``all_words`` that count."""
    return F.filter(all_words(text), counted)


def truncated(text: Column, most: int = 200) -> Column:
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit("..."))).otherwise(text)
