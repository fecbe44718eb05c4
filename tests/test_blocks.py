import json

import pytest
from pyspark.sql import functions as F

from millrace.functions import blocks as B

ONE = "<ideablock><name>N</name><critical_question>Q?</critical_question><trusted_answer>A</trusted_answer>"


def parse(spark, *answers, how=B.parse, **options):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(answers)], "i int, x string")
    return sorted(how(df, "x", **options).collect(), key=lambda r: (r.i, r.block_index))


def test_strict_parse(spark):
    full = ONE + "<tags>A, B,, </tags><keywords></keywords><entity><entity_name>E</entity_name><entity_type>T</entity_type></entity><entity><entity_name>F</entity_name></entity></ideablock>"
    rows = parse(spark, full + ONE + "</ideablock>", "<ideablock><name>only</name></ideablock>", "", None, "<IDEABLOCK><name>x</name></IDEABLOCK>")
    assert [(r.i, r.name, r.tags, r.keywords, r.primary_entity, r.primary_entity_type) for r in rows] == [(0, "N", ["A", "B"], [], "E", "T"), (0, "N", [], [], "", "")]
    assert rows[0].id == rows[1].id and rows[0].id.startswith("ib_") and len(rows[0].entities) == 2
    assert len(parse(spark, "<ideablock><name>only</name></ideablock>", strict=False)) == 1


@pytest.mark.parametrize(
    "answer",
    [
        ONE + "</ideablock>",
        '<IdeaBlock id="1"><N>N</N><Question a="b">Q?</Question><Answer>A</Answer></IDEABLOCK>',
        ONE,
        json.dumps([{"name": "N", "question": "Q?", "answer": "A"}]),
        json.dumps({"name": "N", "criticalQuestion": "Q?", "trustedAnswer": "A"}),
        "so:\n```json\n" + json.dumps([{"name": "N", "critical_question": "Q?", "trusted_answer": "A"}]) + "\n```",
        "<name>N</name><question>Q?</question><answer>A</answer>",
    ],
)
def test_answers(spark, answer):
    (row,) = parse(spark, answer, how=B.parse_answers)
    assert (row.name, row.critical_question, row.trusted_answer) == ("N", "Q?", "A")


def test_answers_without_blocks(spark):
    assert parse(spark, "", None, "nothing", "[1, 2]", "<ideablock><name>x</name></ideablock>", how=B.parse_answers) == []


def test_xml_round_trip(spark):
    df = spark.createDataFrame([("a < b & c", 'q "x"?', "<b>"), ("n", "q", "a &amp; b")], "n string, q string, a string").withColumn("x", B.to_xml(F.col("n"), F.col("q"), F.col("a"), F.array(F.lit("T&")), F.array(F.lit("k1"), F.lit("k2"))))
    got = sorted((r.name, r.critical_question, r.trusted_answer, tuple(r.tags), tuple(r.keywords)) for r in B.parse(df.select("x"), "x").collect())
    assert got == [("a < b & c", 'q "x"?', "<b>", ("T&",), ("k1", "k2")), ("n", "q", "a &amp; b", ("T&",), ("k1", "k2"))]


def test_keep_first_and_validate(spark):
    df = spark.createDataFrame([("x", 2), ("x", 1), ("y", 3)], "id string, n int")
    assert sorted(map(tuple, B.keep_first(df, "id", "n").collect())) == [("x", 1), ("y", 3)]
    bad = spark.createDataFrame([("n" * 101, "q", "a" * 501, ["lower"], ["k"] * 16)], "name string, critical_question string, trusted_answer string, tags array<string>, keywords array<string>")
    assert B.validate(bad).first().problems == ["name_long", "question_mark", "answer_long", "tags_case", "keywords_many"]
