import difflib

import pytest
from pyspark.sql import functions as F

from millrace.operators import search as S


@pytest.fixture(scope="module")
def df(spark):
    rows = [("a", "Reset password", "How to reset?", "Use the link", ["login"]), ("b", "Billing", "When paid?", "Monthly reset of bills", []), ("c", None, None, None, None)]
    return spark.createDataFrame(rows, "id string, name string, critical_question string, trusted_answer string, keywords array<string>")


def test_keyword_search(df):
    got = {r.id: r.score for r in S.keyword_search(df, "Reset password").collect()}
    base = difflib.SequenceMatcher(None, "reset password", "reset password how to reset? use the link login").ratio()
    assert got["a"] == pytest.approx(base + 0.4 + 0.15 * 2 + 0.10) and list(got)[0] == "a" and len(got) == 3


def test_substring_and_fusion(spark, df):
    assert [r.id for r in S.substring_search(df, "RESET").orderBy("id").collect()] == ["a", "b"]
    one = spark.createDataFrame([("x", 0), ("y", 1)], "id string, rank int")
    got = {r.id: r.score for r in S.fuse([one, one.where("id = 'y'")], 60).collect()}
    assert got == {"x": pytest.approx(1 / 60), "y": pytest.approx(2 / 61)}


def test_bm25_ranks_the_field_with_weight(df):
    assert [r.id for r in S.bm25(df, "reset", {"name": 3.0, "trusted_answer": 1.0}).collect()] == ["a", "b"]


def test_entities_and_hops(spark):
    e = spark.createDataFrame([(1, "p"), (1, "q"), (2, "p"), (2, "q"), (2, "q"), (3, "p")], "id int, entity string")
    assert [tuple(r) for r in S.co_mentions(e).collect()] == [("p", "q", 2)]
    path = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5)], "a int, b int")
    got = {r.id: r.hops for r in S.hops(path, spark.createDataFrame([(1,)], "id int")).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: 3}


def test_hybrid(spark):
    v = spark.createDataFrame([("a", [1.0, 0.0], "x"), ("b", [0.9, 0.1], "want this"), ("c", [0.0, 1.0], "want this")], "id string, embedding array<double>, t string")
    assert [r.id for r in S.hybrid_search(v, [1.0, 0.0], "want this", 2, text=F.col("t")).collect()] == ["b", "a"]
