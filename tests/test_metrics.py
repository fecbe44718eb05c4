import math

import pytest
from pyspark.sql import functions as F

from millrace.functions import metrics as M
from millrace.operators import report as R


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("d1", "d2", "w1", "w2", "vector", "word", "total", "projected"), [(0.4, 0.2, 10000, 400, 2.0, 25.0, 50.0, 750.0), (0.3, 0.3, 1000, 1000, 1.0, 1.0, 1.0, 15.0), (0.5, 0.1, 50000, 1000, 5.0, 50.0, 250.0, 3750.0)])
def test_goldens(spark, d1, d2, w1, w2, vector, word, total, projected):
    v, w = M.improvement(F.lit(d1), F.lit(d2)), M.improvement(F.lit(w1), F.lit(w2))
    got = spark.range(1).select(v, w, M.aggregate(v, w), M.projected(v, w)).first()
    assert list(got) == pytest.approx([vector, word, total, projected])


def test_guards(spark):
    null = F.lit(None).cast("double")
    for a, b in ((0, 1), (1, 0), (-1, 1)):
        assert value(spark, M.improvement(F.lit(a), F.lit(b))) == 0
    assert value(spark, M.improvement(null, F.lit(1.0))) == 0
    assert value(spark, M.aggregate(F.lit(2.0), F.lit(0.0))) == 2
    assert value(spark, M.gain(F.lit(0.4), F.lit(0.1))) == pytest.approx(75)
    assert value(spark, M.valid(F.lit(1.0), F.lit(float("nan")))) is False
    assert value(spark, M.valid(F.lit(1.0), null)) is False


def test_mean_distance_leaves_out_what_is_not_finite(spark):
    df = spark.createDataFrame([(0.1,), (0.3,), (float("nan"),), (float("inf"),), (None,)], "d double")
    assert df.agg(M.mean_distance(F.col("d"))).first()[0] == pytest.approx(0.2)
    assert df.where("d > 5 and not isnan(d)").where("d < 6").agg(M.mean_distance(F.col("d"))).first()[0] is None


def test_comparison_without_chunks_is_null(spark):
    rows = spark.createDataFrame([(float("inf"), 0.2, 0.1)], "chunk_distance double, raw_distance double, distilled_distance double")
    row = R.comparison(rows, 100, 10)
    got = row.first()
    assert got.chunk_distance is None and got.vector_improvement == 0 and got.word_improvement == 10
    assert "n/a" in R.report_html(row, "t") and '"chunk_distance": null' in R.report_json(row)


def test_token_stats(spark):
    chunks = spark.createDataFrame([("x" * 400,)], "text string")
    blocks = spark.createDataFrame([("n" * 4, "q" * 5, "a" * 7)], "name string, critical_question string, trusted_answer string")
    row = R.token_stats(chunks, blocks, blocks).first()
    assert (row.chunk_tokens, row.raw_tokens, row.distilled_mean, row.chunk_year) == (100, 4, 4, 500_000)
    assert row.token_improvement == 25 and math.isclose(row.cost_saving, (500_000 - 20_000) / 1e6 * 0.72)
