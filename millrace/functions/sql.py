"""Functions for SQL text: ``cosine_similarity_of``, ``seq_ratio``, ``lsh_signature``, ``chunk_text``."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf


def register(spark: SparkSession, tables: int = 10, bits: int = 8, seed: int = 42) -> None:
    """Make the functions known to the session; ``chunk_text(text)`` uses chunks of 2000 with 200 characters of overlap."""
    from millrace.operators.clusters import seq_ratio
    from millrace.operators.similarity import planes, sign_hashes

    @pandas_udf("array<long>")
    def lsh_signature(v: pd.Series) -> pd.Series:
        return v.map(lambda x: None if x is None else sign_hashes(np.array([x], dtype=float), planes(tables, bits, len(x), seed))[0].tolist())

    spark.udf.register("seq_ratio", seq_ratio)
    spark.udf.register("lsh_signature", lsh_signature)
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION cosine_similarity_of(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE
        RETURN CASE WHEN size(a) = size(b) AND aggregate(a, 0D, (s, x) -> s + x * x) > 0 AND aggregate(b, 0D, (s, x) -> s + x * x) > 0
          THEN aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x) / sqrt(aggregate(a, 0D, (s, x) -> s + x * x)) / sqrt(aggregate(b, 0D, (s, x) -> s + x * x)) ELSE 0D END""")
    spark.sql(r"""
        CREATE OR REPLACE TEMPORARY FUNCTION chunk_text(t STRING) RETURNS ARRAY<STRING>
        RETURN aggregate(
          transform(filter(transform(split(replace(t, '\n', ' '), '[.] '), s -> regexp_replace(s, '(?U)^\\s+|\\s+$', '')), s -> s <> ''), s -> s || '. '),
          named_struct('out', cast(array() AS ARRAY<STRING>), 'cur', ''),
          (acc, s) -> CASE WHEN acc.cur <> '' AND length(acc.cur) + length(s) > 2000
            THEN named_struct('out', concat(acc.out, array(acc.cur)), 'cur', right(acc.cur, 200) || s)
            ELSE named_struct('out', acc.out, 'cur', acc.cur || s) END,
          acc -> CASE WHEN acc.cur <> '' THEN concat(acc.out, array(acc.cur)) ELSE acc.out END)""")
