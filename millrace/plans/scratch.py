"""Tables written to the folder that driver and executors share.

Long plans are cut by writing a table once and reading it back: the files
outlive any executor, and unlike ``checkpoint()`` a Python stage is not run
twice to produce them.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables.

    It lies in ``spark.checkpoint.dir``. Where that is unset a temporary
    folder is taken, but only in local mode, where every task sees it.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own.setdefault(context.applicationId, tempfile.mkdtemp(prefix="millrace-"))
    return f"{base.rstrip('/')}/millrace-{context.applicationId}"


def place(spark: SparkSession, name: str) -> str:
    """A path for one new table."""
    return f"{root(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = place(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; results read from them must be written first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
