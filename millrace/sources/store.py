"""Collections of blocks as Parquet snapshots, files in and out, and the jobs table.

A collection is a folder with one folder for each version; writing makes a new
version from the last and then removes nothing, so a reader keeps what it opened. One
writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.blocks import keep_first, parse


def text_files(spark: SparkSession, path: str, extensions: tuple[str, ...] = ("txt", "md")) -> DataFrame:
    """(source_document, text) of the files below ``path`` with one of the extensions, whole."""
    glob = "*.{" + ",".join(extensions) + "}"
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    return rows.select(F.regexp_extract(F.input_file_name(), "([^/]+)$", 1).alias("source_document"), F.col("value").alias("text"))


def json_blocks(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("multiLine", True).schema(schema).json(path)


def jsonl_blocks(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def xml_blocks(spark: SparkSession, path: str) -> DataFrame:
    return parse(text_files(spark, path, ("xml",)), "text")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def wire(df: DataFrame, prefix: str = "block", kind: str = "original", text_name: str = "textResult") -> DataFrame:
    """Nested form in which blocks travel; ``prefix`` begins the names that a service gives them, ``text_name`` is that of the text's fields."""
    text = F.struct("name", F.col("critical_question").alias("criticalQuestion"), F.col("trusted_answer").alias("trustedAnswer"))
    flags = [F.lit(False).alias(c) for c in ("hidden", "exported", "reviewed")]
    return df.select(F.lit(kind).alias("type"), F.col("id").alias(f"{prefix}ResultUUID"), text.alias(text_name), *flags, F.col("source_document").alias(f"{prefix}DocumentUUID"))


def from_wire(df: DataFrame, prefix: str = "block", text_name: str = "textResult") -> DataFrame:
    """Blocks from their nested form: id, name, critical_question, trusted_answer, source_document, type, hidden, exported, reviewed, parents.

    Fields that the input lacks have their defaults: type original, flags false, no document and no parents.
    """
    has = set(df.columns)
    given = lambda name, default: F.coalesce(F.col(name), default) if name in has else default
    text = {c: F.coalesce(F.col(f"{text_name}.{n}"), F.lit("")).alias(c) for c, n in (("name", "name"), ("critical_question", "criticalQuestion"), ("trusted_answer", "trustedAnswer"))}
    flags = [given(c, F.lit(False)).alias(c) for c in ("hidden", "exported", "reviewed")]
    document, parents = given(f"{prefix}DocumentUUID", F.lit(None).cast("string")), given(f"{prefix}ResultsUsed", F.lit(None).cast("array<string>"))
    return df.select(F.col(f"{prefix}ResultUUID").alias("id"), *text.values(), document.alias("source_document"), given("type", F.lit("original")).alias("type"), *flags, parents.alias("parents"))


class Collection:
    """A named set of blocks with the column ``id``."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/{name}"

    def _versions(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        done = lambda p: fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))
        return sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(path) if s.getPath().getName().startswith("v") and done(s.getPath()))

    def exists(self) -> bool:
        return bool(self._versions())

    def read(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v{self._versions()[-1]}")

    def write(self, df: DataFrame) -> DataFrame:
        n = (self._versions() or [0])[-1] + 1
        df.write.parquet(f"{self.path}/v{n}")
        return self.read()

    def upsert(self, rows: DataFrame) -> DataFrame:
        """Insert or replace by id; of rows with one id the first (by all its columns) counts."""
        new = keep_first(rows, "id", *[c for c, t in rows.dtypes if not t.startswith(("map", "variant")) and c != "id"])
        return self.write(upserted(self.read(), new) if self.exists() else new)

    def mark_distilled(self, ids: DataFrame, at: Column, task: str) -> DataFrame:
        return self.write(marked(self.read(), ids, at, task))

    def delete_source(self, source: str) -> DataFrame:
        return self.write(self.read().where(~F.coalesce(F.col("source_document") == source, F.lit(False))))

    def get(self, *ids: str) -> DataFrame:
        return self.read().where(F.col("id").isin(*ids))

    def active(self, limit: int | None = None) -> DataFrame:
        rows = active(self.read())
        return rows.orderBy("id").limit(limit) if limit else rows


def upserted(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.join(new, "id", "left_anti").unionByName(new, allowMissingColumns=True)


def active(df: DataFrame) -> DataFrame:
    return df.where(~F.coalesce(F.col("distilled"), F.lit(False))) if "distilled" in df.columns else df


def marked(df: DataFrame, ids: DataFrame, at: Column, task: str) -> DataFrame:
    """``df`` with distilled, distilled_at and distill_task set for the ids; ids without a row change nothing."""
    hit = ids.select(F.col(ids.columns[0]).alias("id")).distinct().withColumn("_hit", F.lit(True))
    have = set(df.columns)
    old = {c: F.col(c) if c in have else F.lit(None).cast(t) for c, t in (("distilled", "boolean"), ("distilled_at", "timestamp"), ("distill_task", "string"))}
    new = {"distilled": F.lit(True), "distilled_at": at.cast("timestamp"), "distill_task": F.lit(task)}
    return df.join(hit, "id", "left").withColumns({c: F.when(F.col("_hit"), new[c]).otherwise(old[c]) for c in old}).drop("_hit")


def stats(df: DataFrame) -> DataFrame:
    return df.groupBy("block_type", F.coalesce("distilled", F.lit(False)).alias("distilled")).agg(F.count("*").alias("blocks"))


def pick(*collections: Collection) -> Collection | None:
    """The first that has rows."""
    return next((c for c in collections if c.exists() and not c.read().isEmpty()), None)


def job_counts(jobs: DataFrame, now: float, hours: float = 24) -> DataFrame:
    """Running jobs, and those that ended in the last hours."""
    return jobs.agg(F.count_if(F.col("status") == "running").alias("active"), F.count_if((F.col("status") != "running") & (F.col("completed_at") >= now - hours * 3600)).alias("completed"))


def expired(jobs: DataFrame, now: float, days: float) -> DataFrame:
    return jobs.where(F.col("completed_at") < now - days * 86400)
