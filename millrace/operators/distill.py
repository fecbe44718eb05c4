"""Iterative merging of similar blocks, with lineage and statistics.

Each round joins the active blocks by similarity, clusters them, merges every
cluster of two or more and replaces its members. Rounds are cut by written tables;
the driver holds only counts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.blocks import block_id
from millrace.functions.text import embed_text
from millrace.operators.clusters import clusters_of, split
from millrace.operators.similarity import similar_links, similar_pairs_lsh
from millrace.plans.models import CanonicalMerger, Embedder, HashingEmbedder, Merger, embedded
from millrace.plans.scratch import keep

BLOCK = "id string, name string, critical_question string, trusted_answer string, tags array<string>, keywords array<string>, source_document string, type string, hidden boolean, exported boolean, parents array<string>, roots array<string>"


@dataclass(frozen=True)
class Options:
    threshold: float = 0.55
    rounds: int = 4
    step: float = 0.01
    step_from: int = 1
    most: float = 0.98
    cluster_size: int = 20
    strategy: str = "exact"
    on_progress: Callable[[str, float, dict], None] | None = None
    #: Folder for the state after each round (``round-0`` ...), if wanted.
    snapshots: str | None = None

    def __post_init__(self):
        if not 0 <= self.threshold <= 1 or not 1 <= self.rounds <= 10 or self.strategy not in ("exact", "lsh"):
            raise ValueError(f"bad options: {self}")


@dataclass
class Result:
    """``blocks`` are all ever seen; ``visible`` those that count at the end."""

    blocks: DataFrame
    start: int
    merged: int
    trace: list[dict] = field(default_factory=list)

    @property
    def visible(self) -> DataFrame:
        return self.blocks.where(~F.col("hidden"))

    def service_view(self) -> DataFrame:
        """Only merged blocks are visible, as the service shows them."""
        return self.blocks.withColumn("hidden", F.col("hidden") | (F.col("type") != "merged"))

    def stats(self) -> DataFrame:
        return statistics(self.blocks, self.start)


def statistics(blocks: DataFrame, start: int) -> DataFrame:
    """One row: both sets of counts, of the algorithm (survivors and merged) and of the service (merged alone)."""
    live = ~F.col("hidden")
    merged = live & (F.col("type") == "merged")
    row = blocks.agg(F.count_if(live).alias("final_blocks"), F.count_if(merged).alias("blocks_added"))
    percent = lambda final: F.round(F.when(F.lit(start) > 0, (1 - F.col(final) / F.lit(max(start, 1))) * 100).otherwise(0.0), 2)
    return row.select(
        F.lit(start).cast("long").alias("start_blocks"), "final_blocks", (F.lit(start) - F.col("final_blocks") + F.col("blocks_added")).alias("blocks_removed"), "blocks_added",
        percent("final_blocks").alias("reduction_percent"), F.col("blocks_added").alias("service_final_blocks"), percent("blocks_added").alias("service_reduction_percent"),
    )


def normal(blocks: DataFrame) -> DataFrame:
    """``blocks`` with every column of the block schema; missing ones get their defaults."""
    given = set(blocks.columns)
    default = {"type": F.lit("original"), "hidden": F.lit(False), "exported": F.lit(False)}
    cols = []
    for part in BLOCK.split(", "):
        name, kind = part.split(" ", 1)
        value = F.col(name).cast(kind) if name in given else F.lit(None).cast(kind)
        cols.append((F.coalesce(value, default[name]) if name in default else value).alias(name))
    return blocks.select(*cols)


_MERGED = "cluster string, part long, ordinal long, failed boolean, name string, critical_question string, trusted_answer string, tags array<string>, keywords array<string>"


def merge_clusters(members: DataFrame, merger: Merger, most: int = 20) -> DataFrame:
    """A merged block for each ``cluster`` of two or more; clusters of more than ``most`` are merged in parts first.

    Each part is a task's group, and what ``most`` adjacent parts give is merged in the next level, until a cluster has
    one part or a level makes it no smaller. A merger that fails, or returns nothing, leaves its cluster unmerged: no row comes out.
    """
    fields = ["name", "critical_question", "trusted_answer", "tags", "keywords"]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("id").to_dict("records")
        cluster, part = rows[0]["cluster"], int(rows[0]["part"])
        try:
            blocks = merger.merge(rows) if len(rows) > 1 else rows
        except Exception:  # a failed merge keeps its members
            blocks = []
        listed = lambda b, k: list(b[k]) if b.get(k) is not None else []
        out = [(cluster, part, i, False, *(b[k] for k in fields[:3]), listed(b, "tags"), listed(b, "keywords")) for i, b in enumerate(blocks)]
        return pd.DataFrame(out or [(cluster, part, 0, True, None, None, None, [], [])], columns=["cluster", "part", "ordinal", "failed", *fields])

    def merged(rows: DataFrame) -> DataFrame:
        return keep(rows.groupBy("cluster", "part").applyInPandas(run, _MERGED), "merge-level")

    members = members.withColumn("cluster", F.col("cluster").cast("string"))
    level, done = merged(members.select("id", "cluster", F.col("part").cast("long").alias("part"), *fields)), []
    while True:
        sizes = level.groupBy("cluster").agg(F.count("*").alias("n"), F.max("part").alias("top"), F.max("failed").alias("bad"))
        left = keep(sizes.where("top > 0 and n > 1 and not bad").select("cluster", "n"), "merge-left")
        done.append(level.join(left, "cluster", "left_anti").join(sizes.where("not bad").select("cluster"), "cluster", "left_semi"))
        if left.isEmpty():
            break
        before = level.join(left.select("cluster"), "cluster", "left_semi")
        place = F.concat(F.lpad(F.col("part").cast("string"), 12, "0"), F.lpad(F.col("ordinal").cast("string"), 12, "0"))
        after = merged(before.select(place.alias("id"), "cluster", F.expr(f"part div {most}").alias("part"), *fields))
        counts = after.groupBy("cluster").agg(F.count("*").alias("m"), F.max("failed").alias("bad"))
        stuck = keep(left.join(counts, "cluster").where("m >= n and not bad").select("cluster"), "merge-stuck")
        done.append(before.join(stuck, "cluster", "left_semi"))
        level = after.join(stuck, "cluster", "left_anti")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    roots = F.when(F.size("roots") > 0, F.col("roots")).otherwise(F.array("id"))
    lineage = members.groupBy("cluster").agg(F.min("source_document").alias("source_document"), F.sort_array(F.collect_list("id")).alias("parents"), F.sort_array(F.array_distinct(F.flatten(F.collect_list(roots)))).alias("roots"))
    out = out.select("cluster", *fields).join(lineage, "cluster")
    key = block_id(F.col("name"), F.col("critical_question"), F.col("trusted_answer"), "merged_")
    return out.withColumn("id", F.concat(key, F.lit("_"), F.substring(F.sha2(F.array_join("parents", ","), 256), 1, 8))).withColumn("type", F.lit("merged")).withColumn("hidden", F.lit(False)).withColumn("exported", F.lit(False))


def distill(blocks: DataFrame, embedder: Embedder | None = None, merger: Merger | None = None, options: Options = Options()) -> Result:
    """Merge similar blocks over some rounds.

    Hidden and exported blocks take no part. The threshold rises by ``step`` after each round from
    number ``step_from`` (counted from zero) on. It ends early when fewer than two blocks are left, no
    pair is similar, or no cluster could be merged. Progress is told by phase (embedding, similarity, clustering,
    merging, round, done). A snapshot holds all blocks as they stand after a round, those merged away hidden.

    Pairs are not written: tiles give stars that have their components. After the first round only merged blocks, and
    members of clusters that could not be merged, are compared with all; two other blocks were below a lower threshold.
    """
    embedder, merger = embedder or HashingEmbedder(), merger or CanonicalMerger()
    tell = options.on_progress or (lambda phase, share, details: None)
    text = embed_text(F.col("name"), F.col("critical_question"), F.col("trusted_answer"), F.col("id"))
    every = normal(blocks)
    tell("embedding", 0.0, {})
    live = keep(every.where(~F.col("hidden") & ~F.col("exported")).withColumn("embedding", embedded(text, embedder)), "live")
    gone = [every.where(F.col("hidden") | F.col("exported"))]
    start, t, trace, total = live.count(), options.threshold, [], 0
    left, fresh = start, None
    for k in range(options.rounds):
        if left < 2:
            break
        tell("similarity", k / options.rounds, {"blocks": left, "threshold": round(t, 10)})
        pairs = keep(similar_links(live, t, fresh=fresh) if options.strategy == "exact" else similar_pairs_lsh(live, t), "pairs")
        if pairs.isEmpty():
            break
        tell("clustering", k / options.rounds, {})
        clusters = split(clusters_of(live, pairs).join(pairs.select(F.col("id_a").alias("id")).union(pairs.select("id_b")).distinct(), "id"), options.cluster_size)
        members = live.join(clusters, "id")
        tell("merging", k / options.rounds, {})
        merged = keep(merge_clusters(members, merger, options.cluster_size), "merged")
        added = merged.count()
        trace.append({"round": k, "threshold": round(t, 10), "blocks": left, "merged": added})
        tell("round", (k + 1) / options.rounds, trace[-1])
        if not added and t >= options.most:
            break
        used = keep(merged.select(F.explode("parents").alias("id")).distinct(), "used")
        gone.append(live.join(used, "id", "left_semi").drop("embedding").withColumn("hidden", F.lit(True)))
        live = keep(live.join(used, "id", "left_anti").unionByName(normal(merged).withColumn("embedding", embedded(text, embedder))), "live")
        left = live.count()
        if options.step >= 0:  # others were compared before, at no higher threshold
            fresh = keep(live.join(pairs.select(F.col("id_a").alias("id")).union(pairs.select("id_b")).union(merged.select("id")).distinct(), "id", "left_semi"), "fresh")
        total += added
        if options.snapshots:
            state = live.drop("embedding")
            for g in gone:
                state = state.unionByName(g)
            state.write.mode("overwrite").parquet(f"{options.snapshots.rstrip('/')}/round-{k}")
        if k >= options.step_from:
            t = min(options.most, t + options.step)
    tell("done", 1.0, {"blocks": left, "merged": total})
    blocks_out = live.drop("embedding")
    for g in gone:
        blocks_out = blocks_out.unionByName(g)
    return Result(blocks_out, start, total, trace)


def direct(blocks: DataFrame, clusters: DataFrame, merger: Merger | None = None, most: int = 20) -> DataFrame:
    """Distilled blocks of given (id, cluster): single ones copied, others merged; members of a failed merge stay as they are."""
    rows = normal(blocks).join(clusters, "id")
    sized = rows.join(rows.groupBy("cluster").agg(F.count("*").alias("n")), "cluster")
    many = keep(sized.where("n > 1").drop("n").join(split(clusters, most).select("id", "part"), "id"), "many")
    merged = keep(merge_clusters(many, merger or CanonicalMerger(), most), "merged")
    failed = many.join(merged.select("cluster").distinct(), "cluster", "left_anti").drop("part")
    copies = sized.where("n = 1").drop("n").unionByName(failed).withColumn("parents", F.array("id")).withColumn("id", F.regexp_replace("id", "^ib_", "distilled_"))
    return copies.drop("cluster").unionByName(merged.drop("cluster").withColumn("id", F.regexp_replace("id", "^merged_", "distilled_")), allowMissingColumns=True).withColumn("source_count", F.size("parents"))
