"""The pipeline's stages on its own rows, and on planted cases."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import registry
from millrace.plans.scratch import keep


def planted(spark, folder):
    rng = random.Random(4)
    text = lambda n: ". ".join(" ".join(f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(400)}" for _ in range(12)) for _ in range(n // 12))
    docs = [(i, text(240)) for i in range(40)]
    for i in range(40, 44):
        docs.append((i, docs[i - 40][1]))  # exact copies
    for i in range(44, 48):
        w = docs[i - 40][1].split()
        w[100] = "changed"
        docs.append((i, " ".join(w)))  # near copies
    passage = text(72)
    for i in (10, 11, 12):
        docs[i] = (i, docs[i][1] + "\n" + passage)
    item = text(36)
    docs[20] = (20, docs[20][1][:300] + " " + item + " " + docs[20][1][300:])
    for i in range(48, 80):
        docs.append((i, text(120) + " you worthless scum idiot moron " + text(60)))
    docs += [(90, None), (91, "")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    rows.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, 0) for i in range(0, 48)] + [(i, 1, 1) for i in range(48, 70)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return passage


def test_stages_catch_planted_cases_and_keep_the_rest(spark, tmp_path):
    folder = str(tmp_path)
    passage = planted(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    seen = [set(range(80)) | {90, 91}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = keep(stage(spark, docs, folder), name)
        assert after.columns == docs.columns
        seen.append(ids(after))
        docs = after
        if name == "substring_dedup":
            having = {r.doc_id for r in docs.where(F.contains("text", F.lit(passage))).collect()}
            assert having == {10} and all(r.n_chars == len(r.text) for r in docs.where("text is not null").collect())
    assert seen[1] == seen[0] - set(range(48, 80))
    assert seen[2] == seen[1] - set(range(40, 48)) - {91}  # a null and an empty text are copies
    assert seen[3] == seen[2] and seen[4] == seen[3] - {20}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert ids(packed) == seen[4]
    assert ids(corpus_pipeline.run(spark, folder)) == seen[4]


def test_stages_take_an_empty_table(spark, tmp_path, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


#: Names that the operators use inside, as extra columns of the input.
INNER = (
    "_id", "_hash", "_lines", "_text", "_text_hash", "_0", "_order", "id", "row", "row_id", "row_hash", "text_hash", "rejected", "p_toxic", "key", "bucket", "unit", "side",
    "digest", "fp", "first", "spot", "class", "place", "lines", "spans", "span", "kept", "component", "seed", "item", "item_row", "words", "shift", "piece", "length", "sequence_id",
)


def test_stages_take_odd_rows_and_any_names(spark, tmp_path):
    folder = str(tmp_path)
    planted(spark, folder)
    long = " ".join(f"long{i % 997}x{i // 997}" for i in range(60_000))
    run, other = " ".join(f"run{i}" for i in range(60)), lambda name: " ".join(f"{name}{i}" for i in range(40))
    rows = [(1, None), (1, None), (2, ""), (3, " \n "), (None, "a text without an id"), (None, "a text without an id"), (5, long), (6, f"{other('before')}\n{run}"), (7, f"{run} {other('after')}"), (8, "short")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, number int").withColumns({c: F.concat(F.lit(f"{c} "), F.col("number")) for c in INNER})
    docs = keep(docs, "odd")
    want = {r.number: r.asDict() for r in docs.collect()}
    left = {"toxicity": set(range(10)), "simhash_near_dedup": {0, 4, 6, 7, 8, 9}, "substring_dedup": set(range(10)), "benchmark_decontamination": set(range(10))}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        got = out.collect()
        assert out.columns == docs.columns and {r.number for r in got} - {1, 5} == left[name] - {1, 5}, name
        for r in got:
            same = {**want[r.number], "text": r.text}
            assert r.asDict() == same and (r.text == want[r.number]["text"] or name == "substring_dedup" and r.number == 8)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert sorted(str(r.doc_id) for r in packed if r.piece == 0) == sorted(str(r[0]) for r in rows)
    assert max(r.piece for r in packed if r.doc_id == 5) > 100


def brute_run(spark, folder):
    """The pipeline's first four stages on its planted rows, by definition."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    item = spark.read.parquet(f"{folder}/benchmark.parquet").first().text
    docs = {i: t for i, t in docs.items() if i not in range(48, 80)}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for i, t in docs.items()}
    close = lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b)
    stay = [i for i in sorted(docs) if not any(close(sets[i], sets[j]) for j in docs if j < i)]
    seen, out = set(), {}
    for i in stay:
        w = (docs[i] or "").split()
        gone = {x for p in range(len(w) - 44) if tuple(w[p : p + 45]) in seen for x in range(p, p + 45)}
        seen |= {tuple(w[p : p + 45]) for p in range(len(w) - 44)}
        out[i] = [x for k, x in enumerate(w) if k not in gone]
    return {i: w for i, w in out.items() if item not in " ".join(w)}


def test_pipeline_against_brute_force(spark, tmp_path):
    folder = str(tmp_path)
    planted(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = keep(stage(spark, docs, folder), name)
    assert {r.doc_id: (r.text or "").split() for r in docs.collect()} == brute_run(spark, folder)


def test_every_operator_has_its_query():
    names = {n.split("_")[0] for n in registry.QUERIES}
    assert names == {f"op{i}" for i in range(1, 11)} and len(corpus_pipeline.STAGES) == 5
