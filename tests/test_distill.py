import math

import pytest
from pyspark.sql import functions as F

from millrace.operators import distill as D
from millrace.plans.models import CanonicalMerger, ExtractiveExtractor, HashingEmbedder
from millrace.sources import store
from millrace.streaming import ingest as I


def blocks(spark, *rows):
    return spark.createDataFrame([(f"b{i}", f"n{i}", "q?", a, [f"T{i}"], f"d{i}", h, e) for i, (a, h, e) in enumerate(rows)], "id string, name string, critical_question string, trusted_answer string, tags array<string>, source_document string, hidden boolean, exported boolean")


def failing():
    class Failing:  # inside a function, so that workers get it by value
        def merge(self, rows):
            raise RuntimeError("no model")

    return Failing()


def test_one_merge(spark):
    df = blocks(spark, ("alpha beta gamma delta", False, False), ("alpha beta gamma delta", False, False), ("zeta eta", False, False), ("alpha beta gamma delta", True, False), ("alpha beta gamma delta", False, True))
    result = D.distill(df, options=D.Options(threshold=0.95))
    live = {r.id: r for r in result.visible.collect()}
    merged = [r for r in live.values() if r.type == "merged"]
    assert len(merged) == 1 and merged[0].parents == ["b0", "b1"] and merged[0].roots == ["b0", "b1"] and merged[0].tags == ["T0", "T1"] and merged[0].source_document == "d0"
    assert "b2" in live and "b0" not in live and result.start == 3
    stats = result.stats().first()
    assert (stats.start_blocks, stats.blocks_added, stats.service_final_blocks) == (3, 1, 1)
    assert {r.id for r in result.service_view().where("not hidden").collect()} == {merged[0].id}


@pytest.mark.parametrize("n", [0, 1, 2])
def test_small_inputs(spark, n):
    result = D.distill(blocks(spark, *[(f"w{chr(97 + i) * 5}", False, False) for i in range(n)]) if n else blocks(spark, ("x", False, False)).limit(0), options=D.Options(threshold=0.95))
    assert result.visible.count() == n and result.merged == 0


def test_failed_merges_keep_members_and_thresholds_rise(spark):
    df = blocks(spark, ("one two three", False, False), ("one two three", False, False))
    result = D.distill(df, merger=failing(), options=D.Options(threshold=0.55, rounds=4))
    assert result.visible.count() == 2 and [t["threshold"] for t in result.trace] == [0.55, 0.55, 0.56, 0.57]


def test_superseded_merges_are_hidden(spark):
    class Chain:
        def merge(self, rows):
            return [{"name": "m", "critical_question": "q", "trusted_answer": "same words here" + " more" * len(rows), "tags": [], "keywords": []}]

    df = blocks(spark, ("same words here", False, False), ("same words here", False, False), ("same words more", False, False))
    result = D.distill(df, merger=Chain(), options=D.Options(threshold=0.75, rounds=3))
    final = [r for r in result.visible.collect() if r.type == "merged"]
    assert len(final) == 1 and final[0].roots == ["b0", "b1", "b2"]


def test_merging_in_parts_is_the_same(spark):
    members = [{"id": f"b{i:02}", "name": "n", "critical_question": "q", "trusted_answer": "a" * (i % 7), "tags": [str(i)], "keywords": []} for i in range(45)]
    m = CanonicalMerger()
    flat = m.merge(members)
    parts = [{"id": f"{i}", **m.merge(members[lo : lo + 20])[0]} for i, lo in enumerate((0, 20, 40))]
    assert m.merge(parts)[0]["tags"] == flat[0]["tags"] and m.merge(parts)[0]["trusted_answer"] == flat[0]["trusted_answer"]


def test_direct(spark):
    df = blocks(spark, ("a", False, False), ("abc", False, False), ("z", False, False))
    clusters = spark.createDataFrame([("b0", "k"), ("b1", "k"), ("b2", "l")], "id string, cluster string")
    got = {r.trusted_answer: r.source_count for r in D.direct(df, clusters).collect()}
    assert got == {"abc": 2, "z": 1}
    assert D.direct(df, clusters, failing()).count() == 3


def test_bad_options():
    with pytest.raises(ValueError, match="bad options"):
        D.Options(threshold=1.5)


def test_models(spark):
    (v, zero) = HashingEmbedder(8).embed(["b a b", "123"])
    assert math.isclose(sum(x * x for x in v), 1) and not any(zero)
    assert "<name>A &lt; b</name>" in ExtractiveExtractor().extract("A < b. c. ")


def test_collection(spark, tmp_path):
    c = store.Collection(spark, str(tmp_path), "raw")
    assert not c.exists() and store.pick(c) is None
    rows = spark.createDataFrame([("a", 1, "s"), ("a", 2, "s"), ("b", 1, "t")], "id string, n int, source_document string")
    assert sorted((r.id, r.n) for r in c.upsert(rows).collect()) == [("a", 1), ("b", 1)]
    assert sorted((r.id, r.n) for r in c.upsert(rows).collect()) == [("a", 1), ("b", 1)]
    c.upsert(rows.where("id = 'a'").withColumn("n", F.lit(9)))
    assert {r.id: r.n for r in c.read().collect()} == {"a": 9, "b": 1} and store.pick(c) is c
    c.mark_distilled(spark.createDataFrame([("a",), ("gone",)], "id string"), F.lit("2024-01-01"), "t1")
    assert [r.id for r in c.active().collect()] == ["b"] and c.get("a").first().distill_task == "t1"
    assert [r.id for r in c.delete_source("s").collect()] == ["b"]


def test_files(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "a.txt").write_text("one\ntwo")
    (tmp_path / "in" / "deep" / "b.md").write_text("three")
    (tmp_path / "in" / "c.xml").write_text("<ideablock><name>N</name><critical_question>Q</critical_question><trusted_answer>A</trusted_answer></ideablock>")
    assert {(r.source_document, r.text) for r in store.text_files(spark, str(tmp_path / "in")).collect()} == {("a.txt", "one\ntwo"), ("b.md", "three")}
    block = store.xml_blocks(spark, str(tmp_path / "in"))
    assert block.first().name == "N"
    store.write_json(block.select("id", "name"), str(tmp_path / "out"))
    assert store.jsonl_blocks(spark, str(tmp_path / "out"), "id string, name string").first().name == "N"
    assert store.wire(block).first().textResult.criticalQuestion == "Q"


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 20").select("doc_id", "text")
    for part in range(2):
        docs.where(F.col("doc_id") % 2 == part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    batch = I.ingest(docs, store.Collection(spark, str(tmp_path), "batch"))
    target = store.Collection(spark, str(tmp_path), "stream")
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    I.ingest_stream(stream, target, str(tmp_path / "checkpoint")).awaitTermination()
    assert {r.id for r in batch.collect()} == {r.id for r in target.read().collect()}


def test_jobs(spark):
    from millrace.sources.jobs import Jobs

    jobs = Jobs(spark, 2)
    good = jobs.submit(lambda note: note("half", 0.5, {}) or spark.range(3).count())
    bad = jobs.submit(lambda note: 1 / 0)
    assert jobs.wait(good, 60)["result"] == "3" and jobs.wait(bad, 60)["status"] == "failure"
    assert {r.status for r in jobs.table().collect()} == {"success", "failure"}
    assert jobs.delete(bad) and not jobs.delete(bad)
    assert store.job_counts(jobs.table(), 1e10).first().active == 0


def test_settings(tmp_path):
    from millrace.plans.config import settings

    (tmp_path / "s.yaml").write_text("queries: 7\nsections: {projected: false}\n")
    s = settings(str(tmp_path / "s.yaml"), title="T", overlap=None)
    assert (s.queries, s.title, s.overlap) == (7, "T", 200) and "projected" not in s.shown() and "queries" in s.shown()
    with pytest.raises(ValueError, match="unknown"):
        settings(nothing=1)


def test_jobs_outlive_a_session(spark, tmp_path):
    from millrace.sources.jobs import Jobs

    folder = f"{tmp_path}/jobs"
    first = Jobs(spark, 2, folder)
    good = first.submit(lambda note: note("half", 0.5, {}) or "place")
    assert first.wait(good, 60)["status"] == "success"
    slow = first.submit(lambda note: __import__("time").sleep(3))
    assert first.wait(slow, 0.01)["status"] == "timeout" and first.wait(slow, 60)["status"] == "success"
    first.rows["lost"] = {**first.status(good), "job_id": "lost", "status": "running", "completed_at": None}
    first._save("lost")
    again = Jobs(spark, 2, folder)
    assert again.status(good) == first.status(good) and again.status("lost")["status"] == "failure"
    assert again.expire(3600) == 0 and again.expire(-1) == 3
    assert not Jobs(spark, 2, folder).rows


def test_large_clusters_are_merged_in_levels(spark):
    from millrace.operators.clusters import split
    from millrace.plans.models import CanonicalMerger, PlaceholderMerger, RetryingMerger

    class Failing:
        def merge(self, blocks):
            if any(b["name"] == "bad" for b in blocks):
                raise ValueError
            return CanonicalMerger().merge(blocks)

    rows = [(f"b{i:04d}", "bad" if i == 900 else f"n{i}", f"q{i}", "a" * (i * 7919 % 101), [f"t{i % 3}"], [f"k{i}"], f"s{i % 5}", "big" if i < 850 else "mid" if i < 880 else "failing" if i < 940 else "one") for i in range(941)]
    df = spark.createDataFrame(rows, "id string, name string, critical_question string, trusted_answer string, tags array<string>, keywords array<string>, source_document string, cluster string")
    blocks = D.normal(df)
    parts = split(df.select("id", "cluster"), 20)
    members = blocks.join(parts.where("cluster <> 'one'"), "id")
    got = {r.cluster: r for r in D.merge_clusters(members, Failing()).collect()}
    assert got.keys() == {"big", "mid"}
    for name, r in got.items():
        own = [x for x in rows if x[7] == name]
        best = min(own, key=lambda x: (-len(x[3]), x[0]))
        assert r.parents == [x[0] for x in own] == r.roots and r.source_document == "s0"
        assert (len(r.trusted_answer), r.tags, r.keywords) == (len(best[3]), ["t0", "t1", "t2"], sorted({x[5][0] for x in own}))
    empty = {r.cluster: r.name for r in D.merge_clusters(members, PlaceholderMerger()).collect()}
    assert empty == {"big": "", "mid": "", "failing": ""}

    class Flaky:
        calls = 0

        def merge(self, blocks):
            self.calls += 1
            if self.calls < 3:
                raise ValueError
            return ["done"]

    assert RetryingMerger(Flaky(), 3, 0.0).merge([]) == ["done"]
    with pytest.raises(ValueError):
        RetryingMerger(Flaky(), 2, 0.0).merge([])


def test_snapshots_and_phases(spark, tmp_path):
    told = []
    rows = [(f"b{i}", f"name {'abcde'[i % 5] * 3}", "what is it?", "same words here", None) for i in range(10)]
    df = spark.createDataFrame(rows, "id string, name string, critical_question string, trusted_answer string, source_document string")
    result = D.distill(df, options=D.Options(threshold=0.7, rounds=2, on_progress=lambda *a: told.append(a[0]), snapshots=str(tmp_path)))
    assert told[0] == "embedding" and told[-1] == "done" and {"similarity", "clustering", "merging", "round"} <= set(told)
    state = spark.read.parquet(f"{tmp_path}/round-0")
    assert state.count() == 10 + result.trace[0]["merged"] and state.where("not hidden").count() < 10


def test_http_merger():
    import json
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    from millrace.plans.models import HttpClient, HttpMerger

    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            block = "<ideablock><name>N &amp; M</name><critical_question>Q</critical_question><trusted_answer>A</trusted_answer><tags>X, Y</tags></ideablock>"
            data = json.dumps({"choices": [{"message": {"content": f"Here: {block}<ideablock><name>x</name></ideablock>"}}]}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    got = HttpMerger(HttpClient(f"http://127.0.0.1:{server.server_port}"), "m").merge([{"name": "a<b", "critical_question": "q", "trusted_answer": None}])
    server.shutdown()
    assert got == [{"name": "N & M", "critical_question": "Q", "trusted_answer": "A", "tags": ["X", "Y"], "keywords": []}]
    assert asked[0]["model"] == "m" and "<name>a&lt;b</name>" in asked[0]["messages"][0]["content"]


def test_wire_form_both_ways(spark):
    rows = [("ib_1", "N", "Q", "A", "doc"), ("ib_2", "M", "P", "B", None)]
    df = spark.createDataFrame(rows, "id string, name string, critical_question string, trusted_answer string, source_document string")
    back = store.from_wire(store.wire(df, "item", "merged", "itemText"), "item", "itemText")
    assert sorted((r.id, r.name, r.critical_question, r.trusted_answer, r.source_document) for r in back.collect()) == rows
    assert {(r.type, r.hidden, r.exported, r.reviewed, r.parents) for r in back.collect()} == {("merged", False, False, False, None)}
    bare = spark.createDataFrame([("x", ("n", None, "a"))], "blockResultUUID string, textResult struct<name:string,criticalQuestion:string,trustedAnswer:string>")
    assert store.from_wire(bare).first().asDict() == {"id": "x", "name": "n", "critical_question": "", "trusted_answer": "a", "source_document": None, "type": "original", "hidden": False, "exported": False, "reviewed": False, "parents": None}


def test_stream_drops_repeats_within_the_watermark(spark, tmp_path):
    rows = [(1, "First text here. It has words. ", "2024-01-01 00:00:00"), (1, "First text here. It has words. ", "2024-01-01 00:05:00"), (2, "Second text here. ", "2024-01-01 00:06:00")]
    df = spark.createDataFrame(rows, "doc_id long, text string, at string").withColumn("at", F.to_timestamp("at"))
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    blocks = store.Collection(spark, str(tmp_path), "raw")
    I.ingest_stream(stream, blocks, f"{tmp_path}/checkpoint", time_col="at").awaitTermination()
    assert sorted(r.source_document for r in blocks.read().collect()) == ["1", "2"]


def test_later_rounds_compare_what_is_new(spark, monkeypatch):
    from millrace.operators import distill as D
    from millrace.operators import similarity as J

    class Fails:
        def merge(self, blocks):
            if any("stuck" in b["trusted_answer"] for b in blocks):
                raise ValueError
            return [{**min(blocks, key=lambda b: b["id"]), "trusted_answer": " ".join(sorted({w for b in blocks for w in b["trusted_answer"].split()}))}]

    texts = [" ".join(group + w for k, w in enumerate("uvwxyz") if k not in (i % 6, (i * i + i // 6) % 6)) + (" stuck" if group == "ab" else "") for group in ("ab", "cd", "ef", "gh") for i in range(12)]
    rows = [(f"b{i:03d}", "n", "q", t, "s") for i, t in enumerate(texts)]
    blocks = spark.createDataFrame(rows, "id string, name string, critical_question string, trusted_answer string, source_document string")
    options = D.Options(threshold=0.75, rounds=3, step=0.02)
    seen, counted = [], J.similar_links

    def links(live, t, fresh=None):
        seen.append((live.count(), None if fresh is None else fresh.count()))
        return counted(live, t, fresh=fresh)

    def plain(live, t, fresh=None):
        return J.similar_pairs(live, t)

    rows_of = lambda r: sorted((x.id, x.trusted_answer, x.hidden, tuple(x.roots or [])) for x in r.blocks.collect())
    monkeypatch.setattr(D, "similar_links", links)
    got = D.distill(blocks, None, Fails(), options)
    monkeypatch.setattr(D, "similar_links", plain)
    want = D.distill(blocks, None, Fails(), options)
    assert rows_of(got) == rows_of(want) and got.trace == want.trace and got.merged
    assert seen[0][1] is None and len(seen) > 1 and any(new < n for n, new in seen[1:])
