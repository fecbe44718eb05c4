"""SimHash, paragraphs and embeddings against brute force, and their odd input."""

import collections
import re
import time

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import hnsw, paragraphs, registry, simhash
from millrace.plans.buckets import Forest

LONG = " ".join(f"w{i}" for i in range(30_000))
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three four"), (5, "one two three four"), (None, "one two three four"), (7, LONG), (8, LONG + " end"), (9, "ONE  two\nthree four")]


def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("fp", "id", "node", "component", "bucket", "unit", "n")})


def union(n, links):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))).split() if w]
    parts = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    counts = [sum(xxhash.xxh64_intdigest(p, 42) >> b & 1 for p in parts) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(parts))


def test_op3_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    parts = union(len(rows), links)
    want = {(r.doc_id, f"{f:016x}", rows[p].doc_id) for r, f, p in zip(rows, fps, parts, strict=True)}
    assert {tuple(r) for r in registry.QUERIES["op3_simhash_near_dedup"](spark, sf_dir).collect()} == want


def test_no_close_fingerprint_is_lost(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = list({int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(0, 6), replace=False)) for b in base for _ in range(12)})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    at = {x: i for i, x in enumerate(signed)}
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    assert [simhash.segments_for(n, 4) for n in (0, 1 << 20, 1 << 24, 1 << 31, 1 << 36, 1 << 50)] == [5, 5, 6, 6, 7, 8]
    for tile, cut in ((2048, 5), (5, 5), (2048, 6), (2048, 7), (64, 8)):
        edges = [(at[r.a], at[r.b]) for r in simhash.linked(df, 4, tile=tile, cut=cut).collect()]
        assert all((fps[a] ^ fps[b]).bit_count() <= 4 for a, b in edges)
        assert union(len(fps), edges) == union(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4])


def test_op3_odd_input(spark):
    got = collections.Counter((r.doc_id, r.component_id) for r in simhash.near_duplicates(odd(spark)).collect())
    assert got[1, 1] == got[2, 1] == got[3, 1] == 1 and got[5, 5] == 2 and got[None, 5] == 1 and got[9, 5] == 1
    assert sum(got.values()) == len(ODD)
    assert simhash.near_duplicates(odd(spark).limit(0)).count() == 0


def shingle_set(text, size=5):
    return set(simhash.shingles(simhash.words(text), size))


def test_texts_keep_one_of_each_component(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    sets = [shingle_set(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = {rows[p].doc_id for p in union(len(rows), links)}
    out = simhash.without_near_duplicates(docs)
    got = {r.doc_id for r in out.collect()}
    assert want <= got and len(got - want) <= 0.01 * len(rows) and out.columns == docs.columns


def test_near_copies_of_a_text_collapse(spark):
    rng = np.random.default_rng(2)
    base = [f"v{x}" for x in rng.integers(0, 500, 300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        w = list(base)
        for k in rng.integers(0, 300, 2):
            w[k] = f"new{i}"
        rows.append((i, " ".join(w)))
    rows.append((99, " ".join(f"u{x}" for x in range(300))))
    got = simhash.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in got.collect()} == {0, 99}


def test_a_line_repeated_in_one_of_two_near_copies(spark):
    rng = np.random.default_rng(6)
    pick = lambda n: [f"v{x}" for x in rng.integers(0, 3000, n)]
    rows = []
    for i in range(20):
        text, line = " ".join(pick(300)), " ".join(pick(12))
        rows += [(2 * i, text), (2 * i + 1, text + f"\n{line}" * 20)]
        a, b = shingle_set(rows[-2][1]), shingle_set(rows[-1][1])
        assert len(a & b) >= 0.9 * len(a | b)
    got = simhash.without_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id for r in got.collect()} == {2 * i for i in range(20)}


def test_texts_odd_input(spark):
    got = sorted((str(r.doc_id) for r in simhash.without_near_duplicates(odd(spark)).collect()))
    assert got == ["1", "4", "7", "None"]  # a null id sorts first
    assert simhash.without_near_duplicates(odd(spark).limit(0)).count() == 0


def brute_paragraphs(rows, least=5, passage=45):
    found = []
    for r in rows:
        lines = [x.lower().split() for x in r.text.split("\n")]
        long = [n for n, w in enumerate(lines) if len(w) >= least]
        found += [(r.doc_id, n, k, sum(map(len, lines[:n])), lines[n]) for k, n in enumerate(long)]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for *_, w in found]
    index = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            index[g].append(i)
    links = []
    for i, s in enumerate(sets):
        for j, n in collections.Counter(j for g in s for j in index[g] if j < i).items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n) - 1e-9:
                links.append((i, j))
    parts = union(len(found), links)
    size = collections.Counter(parts)
    out, run = set(), []
    words = lambda run: found[run[-1]][3] + len(found[run[-1]][4]) - found[run[0]][3]
    for i, (doc, _, k, *_) in enumerate([*found, (None, None, -9)]):
        if run and (i == len(found) or found[run[-1]][0] != doc or found[run[-1]][2] != k - 1 or size[parts[i]] < 2):
            if words(run) >= passage:
                out |= {found[x][:2] for x in run}
            run = []
        if i < len(found) and size[parts[i]] > 1:
            run.append(i)
    return out


def test_op6_against_brute_force(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    got = registry.QUERIES["op6_paragraph_dedup"](spark, sf_dir).collect()
    lines = [r for r in got if r.kind == "line"]
    assert {(r.doc_id, r.line) for r in lines} == brute_paragraphs(rows) and lines
    firsts = collections.Counter(r.component for r in lines if r.kept)
    assert max(firsts.values()) == 1


def grams(text, n=50):
    w = (text or "").lower().split()
    return {tuple(w[p : p + n]) for p in range(len(w) - n + 1)}


def test_op6_finds_every_repeated_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    times = collections.Counter(g for t in text.values() for g in grams(t))
    shared = {d for d, t in text.items() if any(times[g] > 1 for g in grams(t))}
    got = [r for r in registry.QUERIES["op6_paragraph_dedup"](spark, sf_dir).collect() if r.kind == "run"]
    assert shared and shared <= {r.doc_id for r in got}
    least = collections.Counter(g for t in text.values() for g in grams(t, 45))
    for r in got:
        piece = text[r.doc_id][r.start : r.start + r.length]
        assert len(piece.split()) == r.n_words
        assert r.kept or r.n_words >= 45
    left = {r.doc_id: r.text for r in paragraphs.without_copies(docs).collect()}
    times = collections.Counter(g for t in left.values() for g in grams(t))
    assert left.keys() == text.keys() and max(times.values()) == 1
    lines = {d for d, _ in brute_paragraphs(docs.collect())}
    alone = [d for d, t in text.items() if d not in lines and len(grams(t, 45)) == len((t or "").split()) - 44 and all(least[g] == 1 for g in grams(t, 45))]
    assert alone and all(left[d] == text[d] for d in alone)


def test_op6_odd_input(spark):
    line = " ".join(f"p{i}" for i in range(60))
    rows = [(1, None, "a"), (2, "", "a"), (3, f"x\n{line}\ny", "a"), (4, line.upper(), "a"), (None, f"{line}\nshort", "a"), (6, f"{line}\n{line}", "a"), (7, "a b c d e f\ncommon line of seven words here now", "a"), (8, "common line of seven words here now", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, line string").withColumn("component", F.lit(1)).withColumn("bands", F.lit("z"))
    got = {(r.doc_id, r.line, r.kept) for r in paragraphs.copied(df).collect()}
    assert got == {(None, 0, True), (3, 1, False), (4, 0, False), (6, 0, False), (6, 1, False)}
    left = paragraphs.without_copies(df)
    assert left.columns == df.columns and {(r.doc_id, r.text) for r in left.collect()} == {(1, None), (2, ""), (3, "x\ny"), (4, ""), (None, f"{line}\nshort"), (6, ""), *((a, b) for a, b, _ in rows[6:])}
    assert paragraphs.copied(df.limit(0)).count() == 0


def test_passages_that_no_whole_line_shows(spark):
    rng = np.random.default_rng(8)
    pick = lambda n: [f"q{x}" for x in rng.integers(0, 5000, n)]
    join = " ".join
    inside, short, across = pick(60), pick(60), pick(60)
    lines = lambda w: "\n".join(join(w[i : i + 4]) for i in range(0, 60, 4))
    rows = []
    for i in range(3):
        rows.append((i, join(pick(10) + inside + pick(10))))
        rows.append((10 + i, f"{join(pick(30))}\n{lines(short)}\n{join(pick(30))}"))
        rows.append((20 + i, f"{join(pick(20) + across[:25])}\n{join(across[25:] + pick(20))}"))
    rows += [(30, "same " * 100), (31, join(inside[:44])), (None, join(pick(50))), (40, None), (41, "")]
    df = spark.createDataFrame(rows + rows[:1], "doc_id long, text string")
    found = {}
    seen = collections.defaultdict(set)
    for d, t in rows:
        w = (t or "").split()
        for p in range(len(w) - 44):
            seen[tuple(w[p : p + 45])].add((d, p))
    for d, t in rows:
        w = (t or "").split()
        if d != 30:
            found[d] = {x for p in range(len(w) - 44) if len(seen[tuple(w[p : p + 45])]) > 1 for x in range(p, p + 45)}
    got = collections.defaultdict(set)
    for r in paragraphs.runs(df).collect():
        text = dict(rows)[r.doc_id]
        assert text[r.start : r.start + r.length].split() == text.split()[r.first_word : r.first_word + r.n_words]
        assert r.kept == (r.doc_id in (0, 10, 20)) or r.doc_id == 30
        if r.doc_id == 30 and not r.kept:  # one paragraph of its first words stays
            assert (r.first_word, r.n_words) == (paragraphs.UNIT, 100 - paragraphs.UNIT)
        got[r.doc_id] |= set(range(r.first_word, r.first_word + r.n_words))
    assert max(got.pop(30)) == 99 and got == {d: x for d, x in found.items() if x} and len(got) == 9
    left = {r.doc_id: r.text for r in paragraphs.without_copies(df).collect()}
    for first, step in ((0, inside), (10, short), (20, across)):
        assert left[first] == dict(rows)[first]
        for d in (first + 1, first + 2):
            assert left[d].split() == [w for k, w in enumerate(dict(rows)[d].split()) if k not in found[d]] and len(left[d].split()) == len(dict(rows)[d].split()) - 60
    assert left[31] == join(inside[:44]) and left[40] is None and left[41] == "" and paragraphs.runs(df.limit(0)).count() == 0


def most_shuffled(spark, run):
    """(the result of ``run``, the most bytes that one of its stages shuffled)."""
    context, jvm = spark.sparkContext, spark.sparkContext._jvm

    def stages():
        context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        none, no = jvm.java.util.ArrayList(), context._gateway.new_array(jvm.double, 0)
        found = context._jsc.sc().statusStore().stageList(none, False, False, no, none)
        return {found.apply(i).stageId(): found.apply(i).shuffleWriteBytes() for i in range(found.size())}

    before = set(stages())
    out = run()
    return out, max(n for k, n in stages().items() if k not in before)


def test_texts_without_repeats_are_not_shuffled(spark):
    rng = np.random.default_rng(12)
    passage = " ".join(f"p{x}" for x in rng.integers(0, 1 << 60, 60))
    rows = [(i, f"{passage}\n" * (i < 3) + "\n".join(f"only{x}" for x in rng.integers(0, 1 << 60, 3000))) for i in range(100)] + [(None, None), (101, None), (None, f"{passage} end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").localCheckpoint()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where what repeats is too much to broadcast
    try:
        got, most = most_shuffled(spark, lambda: paragraphs.without_copies(docs).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(map(repr, got)) == sorted(repr(type(got[0])(doc_id=d, text=t and t.replace(f"{passage}\n", "") if d is not None else t)) for d, t in rows)
    assert most < sum(len(t or "") for _, t in rows) / 10  # random digits take half their size


def test_no_stage_of_without_copies_has_two_python_workers_a_core(spark):
    words = [f"p{x}" for x in range(60)]
    docs = spark.createDataFrame([(i, " ".join([f"a{i}", *words, f"b{i}"])) for i in range(5)], "doc_id long, text string").localCheckpoint()
    store = spark._jsparkSession.sharedState().statusStore()
    listed = lambda: [found.apply(i) for found in [store.executionsList()] for i in range(found.size())]
    before = max((e.executionId() for e in listed()), default=-1)
    assert len(paragraphs.without_copies(docs).where("length(text) < 20").collect()) == 4
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    plans = [e.physicalPlanDescription().split("== Initial Plan ==")[0] for e in listed() if e.executionId() > before]
    twice = [p for p in plans if len(re.findall(r"(?:MapInArrow|ArrowEvalPython) \(\d+\)", p)) > 1]
    assert len(twice) >= 2 and not any("BroadcastHashJoin" in p for p in twice)


def test_anchors_are_those_of_every_window():
    rng = np.random.default_rng(2)
    for top in (2, 9, 1 << 40):
        h = rng.integers(0, top, 400).astype(np.uint64) << np.uint64(10)  # the lowest bits do not count
        at = paragraphs.anchors(h, 23)
        assert np.diff(at).max() <= 23 and at[0] < 23 and at[-1] >= 400 - 23
        for p in range(400 - 22):
            assert any(p <= x < p + 23 and h[x] == h[p : p + 23].min() for x in at.tolist())
    assert len(paragraphs.anchors(np.zeros(22, np.uint64), 23)) == 0 and paragraphs.anchors(np.zeros(100, np.uint64), 23).tolist() == [22, 45, 68, 91]


def test_key_plan():
    with pytest.raises(ValueError):
        simhash.key_plan(1 << 40, 0.1, 0.99)
    bits, keys, radius = simhash.key_plan(200, 0.8, 0.995)
    assert bits == 10 and 30 < keys < 60 and 25 < radius < 40
    assert simhash.shared_key_chance(bits, keys, 0.151, radius) >= 0.99
    assert simhash.key_plan(1 << 24, 0.8, 0.995)[0] == 12


def cpu(f):
    began = time.process_time()
    return f(), time.process_time() - began


def test_similar_members_of_a_crowded_unit():
    """All lines of one template meet in one bucket; most pairs are not similar enough."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 62, 27, dtype=np.uint64)

    def lines(n):
        out = np.tile(base, (n, 1))
        out[:, :6] = rng.integers(0, 1 << 62, (n, 6), dtype=np.uint64)
        for i in range(0, n - 1, 4):
            out[i + 1, : int(rng.integers(3, 7))] = out[i, 0]  # shorter sets that lie inside another
            out[i + 1, 5] = out[i, 5]
        return [np.unique(x) for x in out]

    def parts(sets, side, link):
        forest = Forest(len(sets))
        link(sets, side, 0.8, forest)
        return [forest.find(i) for i in range(len(sets))]

    for n, tiled in ((1, False), (2, False), (90, False), (90, True), (300, False)):
        sets, side = lines(n) + [np.empty(0, np.uint64)], np.full(n + 1, -1, np.int8)
        if tiled:
            side = (np.arange(n + 1) % 2).astype(np.int8)
        own = [set(x.tolist()) for x in sets]
        links = [(i, j) for i in range(n + 1) for j in range(i) if (side[i] < 0 or side[i] != side[j]) and len(own[i] & own[j]) >= 0.8 * len(own[i] | own[j])]
        want = union(n + 1, links)
        assert parts(sets, side, paragraphs._link_many) == parts(sets, side, paragraphs._link_few) == want
    unit = pa.record_batch({"unit": np.zeros(2048, np.int64), "bucket": np.zeros(2048, np.int64), "side": np.full(2048, -1, np.int8), "id": np.arange(2048), "shingles": pa.array([x.tobytes() for x in lines(2048)], pa.binary())})
    held = {}

    class Rows:
        select = sortWithinPartitions = lambda self, *_: self
        mapInArrow = lambda self, f, _: held.setdefault("work", f)

    paragraphs.jaccard_edges(Rows(), 0.8)
    _, took = cpu(lambda: list(held["work"](iter([unit]))))
    assert took < 3


def test_close_texts_of_a_crowded_bucket():
    """Millions of texts make buckets of thousands of unrelated fingerprints."""
    bits, keys, radius = simhash.key_plan(2_800_000, 0.8, 0.995)
    masks, refs = np.array(simhash.key_masks(bits, keys), dtype=np.uint64), np.array(simhash.pivots(4), dtype=np.uint64)
    rng = np.random.default_rng(9)
    for n, key in ((1, 0), (50, 3), (400, 0), (400, 5), (8192, 5)):
        one, two = (rng.integers(0, 1 << 64, n, dtype=np.uint64) for _ in range(2))
        for i in range(0, n - 1, 7):
            one[i + 1], two[i + 1] = one[i], two[i] ^ rng.integers(0, 1 << int(rng.integers(1, 64)), dtype=np.uint64)
        side = np.where(np.arange(n) % 3 == 0, 0, 1).astype(np.int8) if n == 50 else np.full(n, -1, np.int8)
        unit = pa.table({"fp": one.view(np.int64), "fp2": two.view(np.int64), "side": side})
        got, took = cpu(lambda: simhash.close_members(unit, key, masks, radius, refs))  # noqa: B023
        if n <= 400:
            early = lambda x, y: any(not (x & int(a) or y & int(b)) for a, b in masks[:key])  # noqa: B023, E731
            pairs = [(i, j) for i in range(n) for j in range(i) if side[i] < 0 or side[i] != side[j]]
            xors = {(i, j): (int(one[i] ^ one[j]), int(two[i] ^ two[j])) for i, j in pairs}
            want = {m for p, (x, y) in xors.items() if x.bit_count() + y.bit_count() <= radius and not early(x, y) for m in p}
            assert set(got.tolist()) == want and (n < 50 or want or key)
        else:
            assert took < 1.5


def test_tuned_bands():
    assert paragraphs.tuned_bands(0.8, 0.99, 3) == 7
    assert 1 - (1 - 0.8**3) ** 7 >= 0.99


def vectors(spark, rows):
    return spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>").withColumn("key", F.lit(1)).withColumn("node", F.lit("x"))


def test_op4_recall_and_components(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(900, 32))
    near = base[:60].repeat(6, axis=0) + rng.normal(size=(360, 32)) * 0.06
    group = base[800] + rng.normal(size=(150, 32)) * 0.02
    v = np.concatenate([base, near, group, base[:40]]).astype(np.float32)
    df = vectors(spark, list(enumerate(v.tolist())))
    got = {r.vec_id: r for r in hnsw.near_duplicates(df, least_shards=3).collect()}
    u = v.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    sim = u @ u.T
    np.fill_diagonal(sim, 0)
    links = (sim >= 0.95).sum(1)
    found = np.array([got[i].n_links for i in range(len(v))])
    assert found.sum() >= 0.98 * links.sum() and (found <= links).all()
    parts = union(len(v), list(zip(*np.nonzero(np.triu(sim >= 0.95)), strict=True)))
    assert np.mean([got[i].component_id == parts[i] for i in range(len(v))]) >= 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_op4_odd_input(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 0.0]), (5, [float("nan"), 1.0, 0.0]), (6, [float("inf"), 1.0, 0.0]), (10, one), (9, [2.0, 0.0, 0.0]), (11, one), (11, one), (None, one), (12, [1.0, 0.0]), (13, [0.0, 1.0, 0.0])]
    got = sorted(((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicates(vectors(spark, rows), least_shards=2).collect()), key=str)
    want = [(str(i), 0, i, True) for i in (1, 2, 3, 4, 5, 6, 12, 13)] + [("9", 4, 9, True), ("10", 4, 9, False), ("11", 4, 9, False), ("11", 4, 9, False), ("None", 4, 9, False)]
    assert got == sorted(want, key=str)
    assert hnsw.near_duplicates(vectors(spark, rows).limit(0)).count() == 0


def test_op4_lengths_beyond_the_range_of_doubles(spark):
    rows = [(20, [1e200, -1e200, 1e199]), (21, [-3e-200, 3e-200, -3e-201]), (22, [5e-200, -5e-200, 5e-201]), (23, [5e-324, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in hnsw.near_duplicates(df, least_shards=2).collect())
    assert got == [(20, 1, 20, True), (21, 0, 21, True), (22, 1, 20, False), (23, 0, 23, True)]


def test_op4_against_brute_force(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    v = np.array([r.embedding for r in rows], dtype=np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    sim = v @ v.T
    np.fill_diagonal(sim, 0)
    parts = union(len(v), list(zip(*np.nonzero(np.triu(sim >= 0.95)), strict=True)))
    got = {r.vec_id: r for r in registry.QUERIES["op4_hnsw_near_dedup"](spark, sf).collect()}
    found = np.array([got[r.vec_id].n_links for r in rows])
    links = (sim >= 0.95).sum(1)
    assert (found <= links).all() and found.sum() >= 0.98 * links.sum()
    assert np.mean([got[r.vec_id].component_id == rows[p].vec_id for r, p in zip(rows, parts, strict=True)]) >= 0.98
    assert {r.recall for r in got.values()} == {got[rows[0].vec_id].recall} and got[rows[0].vec_id].recall >= 0.98


def test_op4_graphs_travel_in_pieces(spark, monkeypatch):
    """No row holds a whole graph, and a unit that reads its block in several batches loses no link."""
    rng = np.random.default_rng(12)
    base = rng.normal(size=(1500, 64))
    v = np.concatenate([base, base[:300] + rng.normal(size=(300, 64)) * 0.02])
    kept = {}
    monkeypatch.setattr(hnsw, "keep", lambda df, name, f=hnsw.keep: kept.setdefault(name, f(df, name)))
    usual = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = {r.vec_id: r for r in hnsw.near_duplicates(vectors(spark, list(enumerate(v.astype(np.float32).tolist()))), least_shards=2, block_rows=700).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", usual)
    binary = [c for c, kind in kept["graphs"].dtypes if kind == "binary"]
    assert kept["graphs"].select(F.max(F.greatest(F.lit(0), F.lit(0), *[F.octet_length(c) for c in binary]))).first()[0] <= 1 << 18
    assert all(got[i].component_id == i % 1500 for i in range(300)) and sum(r.n_links for r in got.values()) == 600
    assert all(got[1500 + i].component_id == i and not got[1500 + i].kept for i in range(300))
    assert all(hnsw._step(n, d) * max(n + 1, 128 * d) <= hnsw.CELLS for n in (1000, 51_000, 100_000) for d in (64, 1024))


@pytest.mark.parametrize("n", [1, 2, 70, 700])
def test_graph_survives_a_dump(n):
    v = hnsw.unit_rows(np.random.default_rng(n).normal(size=(n, 8)))
    g = hnsw.Graph.build(v)
    assert g.audit(0.95, 0.98) >= 0.98
    again = hnsw.Graph.load(g.dump())
    assert all((a == b).all() for a, b in zip(g.search(v, 0.95), again.search(v, 0.95), strict=True)) and all(i in set(x.tolist()) for i, x in enumerate(again.search(v, 0.95)))
