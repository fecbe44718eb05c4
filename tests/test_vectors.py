import difflib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import vectors as V
from millrace.operators import clusters as C
from millrace.operators import similarity as J
from millrace.operators.components import components
from millrace.plans.buckets import units


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [float(x) if x is not None else None for x in v]) for i, v in rows], "id long, embedding array<double>")


def brute(rows, t):
    out = set()
    good = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.linalg.norm(np.array(v, float)) > 0]
    for x, (i, a) in enumerate(good):
        for j, b in good[x + 1 :]:
            if len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= t:
                out.add((min(i, j), max(i, j)))
    return out


def near(n=100, seed=42):
    v = np.random.default_rng(seed).normal(size=(n, 16))
    v[1], v[3] = v[0] + 0.01, v[2] + 0.01
    return list(enumerate(v.tolist()))


def test_pairs(spark):
    rows = [*near(), (200, None), (201, [0.0] * 16), (202, [None, *[1.0] * 15])]
    df = frame(spark, rows)
    for block in (2048, 16):
        got = {(r.id_a, r.id_b) for r in J.similar_pairs(df, 0.5, block_rows=block).collect()}
        assert got == brute(rows, 0.5) and (0, 1) in got
    assert J.similar_pairs(frame(spark, []), 0.5).count() == 0
    assert J.similar_pairs(frame(spark, [(0, [1, 0, 0]), (1, [0.99, 0.1, 0]), (2, [0, 0, 1])]), 0.9).count() == 1


def test_lsh_is_part_of_exact_and_finds_near_ones(spark):
    rows = near()
    exact = brute(rows, 0.95)
    got = [(r.id_a, r.id_b) for r in J.similar_pairs_lsh(frame(spark, rows), 0.95).collect()]
    assert set(got) <= exact and {(0, 1), (2, 3)} <= set(got) and len(got) == len(set(got))
    assert {(r.id_a, r.id_b) for r in J.similar_pairs_lsh(frame(spark, rows[:10]), 0.2, least=50).collect()} == brute(rows[:10], 0.2)


@pytest.mark.parametrize("threshold", [0.35, 0.6])
def test_lsh_reaches_the_wanted_recall(spark, threshold):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(300, 24))
    other = base + rng.normal(size=base.shape) * rng.uniform(0.2, 2.5, (300, 1))
    rows = list(enumerate(np.concatenate([base, other]).tolist()))
    exact = brute(rows, threshold)
    got = {(r.id_a, r.id_b) for r in J.similar_pairs_lsh(frame(spark, rows), threshold).collect()}
    assert got <= exact and len(got) >= 0.9 * len(exact) > 100
    tables, bits = J.lsh_plan(100_000, 0.35, 0.95)
    assert bits == 8 and 1 - (1 - (1 - np.arccos(0.35) / np.pi) ** 8) ** tables >= 0.95


def test_knn(spark):
    rows = near(40)
    got = {(r.id_a, r.id_b) for r in J.similar_pairs_knn(frame(spark, rows), 0.0, 2).collect()}
    v = np.array([r for _, r in rows])
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -9)
    want = {(min(i, int(j)), max(i, int(j))) for i in range(40) for j in np.argsort(-s[i])[:2] if s[i, j] >= 0}
    assert got == want


def test_nearest_match(spark):
    corpus = frame(spark, [(10, [1, 0]), (11, [1, 0]), (12, [0, 1])])
    got = {r.query: (r.match, round(r.distance, 6)) for r in J.nearest_match(frame(spark, [(0, [2, 0]), (1, [0, 3]), (2, None), (3, [0, 0])]), corpus).collect()}
    assert got == {0: (10, 0.0), 1: (12, 0.0), 2: (None, float("inf")), 3: (None, float("inf"))}


def test_search_and_filters(spark):
    df = frame(spark, [(2, [1, 0]), (1, [1, 0]), (3, [0, 1]), (4, None)]).withColumn("tags", F.array(F.lit("X"))).withColumn("primary_entity_type", F.lit("P")).withColumn("distilled", F.col("id") == 2)
    assert [r.id for r in J.vector_search(df, [1.0, 0.0], 10).collect()][:2] == [1, 2]
    assert [r.id for r in J.vector_search(df, [1.0, 0.0], 1, J.conditions("p", "x", True)).collect()] == [1]
    assert J.conditions() is None and J.vector_search(df, [1.0, 0.0], 5, F.lit(False)).count() == 0


def test_scalars(spark):
    row = spark.range(1).select(*[f(V.literal(a), V.literal(b)).alias(f"c{i}") for i, (f, a, b) in enumerate([(V.cosine, [1.0, 0.0], [1.0, 0.0]), (V.cosine, [1.0], [-1.0]), (V.cosine, [0.0], [1.0]), (V.cosine, [1.0], [1.0, 2.0]), (V.dot_similarity, [1.0], [1.0, 2.0])])], V.similarity_of(F.lit(1.5)).alias("s"), V.accuracy(F.lit(1.5)).alias("a")).first()
    assert list(row) == [1, -1, 0, 0, 0, pytest.approx(0.4), 0]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=40))
def test_components(spark, edges):
    up = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame([*edges, (None, 1)], "a int, b int")).collect()}
    assert got == {x: find(x) for x in up}


def test_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1001 + i) for i in range(300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain + hub, "a int, b int")).collect()}
    assert len(got) == 201 + 301 and {got[x] for x in range(201)} == {0} and got[1300] == 1000


def test_units_bring_each_pair_together_once(spark):
    rows = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 99)], "bucket long, id long")
    meets = {}
    for r in units(rows, 8).groupBy("unit").agg(F.collect_list(F.struct("id", "side")).alias("m")).collect():
        for i, x in enumerate(r.m):
            for y in r.m[i + 1 :]:
                if x.side != y.side or x.side < 0:
                    key = tuple(sorted((x.id, y.id)))
                    meets[key] = meets.get(key, 0) + 1
    assert len(meets) == 50 * 49 // 2 and set(meets.values()) == {1}


def naive_leaders(texts, t):
    used, out = set(), [None] * len(texts)
    for i, a in enumerate(texts):
        if i in used:
            continue
        out[i] = i
        used.add(i)
        for j in range(i + 1, len(texts)):
            if j not in used and C.sequence_ratio(a, texts[j]) >= t:
                out[j] = i
                used.add(j)
    return out


@given(st.lists(st.text("abc ", max_size=12), max_size=12), st.sampled_from([0.3, 0.7, 1.0]))
def test_leaders(texts, t):
    assert C.lead(texts, t) == naive_leaders(texts, t)


def test_two_passes(spark):
    df = spark.createDataFrame([(1, "a", "hello world"), (2, "a", "hello worlds"), (3, "b", "hello world!"), (4, None, "other"), (5, "b", None)], "id int, source_document string, trusted_answer string")
    assert {r.id: r.cluster for r in C.two_pass_clusters(df, 0.7).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5}
    assert {r.id: r.cluster for r in C.two_pass_clusters(df, 0.7, global_pass=False).collect()}[3] == 3


@pytest.mark.parametrize("n", [1, 20, 21, 40, 41, 100, 209, 400])
def test_split(spark, n):
    df = spark.range(n).withColumn("cluster", F.lit(0))
    parts = {}
    for r in C.split(df).collect():
        parts.setdefault(r.part, []).append(r.id)
    assert sum(map(len, parts.values())) == n and max(map(len, parts.values())) <= 20
    assert sorted(parts) == list(range(len(parts))) and [x for _, p in sorted(parts.items()) for x in sorted(p)] == list(range(n))


def test_louvain_separates_two_dense_groups(spark):
    edges = [(a, b, 1.0) for g in (range(5), range(5, 10)) for a in g for b in g if a < b] + [(4, 5, 0.1)]
    got = {r.id: r.cluster for r in C.louvain(spark.range(12), spark.createDataFrame(edges, "id_a long, id_b long, sim double")).collect()}
    assert {got[x] for x in range(5)} == {0} and {got[x] for x in range(5, 10)} == {5} and got[11] == 11


def test_close_texts_are_those_of_the_plain_ratio():
    import random

    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["the", "an", "er", "on", "qu", "z", "ti", "re", ", ", ". "]) for _ in range(3))
    texts = [" ".join(word() for _ in range(rng.choice((3, 20, 40, 90)))) for _ in range(40)]
    for i in range(0, 30, 3):
        w = texts[i].split(" ")
        for k in range(rng.randrange(1, 12)):
            w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts += ["", "a", "b"]
    texts = list(dict.fromkeys(texts))
    for t in (0.3, 0.7, 0.9):
        want = [(i, j) for j in range(len(texts)) for i in range(j) if C.sequence_ratio(texts[i], texts[j]) >= t]
        assert sorted(C.close_texts(texts, [-1] * len(texts), t)) == sorted(want) and want
        assert all(C.ratio_reaches(a, b, t) == (difflib.SequenceMatcher(None, a, b).ratio() >= t) for a in texts[:9] + texts[-3:] for b in texts[:9] + texts[-3:])
        half = [k % 2 for k in range(len(texts))]
        assert sorted(C.close_texts(texts, half, t)) == sorted(p for p in want if half[p[0]] != half[p[1]])


def test_leader_clusters_are_those_of_the_plain_scan(spark, monkeypatch):
    import random

    rng = random.Random(5)
    monkeypatch.setattr(C, "TILE", 16)  # several tiles in a group
    base = ["".join(rng.choice("abcdefgh ") for _ in range(40)) for _ in range(12)]
    rows = []
    for i in range(120):
        t = list(rng.choice(base))
        for _ in range(rng.randrange(0, 14)):
            t[rng.randrange(40)] = rng.choice("abcdefgh ")
        rows.append((i, rng.choice(["one", "two", None]), "".join(t) if i % 17 else rng.choice([None, "", base[0]])))
    df = spark.createDataFrame(rows, "id long, source_document string, trusted_answer string")
    want = {}
    for s in ("one", "two", None):
        own = [(i, t) for i, g, t in rows if g == s]
        want |= {own[k][0]: own[x][0] for k, x in enumerate(C.lead([t for _, t in own], 0.7))}
    assert {r.id: r.leader for r in C.leader_clusters(df, "source_document", 0.7).collect()} == want
    reps = sorted(set(want.values()))
    over = {reps[k]: reps[x] for k, x in enumerate(C.lead([rows[r][2] for r in reps], 0.7))}
    assert {r.id: r.cluster for r in C.two_pass_clusters(df, 0.7).collect()} == {i: over[x] for i, x in want.items()}
    assert C.two_pass_clusters(df.limit(0)).count() == 0


def test_blocks_and_copies_stop_growing(spark):
    for n in (50_000, 600_000, 1_500_000):
        assert J._blocks(n, 64) == 24  # copies of a row that a join of a table with itself makes
    assert J._blocks(6_000_000, 64) * 64 * 8 * 65_536 >= 6_000_000 * 64 * 8 > J._blocks(5_000_000, 64)
    many = spark.range(5000).select("id", F.array(F.lit(1.0), F.col("id").cast("double")).alias("embedding"))
    assert J._tiles(J._rows(many, "id", "embedding"), None, 100).count() == 24 * 5000


@pytest.mark.parametrize("threshold", [-0.2, 0.35, 0.999])
def test_candidates_in_single_precision_lose_nothing(spark, threshold):
    v = np.random.default_rng(1).normal(size=(120, 8)).astype(np.float32)
    v[60:] = v[:60] + np.float32(1e-4)
    rows = [*enumerate(v.tolist()), (500, None), (501, [0.0] * 8), (502, [float("inf")] * 8), (503, [float("nan")] * 8)]
    want = brute([r for r in rows if r[0] < 500], threshold)
    for kind in ("float", "double"):
        df = spark.createDataFrame(rows, f"id long, embedding array<{kind}>")
        assert {(r.id_a, r.id_b) for r in J.similar_pairs(df, threshold, block_rows=40).collect()} == want


def test_sign_hashes_in_tiles_find_what_buckets_find(spark):
    rows = near(150)
    got = {(r.id_a, r.id_b) for r in J.similar_pairs_lsh(frame(spark, rows), 0.3, tables=3, bits=3).collect()}
    v = np.array([r for _, r in rows])
    h = J.sign_hashes(v, J.planes(3, 3, 16))
    assert got == {(a, b) for a, b in brute(rows, 0.3) if (h[a] == h[b]).any()} and len(got) < len(brute(rows, 0.3))


def test_nearest_with_many_ties_and_batches(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 50)
    rng = np.random.default_rng(3)
    v = np.concatenate([np.tile([1.0, 2.0, 0.0], (300, 1)), rng.integers(-2, 3, (200, 3))]) * 1.0
    rows = list(enumerate(v.tolist()))
    got = {}
    for r in J.nearest(frame(spark, rows), frame(spark, rows), 3, itself=False).collect():
        got.setdefault(r.query, []).append((r["rank"], r.match))
    n = np.linalg.norm(v, axis=1)
    u = v / np.where(n > 0, n, 1)[:, None]
    for i in range(len(v)):
        d = np.round(1 - u @ u[i], 12)
        order = [j for j in sorted(range(len(v)), key=lambda j: (d[j], j)) if j != i and n[j] > 0][:3]
        assert [m for _, m in sorted(got.get(i, []))] == (order if n[i] > 0 else [])


def test_many_ties_are_sorted_out_in_double_precision():
    v = np.tile(np.eye(4)[0], (5000, 1))
    best = J._Nearest(v[:3], np.arange(3), 2, False)
    best.add(v[3000:], np.arange(3000, 5000))
    best.add(v[:3000], np.arange(3000))
    assert sorted(zip(best.row.tolist(), best.match.tolist(), strict=True)) == [(0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1)]



def test_links_have_the_components_of_all_pairs(spark):
    rows = [*near(300), (1000, None)]
    df = frame(spark, rows)
    pairs = J.similar_pairs(df, 0.6, block_rows=40)
    links = J.similar_links(df, 0.6, block_rows=40)
    parts = lambda e: {(r.node, r.component) for r in components(e.select("id_a", "id_b")).collect()}
    assert parts(links) == parts(pairs) and parts(pairs)
    copies = spark.range(3000).select("id", F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    assert J.similar_links(copies, 0.9, block_rows=300).count() <= 10 * 3000  # of 4,498,500 pairs
    some = df.where("id < 20")
    touching = {(r.id_a, r.id_b) for r in pairs.collect() if r.id_a < 20 or r.id_b < 20}
    assert parts(J.similar_links(df, 0.6, fresh=some, block_rows=40)) == parts(spark.createDataFrame(sorted(touching), "id_a long, id_b long"))


def test_hops_over_vectors_are_those_over_pairs(spark):
    from millrace.operators.search import hops

    rows = [(i, [np.cos(i / 10), np.sin(i / 10)]) for i in range(3, 40)] + [(0, [-1.0, -0.1]), (1, None), (90, [0.0, 0.0])]
    df = frame(spark, rows)
    for t in (0.98, 0.3):
        pairs = J.similar_pairs(df, t)
        want = {(r.id, r.hops) for r in hops(pairs.select("id_a", "id_b").toDF("a", "b"), pairs.agg(F.min("id_a").alias("id"))).collect()}
        assert {(r.id, r.hops) for r in J.similar_hops(df, t).collect()} == want and len(want) > 5
    assert [tuple(r) for r in J.similar_hops(df.where("id < 4"), 0.99).collect()] == [(None, 0)]


def test_a_common_beginning_without_rare_characters_counts():
    a, b = "ab" * 150, "ab" * 150 + "cd" * 50
    t = difflib.SequenceMatcher(None, a, b).ratio()
    assert list(C.close_texts([a, b], [-1, -1], t)) == [(0, 1)] and 0.85 < t < 0.86


def test_bounds_of_texts_in_rare_characters(monkeypatch):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("aeinrst"), 3)) for _ in range(40)] + ["quiz", "Xylo", "jump", "fog."]
    base = [" ".join(rng.choice(words, 90)) for _ in range(6)]
    texts = [" ".join(w if rng.random() > share else rng.choice(words) for w in t.split()) for t in base for share in (0, 0.1, 0.2, 0.3, 0.4)]
    asked, plain = [], C.ratio_reaches
    monkeypatch.setattr(C, "ratio_reaches", lambda a, b, t: asked.append(1) or plain(a, b, t))
    want = [(i, j) for i in range(30) for j in range(i + 1, 30) if difflib.SequenceMatcher(None, texts[i], texts[j]).ratio() >= 0.7]
    assert sorted(C.close_texts(texts, [-1] * 30, 0.7)) == want and want
    assert len(asked) < 30 * 29 // 4


def test_louvain_in_the_spread_form(spark, monkeypatch):
    rng = np.random.default_rng(2)
    edges = [(a, b, 1.0) for g in range(6) for a in range(10 * g, 10 * g + 10) for b in range(a + 1, 10 * g + 10) if rng.random() < 0.8]
    edges += [(int(a), int(b), 0.3) for a, b in {tuple(sorted(rng.integers(0, 60, 2))) for _ in range(30)} if a // 10 != b // 10]
    pairs = spark.createDataFrame(edges + [(100, 101, 1.0)], "id_a long, id_b long, sim double")
    found = lambda: {r.id: r.cluster for r in C.louvain(spark.range(110), pairs).collect()}
    plain = found()
    monkeypatch.setattr(C, "LARGE", 40)
    monkeypatch.setattr(C, "AT_ONCE", 50)
    assert found() == plain == {i: i // 10 * 10 if i < 60 else 100 if i in (100, 101) else i for i in range(110)}
