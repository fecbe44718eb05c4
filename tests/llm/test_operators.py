"""Licences, toxicity, packing, languages, URLs, archives and decontamination, and their odd input."""

import collections
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import decontaminate, language_id, license_scan, packing, registry, toxicity, url_filter, warc

CLASH = ("id", "row", "item", "seed", "key", "rejected", "length", "piece", "lang_pred", "block", "verdict", "canonical", "payload", "_text")


def clashing(df):
    return df.withColumns({c: F.lit(1) for c in CLASH if c not in df.columns})


ODD_TEXT = [(1, None), (2, ""), (3, " \n\t "), (4, "123 !!"), (5, "word"), (5, "word"), (None, "some words here"), (7, "long text " * 30_000)]


def odd(spark):
    return clashing(spark.createDataFrame(ODD_TEXT, "doc_id long, text string"))


# Licences


@pytest.fixture(scope="module")
def license_model():
    return license_scan.train([f"plain sentence number {i} of the work under review" for i in range(200)], copies=12, steps=120)


def test_license_families(spark, license_model):
    texts = ["Licensed under the Apache License, Version 2.0.", "All rights reserved.", "Some words.\nReleased under the MIT License.", "This work is licensed under the GNU General Public License, version 2.", "Licensed under CC BY-NC 3.0.", "The licence of the driver was lost under the work.", "He reserved all the tables in the right version of the hall."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: (r.family, r.paragraph) for r in license_scan.scan(df, license_model).where("confirmed").collect()}
    assert got == {0: ("apache", 0), 1: ("proprietary", 0), 2: ("mit", 1), 3: ("gpl", 0), 4: ("cc-by-nc", 0)}


def test_license_probabilities_are_calibrated(license_model):
    xs, ys = license_scan.examples([f"plain sentence number {i} of the work under review" for i in range(200, 400)], 12, 99)
    p = np.array([license_model.probabilities(license_scan.grams(x, license_model.known, license_model.single)) for x in xs])
    assert np.allclose(p.sum(1), 1) and 0.5 <= license_model.temperature <= 4
    right = np.array([license_model.families[i] for i in p.argmax(1)]) == np.array(ys)
    assert right.mean() > 0.95 and abs(p.max(1).mean() - right.mean()) < 0.1


def test_license_odd_input(spark, license_model):
    assert license_scan.scan(odd(spark), license_model).count() == 0
    assert license_scan.learn(odd(spark).limit(0)).families[-1] == "unknown"
    assert license_scan.common("a b c d".split(), "x a c y d".split()) == 3


def plain_common(a, b):
    rows = [[0] * (len(b) + 1)]
    for x in a:
        rows.append([0])
        for j, y in enumerate(b):
            rows[-1].append(rows[-2][j] + 1 if x == y else max(rows[-2][j + 1], rows[-1][j]))
    return rows[-1][-1]


def plain_notices(model, text):
    """All lines, and all runs of lines, by the definition."""
    lines = [license_scan.words(x) for x in text.split("\n")]
    own = {(f, i): t for f, i, t in model.templates}
    most = 2 * max(map(len, own.values()))

    def judge(k, end):
        parts = [w for x in lines[k:end] for w in x]
        gram = {" ".join(parts[i : i + n]) for n in (1, 2, 3) for i in range(len(parts) - n + 1)}
        seen = [model.known[g] for g in gram if g in model.known]
        if not seen:
            return None
        z = (model.bias + sum(model.weights[i].astype(float) for i in seen)) / model.temperature
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        family = model.families[int(p.argmax())]
        if family == "unknown" or p.max() < 0.5:
            return None
        share, number = max(((plain_common(t, parts) / len(t), -i) for (f, i), t in own.items() if f == family), default=(0, 0))
        return k, end, family, -number, round(share, 9), len(parts)

    single = {k: r for k in range(len(lines)) if (r := judge(k, k + 1))}
    wide = []
    for k in range(len(lines)):
        starts = any(a == x and b == y for t in own.values() for x, y in zip(t, t[1:]) for a, b in zip(lines[k], lines[k][1:]))
        for end in range(k + 2, len(lines) + 1):
            if not starts or not all(lines[k:end]) or sum(map(len, lines[k:end])) > most:
                break
            r = judge(k, end)
            if r and r[4] >= 0.8 and r[5] <= 2 * len(own[r[2], r[3]]) and all(single[x][4] < r[4] for x in range(k, end) if x in single):
                wide.append(r)
    out = []
    for r in sorted(wide, key=lambda r: (-r[4], r[1] - r[0], r[0])):
        if all(r[1] <= o[0] or o[1] <= r[0] for o in out):
            out.append(r)
    return sorted(out + [r for k, r in single.items() if not any(o[0] <= k < o[1] for o in out)])


def test_op1_against_brute_force(spark, sf_dir, license_model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = collections.defaultdict(list)
    for r in license_scan.scan(docs, license_model).collect():
        got[r.doc_id].append((r.paragraph, r.paragraph + r.lines, r.family, r.template, round(r.share, 9)))
    for r in docs.collect():
        assert sorted(got[r.doc_id]) == [x[:5] for x in plain_notices(license_model, r.text)]
    assert got


def test_wrapped_notices(spark, license_model):
    mit = "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated documentation files, to deal\nin the Software without restriction."
    gpl = "// This program is free software: you can redistribute it and/or\n// modify it under the terms of the GNU General Public License as\n// published by the Free Software Foundation."
    texts = [mit, f"some text\n\n{mit}\n\nmore text", f"a line before\n{gpl}\na line after", mit.replace("\n", "\n\n"), f"{gpl}\n\n{mit}"]
    rows = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), license_model).where("confirmed").collect()
    assert {(r.doc_id, r.family, r.paragraph, r.lines) for r in rows} == {(0, "mit", 0, 3), (1, "mit", 2, 3), (2, "gpl", 1, 3), (4, "gpl", 0, 3), (4, "mit", 4, 3)}
    for r in rows:
        assert texts[r.doc_id][r.start : r.start + r.length] == (mit if r.family == "mit" else gpl)


def test_op1_finds_every_notice(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    marks = ("Licensed under", "All rights reserved", "Released under", "is licensed under")
    want = {(r.doc_id, i) for r in rows for i, line in enumerate(r.text.split("\n")) if any(m in line for m in marks)}
    got = {(r.doc_id, r.paragraph) for r in registry.QUERIES["op1_license_scan"](spark, sf_dir).where("confirmed").collect()}
    assert got == want and want


# Toxicity


def test_op2_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    train = labels.where("doc_id % 2 = 0")
    got = {r.doc_id: r.rejected for r in toxicity.detect(docs, train).collect()}
    held = [(r.toxic, got[r.doc_id]) for r in labels.where("doc_id % 2 = 1").collect()]
    assert sum(t == int(p) for t, p in held) / len(held) > 0.97 and len(got) == docs.count()


def test_chain_feeds_earlier_probabilities():
    rng = np.random.default_rng(0)
    a = rng.random(400) < 0.3
    rows = toxicity.Rows.of([np.array([1 if x else 2, 3 + i % 5]) for i, x in enumerate(a)])
    chain = toxicity.train(rows, {"first": a.astype(float), "second": a.astype(float)}, 4)
    assert chain.links[1].chain.shape == (1,) and chain.links[1].chain[0] > 0
    assert ((chain.scores(rows)[:, 1] >= chain.threshold) == a).all()


def test_toxicity_odd_input(spark):
    labels = spark.createDataFrame([(5, 1, 1), (5, 0, 1), (1, 1, 0), (None, 1, 1), (7, None, 1), (99, 1, 1), (2, 0, None), (7, 0, 0)], "doc_id long, toxic int, quality int")
    rows = toxicity.detect(odd(spark), labels).collect()
    assert len(rows) == len(ODD_TEXT) and not any(r.rejected for r in rows if r.doc_id in (1, 2, 3, 4))
    assert not any(r.rejected for r in toxicity.detect(odd(spark), labels.limit(0)).collect())
    assert toxicity.detect(odd(spark).limit(0), labels).count() == 0
    chain = toxicity.learn(odd(spark), labels.drop("quality"))
    assert chain.names == list(toxicity.CATEGORIES)
    same = toxicity.accepted(odd(spark), toxicity.Chain(18))
    assert same.columns == odd(spark).columns and sorted(map(str, same.collect())) == sorted(map(str, odd(spark).collect()))


def plain_chain(rows, targets, folds=3):
    """The chain by lists of rows: earlier probabilities are those of models that have not seen the row."""
    n = len(rows)
    before = np.zeros((n, 0))
    for y in targets:
        out = np.zeros(n)
        for i in range(n):
            seen = [j for j in range(n) if j % folds != i % folds]
            link = toxicity.fit("x", toxicity.Rows.of([rows[j] for j in seen]), before[seen], y[seen], 64)
            out[i] = link.score(toxicity.Rows.of([rows[i]]), before[i : i + 1])[0]
        before = np.column_stack([before, out])
    links = [toxicity.fit("x", toxicity.Rows.of(rows), before[:, :k], y, 64) for k, y in enumerate(targets)]
    return before, links


def test_chain_equals_the_plain_one():
    rng = np.random.default_rng(4)
    rows = [np.sort(rng.choice(64, rng.integers(3, 12), replace=False)).astype(np.int64) for _ in range(60)]
    a = np.array([float(5 in r or 9 in r) for r in rows])
    b = np.array([float(5 in r and 20 not in r) for r in rows])
    chain = toxicity.train(toxicity.Rows.of(rows), {"a": a, "b": b}, 6)
    before, links = plain_chain(rows, [a, b])
    for own, plain in zip(chain.links, links, strict=True):
        assert own.weights == pytest.approx(plain.weights) and own.chain == pytest.approx(plain.chain) and own.bias == pytest.approx(plain.bias)
    assert chain.threshold == toxicity.best_threshold(before[:, -1], b.astype(bool))


def test_kinds_part_the_toxic_rows():
    rows = toxicity.Rows.of([np.array(x) for x in [[1, 2, 9], [1, 2, 8], [1, 2], [4, 5, 9], [4, 5], [4, 5, 8]] * 5 + [[8, 9], [9], [8]] * 20])
    y = np.array([1.0] * 30 + [0.0] * 60)
    got = toxicity.kinds(rows, y, 16)
    assert got[:30].sum(axis=1).tolist() == [1] * 30 and got[30:].sum() == 0
    assert [row.tolist() for row in got[:6]] == [got[0].tolist()] * 3 + [got[3].tolist()] * 3 and got[0].tolist() != got[3].tolist()


# Packing


def test_op5_is_a_round_trip(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    want = {r.doc_id: [*tokenizer.encode(r.text, add_special_tokens=False).ids, 2] for r in docs.collect()}
    rows = registry.QUERIES["op5_best_fit_packing"](spark, sf_dir).collect()
    for r in rows:
        own = want[r.doc_id][r.start : r.start + r.length]
        assert len(own) == r.length and zlib.crc32(np.array(own, "<u4").tobytes()) == r.ids_crc32
    by_doc, by_bin = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.piece, r.start, r.length))
        by_bin[r.sequence_id].append((r.offset, r.length))
    for d, ps in by_doc.items():
        ps.sort()
        assert [p for p, *_ in ps] == list(range(len(ps))) and sum(n for *_, n in ps) == len(want[d])
        assert all(n == 1024 for *_, n in ps[1:]) and [s for _, s, _ in ps] == [0, *np.cumsum([n for *_, n in ps])[:-1]]
    for b in by_bin.values():
        b.sort()
        assert [o for o, _ in b] == [0, *np.cumsum([n for _, n in b])[:-1]] and sum(n for _, n in b) <= 1024
    assert len(by_bin) <= 1.03 * sum(map(len, want.values())) / 1024 + 1


@pytest.mark.parametrize("text", ["", " ", "  a  b ", " a", "a \n b", "x\n\n y  z", "<|endoftext|> hi", "\x1c \x1d a", "日本 語", "don't  it's", "é ́a", "\t\t a", "a\u00a0 b", "x" * 5000, "the the the"])
def test_encoder_equals_the_tokenizer(text):
    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    encode = packing.Encoder(registry.tokenizer_path(), remembered=2)
    for _ in range(2):
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_take_the_plain_path():
    path = registry.tokenizer_path("word_bpe_49k.json")
    assert np.frombuffer(packing.Encoder(path)("Hello world"), "<u4").tolist() == Tokenizer.from_file(path).encode("Hello world", add_special_tokens=False).ids


def test_best_fit():
    p = packing.BestFit(10, open_bins=2)
    assert p.place(6) == (0, 0) and p.place(7) == (1, 0)
    assert p.place(3) == (1, 7)  # the fullest that fits
    assert p.place(5) == (2, 0) and p.place(9) == (3, 0)  # closes bin 0, the fuller of two
    assert p.place(4) == (2, 5) and p.place(10) == (4, 0) and p.open == 2
    rng = np.random.default_rng(1)
    q, room = packing.BestFit(100, 8), collections.Counter()
    for n in rng.integers(1, 101, 3000).tolist():
        b, o = q.place(n)
        assert o == room[b] and o + n <= 100
        room[b] += n
        assert q.open <= 8
    assert packing.cuts(1, 4) == [(0, 1)] and packing.cuts(9, 4) == [(0, 1), (1, 4), (5, 4)] and packing.cuts(8, 4) == [(0, 4), (4, 4)]


def test_packing_odd_input(spark):
    rows = packing.pack(odd(spark), registry.tokenizer_path()).collect()
    got = collections.Counter(r.doc_id for r in rows if r.piece == 0)
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 2, None: 1, 7: 1} and [r.length for r in rows if r.doc_id in (1, 2)] == [1, 1]
    assert packing.pack(odd(spark).limit(0), registry.tokenizer_path()).count() == 0


# Languages


def plain_rate(model, text, k):
    """Phrases by looking matches up in the sample itself."""
    sample, n = model[k], 0
    i = 0
    while i < len(text):
        m = 0
        while i + m < len(text) and text[i : i + m + 1] in sample:
            m += 1
        n += 1
        i += m + 1
    return n * np.log2(max(2, len(sample))) / len(text)


def test_parsing_equals_the_plain_one():
    samples = {"a": "the cat sat on the mat and the rat", "b": "der hund und die katze und das haus", "c": ""}
    model = language_id.build(samples)
    texts = ["the hat", "und das", "zzz the", "x" * 3000 + " the cat " * 500, "t"]
    got = model.rates(texts)
    assert model.languages == ["a", "b"]
    assert got == pytest.approx(np.array([[plain_rate(samples, t, k) for k in "ab"] for t in texts]))


@pytest.mark.parametrize(("block", "at_once"), [(7, 50), (64, 1000), (2048, 1 << 22)])
def test_parsing_does_not_depend_on_blocks(monkeypatch, block, at_once):
    monkeypatch.setattr(language_id, "BLOCK", block)
    monkeypatch.setattr(language_id, "AT_ONCE", at_once)
    rng = np.random.default_rng(1)
    pick = lambda n, top: "".join(chr(0x4E00 + x) for x in rng.integers(0, top, n))
    samples = {"a": pick(900, 400), "b": "ab" * 40 + pick(300, 5)}
    texts = ["ab" * 200, samples["a"][100:700], pick(500, 6), pick(300, 800), samples["b"] + samples["a"], "x"]
    got = language_id.build(samples).rates(texts)
    assert got == pytest.approx(np.array([[plain_rate(samples, t, k) for k in "ab"] for t in texts]))


def test_languages_of_many_letters():
    samples = {"x": "".join(chr(0x4E00 + i) for i in range(400)), "y": "".join(chr(0x5E00 + i) for i in range(400))}
    rates = language_id.build(samples).rates([samples["x"], samples["y"]])
    assert rates[0, 0] < rates[0, 1] / 100 and rates[1, 1] < rates[1, 0] / 100
    assert language_id.normalised("²½ ①") == "" and language_id.normalised("Ä²b 3ç_d") == "ä b ç d"


def test_op7_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = registry.QUERIES["op7_cross_parsing_language_id"](spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in rows) and len(rows) == len(langs)
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.98


def test_language_odd_input(spark):
    model = language_id.build({"x": "some words here and long text", "y": "autre chose"})
    got = {(r.doc_id, r.lang_pred, r.score > 0) for r in language_id.predict(odd(spark), model).collect()}
    assert got == {(i, "und", False) for i in (1, 2, 3, 4)} | {(5, "x", True), (None, "x", True), (7, "x", True)} or {g[1] for g in got if g[0] in (1, 2, 3, 4)} == {"und"}
    labelled = odd(spark).withColumn("lang", F.when(F.col("doc_id") == 5, "w"))
    assert language_id.learn(labelled).languages == ["w"]
    assert {r.lang_pred for r in language_id.predict(odd(spark), language_id.learn(labelled.limit(0))).collect()} == {"und"}
    assert language_id.predict(odd(spark).limit(0), model).count() == 0


# SQL of the queries that have it


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_against_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf_dir}/pages.parquet')")
    found = con.execute(registry.ORACLE_SQL[name])
    names = sorted(d[0] for d in found.description)
    at = [[d[0] for d in found.description].index(c) for c in names]
    df = registry.QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == names
    assert sorted(str([r[c] for c in names]) for r in df.collect()) == sorted(str([r[i] for i in at]) for r in found.fetchall())


# URLs


def test_url_odd_input(spark):
    urls = [None, "", "no scheme", "://", "HTTP://WWW.Listed.COM/a/?utm_source=x&b=1&a=2#f", "http://listed.com/a?a=2&b=1", "https://u:p@listed.com:443/a/?b=1&a=2", "http://listed.com/other", "http://sub.example.org/es/x", "http://example.org/en/12", "http://a.org", "http://a.org/x", "x://h?://y/z", "http://com/fr/"]
    pages = clashing(spark.createDataFrame([(i, u) for i, u in enumerate(urls)] * 2, "page_id long, url string"))
    listed = spark.createDataFrame([("https://listed.com/a?b=1&a=2",), (None,), ("bad",)], "u string")
    got = collections.defaultdict(set)
    for r in url_filter.judge(pages, listed, registry.URL_RULES).collect():
        got[r.page_id].add((r.host, r.path, r.rule, r.verdict))
    assert [len(v) for v in got.values()] == [1] * len(urls)
    flat = {k: next(iter(v)) for k, v in got.items()}
    assert flat[0] == flat[1] == flat[2] == ("", "", None, "allow") and flat[3] == ("", "", None, "allow")
    assert flat[4] == ("www.listed.com", "/a/", None, "block") and flat[5][3] == flat[6][3] == "block" and flat[7][3] == "allow"
    assert flat[8] == ("sub.example.org", "/es/x", "example.org/es/", "block") and flat[9][2:] == ("example.org/en/1", "block")
    assert flat[10] == ("a.org", "", None, "allow") and flat[11][2:] == ("org/", "allow") and flat[12][:2] == ("h", "") and flat[13][2:] == ("com/fr/", "allow")
    assert url_filter.judge(pages, listed.limit(0), []).where("verdict = 'block'").count() == 0
    assert url_filter.judge(pages.limit(0), listed, registry.URL_RULES).count() == 0


def test_filter_passes_all_listed_and_few_others(spark):
    known = spark.range(5000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("canonical"))
    others = spark.range(20_000).select(F.concat(F.lit("o"), F.col("id").cast("string")).alias("canonical"))
    table = url_filter.build_filter(known, "canonical", 209)
    assert url_filter.possible(known, "canonical", table, 209).where("not possible").count() == 0
    assert url_filter.possible(others, "canonical", table, 209).where("possible").count() < 1000


# Archives


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    records = [(1, "http://a/b c", b"x\n\nURL 1 2 3 4\n" * 9), (None, None, b""), (3, "http://z/", bytes(range(256)))]
    found = list(warc.arc_records(warc.arc_file(records, version, "20200102030405")))
    assert [f["URL"] for f, _ in found] == ["http://a/b%20c", "urn:no-url", "http://z/"] and {f["Archive-date"] for f, _ in found} == {"20200102030405"}
    assert [warc._split_http(b)[1:] for _, b in found] == [(p, k) for k, _, p in records]
    assert len(list(warc.arc_records(warc.arc_file(records, version, "20200102030405")[:-20]))) == 2
    with pytest.raises(ValueError, match="version block"):
        list(warc.arc_records(b"filedesc://x 0.0.0.0 2020 text/plain 8\n9 0 x\nA\n"))


def test_warc_parser():
    data = warc.warc_record(1, "http://a", "20200102030405", "text/html", b"HTTP/1.1 200 OK\r\n\r\n", b"WARC/1.1\r\n\r\n", None) + warc.warc_record(2, "http://b", "2020", "text/plain", b"", b"", None) + warc.warc_record(3, "u", "20200102030405", "text/html", b"HTTP/1.1 200 OK\r\n\r\n", b"p", 1)
    for step in (1, 7, 10_000):
        found = list(warc.warc_records(data[i : i + step] for i in range(0, len(data), step)))
        assert [f["warc-type"] for f, _ in found] == ["response", "resource", "revisit"] and found[0][1].endswith(b"WARC/1.1\r\n\r\n")
    assert [f["warc-date"] for f, _ in found[:2]] == ["2020-01-02T03:04:05Z", "2020-01-01T00:00:00Z"] and warc.timestamp("none") == "1970-01-01T00:00:00Z"
    assert found[0][0]["warc-date"] == "2020-01-02T03:04:05Z" and found[2][0]["warc-refers-to"].startswith("<urn:uuid:")
    two = zlib.compress(b"", wbits=31) + zlib.compress(data, wbits=31) + zlib.compress(b"tail", wbits=31)
    assert b"".join(warc.decompressed(two, 13)) == data + b"tail" and b"".join(warc.decompressed(data, 13)) == data
    with pytest.raises(ValueError, match="cut off"):
        list(warc.warc_records(iter([data[:-30]])))


def test_archives_are_bounded_by_bytes():
    assert warc.records_within(100) == 5000 and warc.records_within(1 << 20) == 1016 and warc.records_within(1 << 31) == 1


def test_warc_odd_input(spark):
    big = "<p>" * 50
    rows = [(5, "http://a", big), (3, None, big), (4, "http://b\n x", big), (6, "u", "small"), (7, "u", "small"), (8, "u", None), (9, "u", ""), (None, "u", big), (3, "again", big), (10, "u", "é" * 49), (11, "u", "é" * 50), (12, "u", "é" * 50), (13, "u", "x" * 3_000_000)]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = sorted((str(r.key), r.type, r.payload_bytes, r.refers_to) for r in warc.round_trip(pages).collect())
    assert got == sorted([("5", "revisit", 150, 3), ("3", "response", 150, None), ("4", "revisit", 150, 3), ("6", "response", 5, None), ("7", "response", 5, None), ("8", "response", 0, None), ("9", "response", 0, None), ("None", "response", 150, None), ("3", "response", 150, None), ("10", "response", 98, None), ("11", "response", 100, None), ("12", "revisit", 100, 11), ("13", "response", 3_000_000, None)])
    assert warc.round_trip(pages.limit(0)).count() == 0


# Decontamination


def test_overlap():
    item = np.arange(1, 21, dtype=np.uint64)
    text = np.concatenate([np.zeros(5, np.uint64), item, np.zeros(3, np.uint64)])
    assert decontaminate.overlap(text, item, 5, 0.8) == (0, 20, 20)
    text[[8, 12]] = 99
    assert decontaminate.overlap(text, item, 5, 0.8) == (0, 20, 18)
    text[5:15] = 77
    assert decontaminate.overlap(text, item, 5, 0.8) == (10, 10, 10)
    assert decontaminate.overlap(text, item, 500, 0.8) == (0, 0, 0)
    rng = np.random.default_rng(0)
    for _ in range(200):
        same = rng.random(12) < 0.6
        a = np.where(same, item[:12], 0).astype(np.uint64)
        best = max((j - i for i in range(12) for j in range(i + 1, 13) if same[i] and same[j - 1] and same[i:j].sum() >= 0.8 * (j - i)), default=0)
        first, n, good = decontaminate.overlap(a, item[:12], 0, 0.8)
        assert n <= best or n == best and good >= 0.8 * n
        assert n >= best - 1


def test_op10_finds_exact_and_substituted_passages(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    pick = lambda n: [words[i] for i in rng.integers(0, 3000, n)]
    items = [pick(n) for n in (40, 25, 15, 60)] + [["short", "item", "of", "five", "words"]]
    docs, want = [], set()
    for d in range(60):
        w = pick(300)
        if d % 3 == 0:
            k = d % 5
            part = list(items[k])
            if d % 2 and len(part) > 20:
                for j in rng.choice(len(part), len(part) // 10, replace=False):
                    part[j] = "changed"
            w[100:100] = part
            want.add((d, k))
        docs.append((d, " ".join(w).title() + "."))
    docs += [(100, None), (101, ""), (None, " ".join(items[0])), (102, " ".join(pick(5)))]
    df = clashing(spark.createDataFrame(docs, "doc_id long, text string"))
    tests = clashing(spark.createDataFrame([*((i, ", ".join(w)) for i, w in enumerate(items)), (90, None), (91, "..."), (0, " ".join(items[0]))], "item_id long, text string"))
    got = decontaminate.contaminated(df, tests).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want | {(None, 0)}
    assert all(r.text_at == 100 for r in got if r.doc_id is not None and r.n_words == r.n_equal)
    assert decontaminate.contaminated(df, tests.limit(0)).count() == 0 and decontaminate.contaminated(df.limit(0), tests).count() == 0


def test_op10_finds_every_copied_item(spark):
    sf = "/root/testdata/sf0.01"
    norm = lambda t: " ".join(decontaminate._WORD.findall(t.lower()))
    items = {r.item_id: norm(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = {r.doc_id: f" {norm(r.text)} " for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if f" {x} " in t}
    got = {(r.doc_id, r.item_id) for r in registry.QUERIES["op10_spaced_seed_decontamination"](spark, sf).collect()}
    assert want <= got and want and len(got - want) <= 0.05 * len(want) + 2


def test_op10_long_and_short_items(spark):
    rng = np.random.default_rng(9)
    pick = lambda n: [f"v{x}" for x in rng.integers(0, 50_000, n)]
    long, same = pick(50_000), ["again"] * 300
    short = [pick(n) for n in (7, 11, 12, 15, 16)]
    docs = [(0, long[20_000:20_060]), (1, pick(20) + long + pick(20)), (2, pick(30) + same[:200]), (3, pick(100))]
    want = {(0, 0), (1, 0), (2, 1)}
    for k, part in enumerate(short):
        changed = list(part)
        for j in range(1, 1 + (0, 0, 0, 3, 3)[k]):
            changed[len(part) * j // 4] = "changed"
        docs.append((10 + k, pick(40) + changed + pick(40)))
        want.add((10 + k, 2 + k))
    items = [(i, " ".join(w)) for i, w in enumerate([long, same, *short])]
    df = clashing(spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string"))
    found = decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert [(r.text_at, r.item_at, r.n_equal) for r in found if (r.doc_id, r.item_id) == (0, 0)] == [(0, 20_000, 60)]


def test_op10_recall_of_substituted_items(spark, sf_dir):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    rng = np.random.default_rng(2)
    docs, want = [], set()
    for i, t in items.items():
        w = t.split()
        for k in range(3):
            v = list(w)
            for j in rng.choice(len(v), int(len(v) * 0.15), replace=False):
                v[j] = "other"
            docs.append((len(docs), " ".join(["lead"] * 20 + v + ["tail"] * 20)))
            want.add((len(docs) - 1, i))
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = {(r.doc_id, r.item_id) for r in got.collect()}
    assert len(want & found) >= 0.98 * len(want)
