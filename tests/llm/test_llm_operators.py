"""Operators against plain Python versions or SQL."""

import random

import brute
import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import common, decontaminate, exact_dedup, kneser_ney, language_id, licenses, line_dedup, mixing, registry, simhash, suffix_dedup, url_filter
from sparkloom.llm.common import scratch_path
from sparkloom.llm.components import connected_components, toward_least
from sparkloom.llm.deep_shallow import BlindTrie, suffix_order


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_sql(spark, sf, duck, name):
    assert compare.difference(registry.QUERIES[name](spark, sf), duck, registry.ORACLE[name]) == ""


def by_id(df):
    return {r[0]: r for r in df.collect()}


def test_simhash_query(spark, sf, texts):
    prints, group = brute.near_groups(texts, 4, 4)
    got = by_id(simhash.op3_simhash(spark, sf))
    assert {d: (r.fingerprint, r.component_id) for d, r in got.items()} == {d: (f"{prints[d]:016x}", group[d]) for d, _ in texts}


def test_simhash_sketches_and_split_cells(spark, texts, monkeypatch):
    rng = random.Random(1)
    base = [f"word{n}" for n in range(120)]
    docs = [(n, " ".join(rng.choice(["new", w]) if rng.random() < 0.02 else w for w in base)) for n in range(120)] + [(1000 + d, t) for d, t in texts[:60]]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    _, group = brute.near_groups(docs, 5, 6, sketches=3)
    got = by_id(simhash.near_duplicate_groups(df, 5, 6, 3).select("doc_id", "component_id"))
    assert {d: r.component_id for d, r in got.items()} == group
    prints = simhash.fingerprints(df, 4).select(F.lit(0).alias("sketch"), F.col("fp").alias("value"), "fp").distinct()
    whole = connected_components(simhash.fingerprint_links(prints, 7)).orderBy("node").collect()
    assert connected_components(simhash.fingerprint_links(prints, 7, cell_rows=3)).orderBy("node").collect() == whole != []


@pytest.mark.parametrize("distance", range(8))
def test_anchors_meet(distance):
    """Any two fingerprints within the distance share the home anchor of one of them, in some block."""
    rng = random.Random(distance)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), distance):
            y ^= 1 << b
        met = False
        for shift, bits in simhash._blocks(distance):
            table = simhash._patterns(bits)
            cells = []
            for v in (x, y):
                v = v >> shift & (1 << bits) - 1
                syndrome = 0
                for j in range(15):
                    syndrome ^= (j + 1) * (v >> j & 1)
                cells.append([v ^ e for e in table[syndrome]])
            met |= cells[0][0] in cells[1] and cells[1][0] in cells[0]
        assert met


def test_components(spark):
    rng = random.Random(3)
    links = [(n, n + 1) for n in range(0, 60) if n % 20 != 19] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)] + [(5, 5), (7, 6), (6, 7)]
    want = brute.components({x for e in links for x in e}, links)
    got = {r.node: r.label for r in connected_components(spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint")).collect()}
    assert got == {k: v for k, v in want.items() if k in {x for a, b in links if a != b for x in (a, b)}}
    fewer = toward_least(spark.createDataFrame([*links, (None, 3)], "a bigint, b bigint"))
    assert {r.node: r.label for r in connected_components(fewer).collect()} == got


def test_deep_shallow_order():
    rng = random.Random(2)
    heads = [bytes(rng.choice(b"ab") for _ in range(60)) for _ in range(5)]
    strings = [rng.choice(heads)[: rng.randrange(40, 60)].ljust(60, b"a") + bytes(rng.choice(b"abc") for _ in range(16)) for _ in range(400)]
    groups = np.array([rng.randrange(4) for _ in strings])
    rows = np.array([list(s) for s in strings], np.uint8)
    order, common = suffix_order(groups, rows)
    want = sorted(range(len(strings)), key=lambda i: (groups[i], strings[i]))
    assert [(groups[i], strings[i]) for i in order] == [(groups[i], strings[i]) for i in want]
    for n in range(1, len(order)):
        a, b = strings[order[n - 1]], strings[order[n]]
        lcp = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
        assert common[n] == (lcp if groups[order[n - 1]] == groups[order[n]] else -1)
    distinct = sorted(set(strings))
    rng.shuffle(distinct)
    assert [distinct[i] for i in BlindTrie(distinct).ordered()] == sorted(distinct)


@pytest.mark.parametrize("part", [3, 200_000])
def test_suffix_dedup(spark, texts, part):
    """Cores with more than ``part`` pieces are ordered in parts; the results are the same."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50" if part == 3 else "10000")  # cores go over the ends of batches
    rng = random.Random(4)
    some = [t for _, t in texts[:40]]
    docs = list(texts[:80])
    for n in range(60):  # pieces of other texts, cut anywhere; periodic text; edits
        a = rng.choice(some)
        cut = rng.randrange(len(a) + 1)
        docs.append((1000 + n, rng.choice(some)[: rng.randrange(300)] + a[cut : cut + rng.randrange(400)] + rng.choice(["", "ab" * 120, "é" * 90]) + rng.choice(some)[-rng.randrange(1, 200) :]))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    got = {r[0]: r for r in suffix_dedup.dedup_substrings(df, part_pieces=part).select("doc_id", "n_bytes", "spans", F.sha2("kept", 256).alias("sha")).collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute.cut_strings(docs)
    assert {d: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), r.sha) for d, r in got.items()} == want
    assert sum(x[1] for x in want.values()) > 5000


def test_suffix_dedup_query(spark, sf, texts):
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.op5_suffix_dedup(spark, sf).collect()}
    assert got == brute.cut_strings(texts)


def test_suffix_dedup_of_common_passage(spark):
    """One passage with other words around it in each text, cut at any place, in parts of a core and whole."""
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(260))
    word = lambda n: "".join(rng.choice("ijklmnop") for _ in range(n))
    docs = [(n, word(rng.randrange(90)) + passage[rng.randrange(3) * 20 : 260 - rng.randrange(100)] + word(rng.randrange(90))) for n in range(150)]
    want, df = brute.cut_strings(docs), spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    for part in (7, 200_000):
        got = suffix_dedup.dedup_substrings(df, part_pieces=part).select("doc_id", "n_bytes", "spans", F.sha2("kept", 256).alias("sha")).collect()
        assert {r[0]: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), r.sha) for r in got} == want


def test_suffix_dedup_of_long_text(spark, monkeypatch):
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefgh ") for _ in range(17_000_000))
    docs = [(1, long), (2, "x" * 40 + long[16_700_000:16_790_000] + "y" * 40)]
    got = {r[0]: r.spans for r in suffix_dedup.dedup_substrings(spark.createDataFrame(docs, "doc_id bigint, text string")).select("doc_id", "spans").collect()}
    assert got[1] == [] and [(s.start, s.end) for s in got[2]] == [(40, 90_040)]


def test_line_dedup(spark, texts):
    rng = random.Random(7)
    pool = [f"line {n} with some words" for n in range(12)] + ["short", "", "  ", "one line that alone has more than ten words in it, as it is"]
    docs = [(n, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 14)))) for n in range(80)] + [(500 + d, t) for d, t in texts[:80]]
    got = {r[0]: r[1] for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id bigint, text string")).select("doc_id", "text").collect()}
    assert got == brute.cut_lines(docs)


@pytest.mark.parametrize("rows", [0, 100_000])
def test_decontamination(spark, monkeypatch, rows):
    """With and without sides that are small enough to broadcast."""
    monkeypatch.setattr(common, "BROADCAST_ROWS", rows)
    rng = random.Random(8)
    w = [f"t{n}" for n in range(30)]
    items = [(n, " ".join(rng.choice(w) for _ in range(rng.choice([1, 3, 9, 10, 11, 25])))) for n in range(25)] + [(90, None), (91, "..."), (92, "T1, t2! t3")]
    docs = []
    for n in range(60):
        parts = [" ".join(rng.choice(w) for _ in range(rng.randrange(15))), rng.choice(items)[1] or "", " ".join(rng.choice(w) for _ in range(rng.randrange(15)))]
        docs.append((n, rng.choice([" ", ", ", "\n"]).join(parts).replace("t1", rng.choice(["t1", "T1"]))))
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination(d, b).select("doc_id", "n_words", "n_hit", F.size("items"), F.sha2(F.concat_ws(",", "items"), 256)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == brute.contamination(docs, items)


def test_licenses(spark, sf, texts):
    names = ["Licensed under the Apache License, Version 2.0.", "under the MIT license or CC BY-NC-SA 4.0", "GNU Lesser General Public License v3", "SPDX-License-Identifier: MPL-2.0", "the terms of the Eclipse Public License 2.0", "mit Licht und Luft", "under the mit license under the MIT License", "All rights reserved."]
    docs = [*texts, *[(10_000 + n, t) for n, t in enumerate(names)], (20_000, "x " * 50 + ". ".join(names))]
    got = licenses.scan(spark.createDataFrame(docs, "doc_id bigint, text string")).select("doc_id", "license_scan").collect()
    for r in got:
        n, places, base, every, _ = brute.licenses(dict(docs)[r.doc_id], licenses.RULES, licenses.BASE)
        s = r.license_scan
        assert (s.n_words, sorted(x.start for x in s.base), {x.label for x in s.base}, {x.label for x in s.base} | {x.label for x in s.found}) == (n, places, base, every), r.doc_id
    assert len(licenses.RULES) > 200
    labels = {r.doc_id: {x.label for x in r.license_scan.found} for r in got}
    assert [labels[10_000 + n] for n in range(6)] == [{"apache-2"}, {"mit", "cc-by-nc", "cc-by-nc-sa"}, {"lgpl-3"}, {"mpl-2"}, {"epl-2"}, set()]


def test_license_query(spark, sf, texts):
    got = {r.doc_id: tuple(r)[1:] for r in licenses.op4_license_scan(spark, sf).collect()}
    assert len(got) == len(texts)
    for d, text in texts:
        n, places, base, every, score = brute.licenses(text, licenses.RULES, licenses.BASE)
        assert got[d] == (n, len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(every)), score)


def test_license_suppression(spark):
    """Random word salads of the rules' own words, with very many detections in one text, against the plain version."""
    rng = random.Random(12)
    parts = ["licensed under", "under the mit license", "not", "gpl 2 0", "or later", "apache license version 2", "with classpath exception", "cc by nc", "sa 4 0", "dual", "mit license", "all rights reserved", "no license", "is granted", "x"]
    docs = [(n, " ".join(rng.choice(parts) for _ in range(rng.choice([3, 30, 300])))) for n in range(60)] + [(100, "licensed under cc by-nc-sa 4.0. " * 3000)]
    got = licenses.scan(spark.createDataFrame(docs, "doc_id bigint, text string")).select("doc_id", "license_scan").collect()
    for r in got:
        n, places, base, every, _ = brute.licenses(dict(docs)[r.doc_id] if r.doc_id < 100 else docs[-1][1][:3000], licenses.RULES, licenses.BASE)
        s = r.license_scan
        assert {x.label for x in s.base} | {x.label for x in s.found} == every
        assert r.doc_id == 100 or (s.n_words, sorted(x.start for x in s.base)) == (n, places)
    assert len(got[-1].license_scan.base) == 3000


def test_exact_dedup_continues(spark, texts):
    path = scratch_path(spark, "index")
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    first = exact_dedup.DigestIndex(spark, path, buckets=4).dedup(df.where("doc_id < 100")).collect()
    index = exact_dedup.DigestIndex(spark, path, buckets=4)
    again = index.dedup(df.where("doc_id >= 50").withColumn("doc_id", F.col("doc_id") + 1000)).collect()
    kept = {r.digest: r.keep_id for r in first}
    for r in again:
        assert r.kept == (r.keep_id == r.doc_id) and r.keep_id == kept.get(r.digest, r.keep_id) and not (r.kept and r.digest in kept)
    assert index.table().groupBy("digest").count().where("count > 1").isEmpty()
    plan = df.select(F.sha2("text", 256).alias("digest")).join(index.table().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1  # the index's side is not shuffled


def test_indexes_with_equal_names(spark):
    """Two folders with the same last part are two indexes; a closed one goes on from its files."""
    docs = spark.createDataFrame([(5, "a"), (6, "b")], "doc_id bigint, text string")
    paths = [f"{scratch_path(spark, x)}/index" for x in ("one", "two")]
    first = exact_dedup.DigestIndex(spark, paths[0], buckets=2)
    assert first.dedup(docs).where("kept").count() == 2
    second = exact_dedup.DigestIndex(spark, paths[1], buckets=2)
    assert second.table().count() == 0 and second.dedup(docs.withColumn("doc_id", F.col("doc_id") + 10)).where("kept").count() == 2
    first.close()
    again = exact_dedup.DigestIndex(spark, paths[0], buckets=2).dedup(docs.withColumn("doc_id", F.lit(1).cast("bigint"))).collect()
    assert sorted(r.keep_id for r in again) == [5, 6] and not any(r.kept for r in again)


def test_kneser_ney(spark, sf, texts):
    train = [(d, t) for d, t in texts if __import__("zlib").crc32(str(d).encode()) % 7 != 2]
    want, _, _ = brute.kneser_ney(train, texts)
    got = by_id(kneser_ney.op1_lm_score(spark, sf))
    assert len(got) == len(want)
    for d, (n, known, total, base, score) in want.items():
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (n, known, total, __import__("zlib").crc32(str(d).encode()) % 7 == 2)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_kneser_ney_hot_context(spark, monkeypatch):
    """A word before very many others, in 128 shards: its followers are spread, its sums are whole."""
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", 300)
    train = [(i, " ".join(f"the w{i * j % 997}" for j in range(200))) for i in range(20)]
    docs = spark.createDataFrame(train, "doc_id long, text string")
    model = kneser_ney.train(docs, scratch_path(spark, "lm"))
    assert model.bits == 7
    got = {r.doc_id: r.score for r in kneser_ney.score(docs, model).collect()}
    want, _, _ = brute.kneser_ney(train, train)
    assert got == pytest.approx({d: w[4] for d, w in want.items()}, rel=1e-9)


def test_folded_counts(monkeypatch):
    monkeypatch.setattr(kneser_ney, "FOLD_ROWS", 4)
    rng = np.random.default_rng(1)
    parts = [(rng.integers(0, 9, 5).astype(np.uint64), rng.integers(1, 4, 5).astype(np.uint64)) for _ in range(50)]
    keys, n = kneser_ney._folded(iter(parts), kneser_ney._summed)
    all_keys, all_n = (np.concatenate(x) for x in zip(*parts, strict=True))
    assert keys.tolist() == sorted(set(all_keys.tolist()))
    assert n.tolist() == [int(all_n[all_keys == k].sum()) for k in keys]


def test_kneser_ney_adds_up(spark):
    train = [(1, "a b c a b d"), (2, "a c"), (3, "b b a"), (4, "")]
    _, p, words = brute.kneser_ney(train, [])
    for v in [*words, "<s>", "never"]:
        assert sum(p(v, w) for w in [*words, "unknown word"]) == pytest.approx(1)
    df = spark.createDataFrame(train, "doc_id bigint, text string")
    got = kneser_ney.score(df, kneser_ney.train(df, scratch_path(spark, "lm"))).collect()
    want, _, _ = brute.kneser_ney(train, train)
    assert [r.score for r in got] == pytest.approx([want[r.doc_id][4] for r in got])


def test_language_id_held_out(spark, documents):
    learn, ask = documents.where("doc_id % 2 = 0"), documents.where("doc_id % 2 = 1")
    out = language_id.identify(ask.withColumn("told", F.col("lang")).withColumn("lang", F.lit(None).cast("string")), F.lit("unknown.org"), labels=learn)
    right = out.agg(F.avg((F.col("language") == F.col("told")).cast("double"))).first()[0]
    assert right > 0.97


def test_language_id_evidence(spark):
    labels = spark.createDataFrame([("en", "the house and the garden " * 20, "x.com")] * 30 + [("de", "das haus und der garten " * 20, "y.de")] * 30, "lang string, text string, source string")
    ask = spark.createDataFrame([(1, "the garden", None, None), (2, "qqq", "de", None), (3, "qqq", None, "y.de"), (4, "qqq", None, "new.y.de"), (5, "12 !", "en", "x.com"), (6, None, None, None), (7, "das haus und der garten", "en", "x.com")], "doc_id int, text string, lang string, source string")
    got = {r.doc_id: r for r in language_id.identify(ask, F.col("source"), ("de", "en"), labels=labels).collect()}
    assert [got[n].language for n in range(1, 8)] == ["en", "de", "de", "de", "und", "und", "de"]
    priors = {r.host: r.prior for r in language_id.host_priors(labels, ("de", "en"), F.col("source"), "lang", 10.0).collect()}
    assert priors["y.de"] == pytest.approx([(30 + 10 * (30 + 10 * 0.5) / 40) / 40, (10 * (10 * 0.5) / 40) / 40])


def test_mixing_meets_targets(spark, documents):
    out = mixing.calibrated(documents, ["source", "lang"], [0.7, 0.5], sweeps=20)
    for margin, power in (("source", 0.7), ("lang", 0.5)):
        rows = out.groupBy(margin).agg(F.sum("n_tokens").alias("n"), F.sum(F.col("n_tokens") * F.col("weight")).alias("w")).collect()
        raised = {r[margin]: r.n**power for r in rows}
        for r in rows:
            assert r.w / sum(x.w for x in rows) == pytest.approx(raised[r[margin]] / sum(raised.values()), rel=1e-3)
    expected, got = out.agg(F.sum("probability"), F.sum(F.col("sampled").cast("int"))).first()
    assert abs(expected - got) < 4 * expected**0.5


def test_url_filter(spark):
    entries = [("spam", "d:bad.com", "add", "2024-01-10"), ("spam", "d:bad.com", "remove", "2024-02-01"), ("spam", "d:bad.com", "add", "2024-03-01"), ("spam", "d:bad.com", "remove", "2024-03-01"), ("allow", "p:bad.com/good", "add", "2024-01-01"), ("adult", "p:x.org/a/b", "add", "2024-01-01"), (None, "d:x.org", "add", "2024-01-01"), ("spam", "d:x.org", "add", None)]
    captures = [(1, "http://bad.com/x", "2024-01-09"), (2, "http://WWW.Bad.com:80/x", "2024-01-10"), (3, "http://bad.com/good/x?y", "2024-01-10"), (4, "http://bad.com", "2024-02-01"), (5, "http://bad.com", "2024-03-05"), (6, "http://x.org/a/b/c", "2024-05-05"), (7, "http://x.org/a/bc", "2024-05-05"), (8, "no url", "2024-05-05"), (9, None, None), (2, "http://WWW.Bad.com:80/x", "2024-01-10"), (10, "http://u@notbad.com/", "2024-01-15")]
    e = spark.createDataFrame(entries, "list string, key string, action string, at string").withColumn("at", F.col("at").cast("date"))
    c = spark.createDataFrame(captures, "page_id int, url string, fetched_at string").withColumn("fetched_at", F.col("fetched_at").cast("date"))
    got = sorted((r.page_id, ",".join(r.lists), r.blocked) for r in url_filter.evaluate(c, e).collect())
    assert got == [(1, "", False), (2, "spam", True), (2, "spam", True), (3, "allow,spam", False), (4, "", False), (5, "", False), (6, "adult", True), (7, "", False), (8, "", False), (9, "", False), (10, "", False)]
