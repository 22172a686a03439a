"""Nulls, empty and long texts, repeated rows, empty tables and clashing names, in every operator and stage."""

import brute
import corpus_pipeline
import pytest
import test_similar
from pyspark.sql import functions as F

from sparkloom.llm import decontaminate, exact_dedup, kneser_ney, language_id, licenses, line_dedup, mixing, simhash, suffix_dedup, url_filter
from sparkloom.llm.common import scratch_path

SF = "/root/testdata/sf0.001"


def bench(spark):
    return spark.createDataFrame([(1, " ".join(f"shared{n}" for n in range(20))), (2, None), (None, "a"), (3, "")], "item_id bigint, text string")


def score(docs):
    s = docs.sparkSession
    return kneser_ney.score(docs, kneser_ney.train(docs, scratch_path(s, "lm")))


OPERATORS = {
    "exact": lambda d: exact_dedup.DigestIndex(d.sparkSession, scratch_path(d.sparkSession, "index"), 3).dedup(d),
    "simhash": lambda d: simhash.near_duplicate_groups(d, 5, 6, 2),
    "licenses": licenses.scan,
    "suffix": suffix_dedup.dedup_substrings,
    "lines": line_dedup.dedup_lines,
    "contamination": lambda d: decontaminate.contamination(d, bench(d.sparkSession)),
    "language": lambda d: language_id.identify(d, F.col("source")),
    "mixing": lambda d: mixing.calibrated(d, ["source", "lang", "topic"], [0.8, 0.8, 0.8], 2),
    "score": score,
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_row_for_each_row(name, odd, empty, clashing):
    assert OPERATORS[name](odd).count() == odd.count()
    assert OPERATORS[name](empty).count() == 0
    out = OPERATORS[name](clashing)
    assert out.count() == clashing.count() and len(set(out.columns)) == len(out.columns)
    assert sorted(r[0] for r in out.select("doc_id").collect()) == sorted(r[0] for r in clashing.select("doc_id").collect())


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, name, stage, odd, empty, clashing):
    for docs in (odd, empty, clashing):
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns and out.count() <= docs.count()
        extra = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars", "weight", "probability")]
        if extra:
            assert all(r[c] == f"own {c}" for r in out.select(*[f"`{c}`" for c in extra]).collect() for c in extra)


def test_defined_results(odd):
    rows = {(r.doc_id, r.text): r for r in line_dedup.dedup_lines(odd).collect()}
    assert rows[2, None].n_lines == 0 and [r.n_removed for (d, _), r in rows.items() if d == 6] == [0, 0]
    lang = {r.doc_id: r.language for r in language_id.identify(odd, F.col("source")).collect()}
    assert lang[1] == lang[2] == lang[3] == lang[7] == "und"
    spans = {(r.doc_id, r.n_bytes): r.spans for r in suffix_dedup.dedup_substrings(odd).collect()}
    assert [(s.start, s.end) for s in spans[11, 70_000]] == [(1, 70_000)]
    assert [r.n_tokens for r in score(odd).orderBy("doc_id").collect() if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    found = {r.doc_id: r for r in decontaminate.contamination(odd, bench(odd.sparkSession)).collect()}
    assert found[5].n_hit == 20 and found[5].items == ["1"] and found[8].n_hit == 1 and found[8].items == []
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicate_groups(odd).collect()}
    assert groups[1] == groups[2] == groups[3] == 1


def test_url_filter_of_nothing(spark):
    c = spark.createDataFrame([], "page_id int, url string, fetched_at date")
    e = spark.createDataFrame([], "list string, key string, action string, at date")
    assert url_filter.evaluate(c, e).count() == 0
    assert url_filter.evaluate(spark.createDataFrame([(1, "http://a.b/", None)], c.schema), e).first().blocked is False


def test_pipeline(spark, documents):
    """run() against the plain versions, one after the other. No sample document is rejected for its language."""
    docs = [tuple(r) for r in documents.collect()]
    benchmark = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = brute.cut_lines([(d, t) for d, t, *_ in docs])
    docs = [(d, left[d], *rest) for d, t, *rest in docs if left[d] == t or left[d].strip(" \t\n\x0b\f\r")]
    group = test_similar.groups([(d, t) for d, t, *_ in docs])
    docs = [r for r in docs if group[r[0]] == r[0]]
    hit = brute.contamination([(d, t) for d, t, *_ in docs], benchmark)
    docs = [r for r in docs if not hit[r[0]][1]]

    def topic(t):
        return "table" if " | " in t else "list" if len(t) < (t.count("\n") + 1) * 80 else "prose"

    mixed = brute.mixture([(d, (source, lang, topic(t)), len(brute.space_words(t))) for d, t, lang, source, _ in docs], mixing.POWERS, mixing.SWEEPS)
    want = {d: t for d, t, *_ in docs if mixed[d][2]}
    got = corpus_pipeline.run(spark, SF)
    assert {r.doc_id: r.text for r in got.collect()} == want
    assert {r.doc_id: r.probability for r in got.collect()} == pytest.approx({d: mixed[d][1] for d in want}, abs=2e-6)
