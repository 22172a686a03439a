"""Language identification against plain loops, and what each kind of evidence does."""

import random
import re

import brute
import pytest
from pyspark.sql import functions as F

from sparkloom.llm import language_id


def test_query_against_loops(spark, sf, documents):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in documents.collect()]
    want = brute.languages(rows, language_id.LANGUAGES)
    got = language_id.op7_language_id(spark, sf).collect()
    assert len(got) == len(want)
    for r in got:
        language, sure, alone = want[r.doc_id]
        assert (r.language, r.text_language) == (language, alone)
        assert r.confidence == pytest.approx(sure, abs=2e-5)


def test_pages_against_loops(spark, sf):
    """All of ``pages``, where hosts have domains and suffixes and pages declare their language."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    endings = F.element_at(F.array(*map(F.lit, ("de", "co.uk", "fr", "com"))), (F.col("page_id") % 4 + 1).cast("int"))
    short = F.concat(F.lit('<html lang="'), F.regexp_extract("html", r'lang="(\w+)"', 1), F.lit('"><p>'), F.substring(F.regexp_extract("html", r"<p>(?:<b>)?([^<]+)", 1), 1, 8))
    pages = pages.select("page_id", F.regexp_replace("url", r"example\.\w+", F.concat(F.lit("example."), endings)).alias("url"), F.when(F.col("page_id") % 2 == 0, short).otherwise(F.col("html")).alias("html"))
    rows = []
    for r in pages.collect():
        text = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;", " ", r.html)
        rows.append((r.page_id, text, re.search(r'<html lang="(\w+)"', r.html)[1], r.url.split("/")[2]))
    want = brute.languages(rows, language_id.LANGUAGES)
    found = lambda p: {r.page_id: r for r in language_id.identify_pages(p).collect()}
    got = found(pages)
    assert {n: (r.language, r.text_language) for n, r in got.items()} == {n: (w[0], w[2]) for n, w in want.items()}
    assert [r.confidence for r in got.values()] == pytest.approx([want[n][1] for n in got], abs=2e-4)
    unsuffixed = found(pages.withColumn("url", F.regexp_replace("url", r"example\.[a-z.]+", "example.com")))
    undeclared = found(pages.withColumn("html", F.regexp_replace("html", r"<html[^>]*>", "<html>")))
    for without in (unsuffixed, undeclared):
        assert sum(abs(without[n].confidence - got[n].confidence) > 1e-3 for n in got) > 0


def test_other_texts_are_rejected(spark, documents):
    rng = random.Random(3)
    junk = " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(200))
    texts = [(1, junk, None), (2, "Съешь же ещё этих мягких французских булок, да выпей чаю " * 3, "ru"), (3, "これは日本語の文章です。" * 10, None), (4, junk, "en"), (5, None, "en"), (6, "", None), (7, "12 345 " * 999, "de")]
    ask = spark.createDataFrame(texts, "doc_id bigint, text string, lang string").withColumn("source", F.lit("src0"))
    got = language_id.identify(ask, F.col("source"), labels=documents).collect()
    assert {r.doc_id: r.language for r in got} == dict.fromkeys(range(1, 8), "und")
    kept = language_id.keep_identified(documents)
    assert kept.count() == documents.where("text <> ''").count()


def test_own_declaration_is_left_out(spark):
    """The only labelled row of a host has the prior of the host's domain, without itself."""
    rows = [(1, "qqq", "de", "a.x.org"), (2, "the house", "en", "b.x.org"), (3, "das haus", "de", "c.y.org"), (4, "qqq", None, "a.x.org"), (5, "qqq", "it", None), (5, "qqq", "it", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    want = brute.languages(rows, ("de", "en"))
    got = language_id.identify(docs, F.col("source"), ("de", "en")).collect()
    assert len(got) == 6
    for r in got:
        assert r.confidence == pytest.approx(want[r.doc_id][1], abs=1e-5) and r.language == want[r.doc_id][0]


def test_edges(spark):
    schema = "page_id bigint, url string, html string, language string, host string"
    pages = spark.createDataFrame([(1, None, None, "x", "y"), (2, "no url", "<html lang='en-GB'>" + "the house " * 30000, None, None)], schema)
    got = {r.page_id: r for r in language_id.identify_pages(pages, ("de", "en")).collect()}
    assert (got[1].language, got[1].host, got[1].declared) == ("und", None, None)
    assert (got[2].language, got[2].host, got[2].declared) == ("en", None, "en")
    assert language_id.identify_pages(pages.limit(0)).count() == 0
