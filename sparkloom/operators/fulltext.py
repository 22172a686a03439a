"""Full-text search with scores defined here: sums over query terms of frequency times inverse document frequency."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import scratch_path

NATURAL, BOOLEAN, EXPANSION = "natural", "boolean", "expansion"


def terms(text: Column) -> Column:
    """Lower-case runs of letters, digits and underscores."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}_]+"), lambda t: t != "")


def query_terms(query: str) -> list[str]:
    return sorted({t for t in re.split(r"[^\w]+", query.lower()) if t})


def _pattern(words: list[str], prefix: bool = False) -> str:
    """The words one after another, as whole terms (the last one may be the beginning of one)."""
    return r"(?<![\p{L}\p{N}_])" + r"[^\p{L}\p{N}_]+".join(words) + ("" if prefix else r"(?![\p{L}\p{N}_])")


def _lower(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def natural(docs: DataFrame, id_col: str, text: Column, query: str | list[str]) -> DataFrame:
    """``id`` and ``relevance`` of documents with a query term: sum of tf * ln((N + 1) / (df + 0.5)), to six places."""
    wanted = query_terms(query) if isinstance(query, str) else query
    low, names = F.col("_low"), [f"_tf{i}" for i in range(len(wanted))]
    if not wanted:
        return docs.select(F.col(id_col).alias("id"), F.lit(0.0).alias("relevance")).where(F.lit(False))
    # A text without any of the terms as a plain string is never searched by pattern.
    near = docs.select(F.col(id_col).alias("id"), _lower(text).alias("_low")).where(reduce(lambda a, b: a | b, [F.contains(low, F.lit(t)) for t in wanted]))
    tf = near.groupBy("id").agg(*[F.sum(F.regexp_count(low, F.lit(_pattern([t])))).alias(n) for t, n in zip(wanted, names, strict=True)])
    path = scratch_path(docs.sparkSession, "term_counts")
    tf.write.parquet(path)
    tf = docs.sparkSession.read.schema(tf.schema).parquet(path)
    total = docs.agg(F.count(F.lit(1)).alias("_docs"))  # one row
    seen = tf.agg(*[F.count_if(F.col(n) > 0).alias(f"_df{n}") for n in names]).crossJoin(total)  # one row
    score = reduce(lambda a, b: a + b, [F.col(n) * F.log((F.col("_docs") + 1) / (F.col(f"_df{n}") + 0.5)) for n in names])
    return tf.crossJoin(F.broadcast(seen)).select("id", F.round(score, 6).alias("relevance")).where("relevance > 0")


def boolean(docs: DataFrame, id_col: str, text: Column, query: str) -> DataFrame:
    """``+term`` must be there, ``-term`` must not; of bare terms one must if nothing else is required. ``relevance``
    counts the terms that are there. ``term*`` matches beginnings, quoted words a phrase."""
    need, banned, may = [], [], []
    for sign, phrase, word in re.findall(r'([+-]?)(?:"([^"]*)"|([\w*]+))', query):
        {"+": need, "-": banned, "": may}[sign].append(phrase or word)

    def has(t: str) -> Column:
        prefix = t.endswith("*") and " " not in t
        words = re.findall(r"\w+", t[:-1].lower() if prefix else t.lower())
        if not words or "*" in t[:-1]:
            return F.lit(False)
        gate = reduce(lambda a, b: a & b, [F.contains("_low", F.lit(w)) for w in words])
        return gate & F.col("_low").rlike(_pattern(words, prefix))

    out = docs.select(F.col(id_col).alias("id"), _lower(text).alias("_low"))
    for t in need:
        out = out.where(has(t))
    for t in banned:
        out = out.where(~has(t))
    n = sum((has(t).cast("int") for t in [*need, *may]), F.lit(0))
    out = out.select("id", n.alias("relevance"))
    return out if need or not may else out.where("relevance > 0")


def expanded(docs: DataFrame, id_col: str, text: Column, query: str, top: int = 3, more: int = 5) -> DataFrame:
    """A second search with the ``more`` most frequent terms of the ``top`` documents of the first one."""
    first = natural(docs, id_col, text, query).orderBy(F.desc("relevance"), "id").limit(top)
    best = docs.join(F.broadcast(first.select(F.col("id").alias("_match"))), F.col(id_col) == F.col("_match"), "left_semi")  # ``top`` rows
    counts = best.select(F.explode(terms(text)).alias("term")).groupBy("term").count().orderBy(F.desc("count"), "term").limit(more)
    wanted = sorted({*query_terms(query), *[r.term for r in counts.collect()]})  # a few words
    return natural(docs, id_col, text, wanted)


def match(docs: DataFrame, id_col: str, columns: list[str], query: str, mode: str = NATURAL) -> DataFrame:
    """``docs`` that match, with ``relevance``."""
    text = F.concat_ws(" ", *columns)
    found = {NATURAL: natural, BOOLEAN: boolean, EXPANSION: expanded}[mode](docs, id_col, text, query)
    found = found.withColumnRenamed("id", "_match")
    return docs.join(found, F.col(id_col) == F.col("_match")).drop("_match")
