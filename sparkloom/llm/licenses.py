"""License detection by ordered signature rules.

Texts are reduced to lower-case words joined by single spaces. Each rule is a regular expression over words with a
keyword that must be present before the expression is tried, a label, a priority and a weight. A detection inside
the word interval of a stronger one (higher priority, then longer, then earlier rule) is suppressed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, load, normal_words, spaces_in, text_or_empty
from .license_rules import BASE, RULES, STEMS, Rule

_DETECTION = "array<struct<start:bigint,end:bigint,label:string,priority:int,weight:double,rule:int>>"


def _by_keyword(rules: list[Rule]) -> Column:
    """Array of (keyword, rules): each keyword once, with its rules and their numbers."""
    keywords: dict[str, list[Column]] = {}
    for number, r in enumerate(rules):
        rule = {"label": r.label, "pattern": f"(?<= )(?:{r.pattern})(?= )", "priority": r.priority, "weight": r.weight, "rule": number}
        keywords.setdefault(r.keyword, []).append(F.struct(*[F.lit(x).alias(n) for n, x in rule.items()]))
    return F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*of).alias("rules")) for k, of in keywords.items()])


def _places(text: Column, rule: Column) -> Column:
    """The detections of one rule in a text of words enclosed in single spaces."""

    def of(found: Column) -> Column:
        gaps = F.slice(F.split(text, rule["pattern"]), 1, F.size(found))
        none = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_DETECTION).alias("out"))

        def step(a: Column, x: Column) -> Column:
            start = a["at"] + spaces_in(x["gap"])
            end = start + spaces_in(x["match"])
            one = F.struct((start - 1).alias("start"), end.alias("end"), rule["label"].alias("label"), rule["priority"].alias("priority"), rule["weight"].alias("weight"), rule["rule"].alias("rule"))
            return F.struct(end.alias("at"), F.concat(a["out"], F.array(one)).alias("out"))

        return F.aggregate(F.arrays_zip(gaps.alias("gap"), found.alias("match")), none, step, lambda a: a["out"])

    # Without a match the text isn't split.
    return let(F.regexp_extract_all(text, rule["pattern"], F.lit(0)), lambda found: F.when(F.size(found) > 0, of(found)).otherwise(F.array().cast(_DETECTION)))


def _detections(text: Column, rules: list[Rule]) -> Column:
    present = F.filter(_by_keyword(rules), lambda k: F.contains(text, k["keyword"]))
    return F.flatten(F.transform(F.flatten(F.transform(present, lambda k: k["rules"])), lambda r: _places(text, r))).cast(_DETECTION)


def _strongest(found: Column) -> Column:
    """Detections that aren't contained in the interval of a stronger one.

    Sorted detections are cut into stretches that don't overlap, so that each is compared with its neighbours only."""

    def beats(e: Column, d: Column) -> Column:
        size_e, size_d = e["end"] - e["start"], d["end"] - d["start"]
        rank_e, rank_d = F.struct(e["priority"], size_e, -e["rule"], -e["start"]), F.struct(d["priority"], size_d, -d["rule"], -d["start"])
        return (e["start"] <= d["start"]) & (e["end"] >= d["end"]) & (rank_e > rank_d)

    none = F.array().cast(_DETECTION)
    empty = F.struct(F.lit(0).cast("bigint").alias("upto"), none.alias("now"), F.array().cast(f"array<{_DETECTION}>").alias("done"))

    def step(a: Column, d: Column) -> Column:
        joins, one = d["start"] < a["upto"], F.array(d)
        return F.struct(
            F.greatest(a["upto"], d["end"]).alias("upto"),
            F.when(joins, F.concat(a["now"], one)).otherwise(one).alias("now"),
            F.when(joins, a["done"]).otherwise(F.concat(a["done"], F.array(a["now"]))).alias("done"),
        )

    stretches = F.aggregate(F.array_sort(found), empty, step, lambda a: F.concat(a["done"], F.array(a["now"])))
    return F.flatten(F.transform(stretches, lambda s: F.filter(s, lambda d: ~F.exists(s, lambda e: beats(e, d)))))


def scan(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` (any columns) with ``license_scan``: ``n_words``, ``base`` (all places of the base phrases) and
    ``found`` (detections that no stronger one contains), both arrays of (start, end, label, priority, weight, rule);
    numbers of rules count the base phrases first.

    Everything is computed within the row, over the whole text however long. Null and wordless texts have no words and no
    detections. Repeated rows each give their row, and no rows give none. A column named license_scan is replaced; no
    other name clashes. With ``rules`` of one's own, only texts with one of their keywords are looked at."""
    stems = STEMS if rules is None else sorted({r.keyword for r in [*BASE, *rules]})
    every = [*BASE, *(RULES if rules is None else rules)]

    def of(text: Column) -> Column:
        gate, none = reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in stems]), F.array().cast(_DETECTION)
        both = lambda found: F.struct(
            (spaces_in(text) - 1).alias("n_words"),
            F.filter(found, lambda d: d["rule"] < len(BASE)).alias("base"),
            F.when(F.size(found) > 0, _strongest(found)).otherwise(none).alias("found"),
        )
        return let(F.when(gate, _detections(text, every)).otherwise(none), both)

    return docs.withColumn("license_scan", let(normal_words(text_or_empty(docs[text_col])), of))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` with all rules."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    s = F.col("license_scan")
    base = lambda x: F.transform(s["base"], lambda d: d[x])
    labels = lambda *found: F.concat_ws(",", F.array_sort(F.array_distinct(F.concat(*[F.transform(f, lambda d: d["label"]) for f in found]))))
    return scan(docs).select(
        "doc_id",
        s["n_words"].alias("n_words"),
        F.size(s["base"]).cast("bigint").alias("n_base"),
        F.array_min(base("start")).alias("first_word"),
        F.array_max(base("start")).alias("last_word"),
        labels(s["base"]).alias("base_labels"),
        labels(s["base"], s["found"]).alias("labels"),
        F.coalesce(F.array_max(F.transform(F.concat(s["base"], s["found"]), lambda d: d["weight"])), F.lit(0.0)).alias("score"),
    )


QUERIES = {"op4_license_scan": op4_license_scan}
ORACLE: dict[str, str] = {}
