"""Mixing sources to target weights: raking (iterative proportional fitting) and calibrated sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, materialize, packed, text_or_empty, unpacked

_WORD = r"[^\x20\x09-\x0D]+"


def topic_of(text: Column) -> Column:
    """A coarse topic by form: tables, lists of short lines, or prose."""
    text = text_or_empty(text)
    lines = F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1
    return F.when(F.contains(text, F.lit(" | ")), "table").when(F.char_length(text) < lines * 80, "list").otherwise("prose")


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares of a margin's values: their shares of the tokens to a power, made to add up to one."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    raised = sums.select(margin, F.pow(F.col("tokens").cast("double"), F.lit(power)).alias("share"))
    return raised.crossJoin(F.broadcast(raised.agg(F.sum("share").alias("_all")))).select(margin, (F.col("share") / F.col("_all")).alias("share"))  # one row, the sum


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = 5) -> DataFrame:
    """``cells`` with a factor ``f_<margin>`` of each margin's value, such that ``tokens`` times the factors of a cell
    has the target shares.

    ``cells`` has the margins and ``tokens``; each target has the margin and ``share`` (adding up to one). A sweep
    fits each margin once, in the order of ``targets``, so the last one is met exactly. Values with tokens but no
    target share get factor zero, values without tokens a null. A fit is one grouped sum, combined before the shuffle
    and joined back; it ends in files, which Spark broadcasts or shuffles by their size."""
    state = cells.crossJoin(F.broadcast(cells.agg(F.sum("tokens").cast("double").alias("_total"))))  # one row, the sum of all tokens
    for margin, target in targets.items():
        state = state.join(target.withColumnRenamed("share", f"_share_{margin}"), margin, "left")
    goals = [(F.coalesce(f"_share_{m}", F.lit(0.0)) * F.col("_total")).alias(f"_goal_{m}") for m in targets]
    state = materialize(state.select(*cells.columns, *goals, *[F.lit(1.0).alias(f"f_{m}") for m in targets]), "cells")
    for _ in range(sweeps):
        for margin in targets:
            weight = reduce(lambda a, b: a * b, [F.col(f"f_{o}") for o in targets if o != margin], F.col("tokens").cast("double"))
            now = state.groupBy(margin).agg(F.sum(weight).alias("_now")).where("_now > 0")
            fitted = state.join(now, margin, "left").withColumn(f"f_{margin}", F.col(f"_goal_{margin}") / F.col("_now"))
            state = materialize(fitted.select(*state.columns), "cells")
    return state.select(*cells.columns, *[f"f_{m}" for m in targets])


def _calibrated(docs: DataFrame, margins: list[str], powers: list[float], sweeps: int, fraction: float, seed: str, id_col: str, text_col: str) -> DataFrame:
    """``row`` (packed) and the columns that ``calibrated`` adds. The margin 'topic' is the one found here."""
    topic = topic_of(F.col(text_col))
    value = {m: f"m{i}" for i, m in enumerate(margins)}
    rows = docs.select(
        packed(docs).alias("row"), F.col(id_col).cast("string").alias("id"), topic.alias("topic"), F.regexp_count(text_or_empty(text_col), F.lit(_WORD)).cast("bigint").alias("n_tokens"),
        *[(topic if m == "topic" else F.coalesce(F.col(m).cast("string"), F.lit(""))).alias(c) for m, c in value.items()],
    )
    own = list(value.values())
    cells = materialize(rows.groupBy(*own).agg(F.sum("n_tokens").alias("tokens")), "cells")
    raked = rake(cells, {c: tempered(cells, c, p) for c, p in zip(own, powers, strict=True)}, sweeps)
    product = reduce(lambda a, b: a * b, [F.col(f"f_{c}") for c in own])
    largest = raked.where("tokens > 0").agg(F.max(product).alias("largest"))
    rows = rows.join(raked.select(*own, product.alias("product")), own, "left").crossJoin(F.broadcast(largest))  # one row
    weight = F.coalesce("product", F.lit(0.0))
    uniform = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("id", F.lit("")))), 1, 13), 16, 10).cast("double") / float(1 << 52)
    probability = F.coalesce(F.round(weight / F.col("largest") * fraction, 6), F.lit(0.0))
    return rows.select("row", "topic", "n_tokens", F.round(weight, 6).alias("weight"), probability.alias("probability"), (uniform < probability).alias("sampled"))


def calibrated(docs: DataFrame, margins: list[str], powers: list[float], sweeps: int = 5, fraction: float = 1.0, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``topic``, ``n_tokens``, ``weight`` (of each of the document's tokens, 1 on average),
    ``probability`` and ``sampled``.

    The probabilities are the weights over the largest weight of any cell, times ``fraction``; so expected tokens
    have the target shares exactly. A document is sampled if a hash of ``seed`` and its id falls below its
    probability: repeated ids fall together, and no row's fate depends on others. A null margin counts as the value
    ''; null text has no tokens and, alone in its cell, probability zero. Columns with the added names are replaced."""
    out = _calibrated(docs, margins, powers, sweeps, fraction, seed, id_col, text_col)
    return out.select(*unpacked(docs, **{c: F.col(c) for c in ("topic", "n_tokens", "weight", "probability", "sampled")}))


#: Production margins and the powers that temper their shares.
MARGINS, POWERS, SWEEPS = ["source", "lang", "topic"], [0.85, 0.85, 0.9], 5


def mix(docs: DataFrame) -> DataFrame:
    """The sampled documents, with their columns and ``weight`` and ``probability``."""
    out = _calibrated(docs, MARGINS, POWERS, SWEEPS, 1.0, "mix", "doc_id", "text").where("sampled")
    return out.select(*unpacked(docs, weight=F.col("weight"), probability=F.col("probability")))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``, raked to tempered shares of source, language and topic."""
    out = calibrated(load(spark, sf_dir, "documents"), MARGINS, POWERS, SWEEPS)
    return out.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled")


def _oracle() -> str:
    own = {"s": ("source", POWERS[0]), "l": ("lang", POWERS[1]), "t": ("topic", POWERS[2])}
    parts = [
        r"""d AS (SELECT doc_id, source, lang, coalesce(source, '') AS s, coalesce(lang, '') AS l, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens,
            CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN length(coalesce(text, '')) < (length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1) * 80 THEN 'list' ELSE 'prose' END AS t FROM documents)""",
        "c AS (SELECT s, l, t, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL HAVING sum(n_tokens) > 0)",
        "tot AS (SELECT sum(tokens) AS total FROM c)",
    ]
    for m, (_, p) in own.items():
        parts.append(f"g_{m} AS (SELECT {m}, x / sum(x) OVER () AS share FROM (SELECT {m}, pow(sum(tokens), {p}) AS x FROM c GROUP BY {m}))")
    have: dict[str, str] = {}
    for sweep in range(SWEEPS):
        for m in own:
            joins = " ".join(f"JOIN {t} USING ({o})" for o, t in have.items() if o != m)
            product = " * ".join(["tokens", *[f"{t}.f" for o, t in have.items() if o != m]])
            name = f"f_{m}{sweep}"
            parts.append(f"{name} AS MATERIALIZED (SELECT {m}, share * total / now AS f FROM (SELECT {m}, sum({product}) AS now FROM c {joins} GROUP BY {m}) JOIN g_{m} USING ({m}), tot)")
            have[m] = name
    joins = " ".join(f"LEFT JOIN {t} USING ({m})" for m, t in have.items())
    product = " * ".join(f"{t}.f" for t in have.values())
    return f"""WITH {", ".join(parts)},
        big AS (SELECT max({product}) AS b FROM c {joins.replace("LEFT ", "")}),
        w AS (SELECT doc_id, source, lang, t AS topic, n_tokens, coalesce({product}, 0) AS w, b FROM d {joins}, big),
        p AS (SELECT *, coalesce(round(w / b, 6), 0) AS probability FROM w)
        SELECT doc_id, source, lang, topic, n_tokens, round(w, 6) AS weight, probability,
               ('0x' || substr(md5('mix:' || doc_id::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0 < probability AS sampled FROM p"""


QUERIES = {"op2_mix_sources": op2_mix_sources}
ORACLE = {"op2_mix_sources": _oracle()}
