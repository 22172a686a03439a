"""A training-data pipeline over ``documents``: five stages, each on all that the one before has kept."""

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm.common import load, materialize
from sparkloom.llm.decontaminate import drop_contaminated
from sparkloom.llm.language_id import keep_identified
from sparkloom.llm.line_dedup import drop_repeated_lines
from sparkloom.llm.mixing import mix
from sparkloom.llm.similar import drop_similar


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines in repeated runs of ten words or more go; so do documents of which nothing is left."""
    return drop_repeated_lines(docs, min_words=10)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays. SimHash fingerprints that meet at anchors make candidates; links are
    those with an exact Jaccard similarity of five-word shingles of 0.8 at least."""
    return drop_similar(docs, k=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of a benchmark item go."""
    return drop_contaminated(docs, load(spark, sf_dir, "benchmark"), width=10)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by raked weights, with ``weight`` and ``probability``."""
    return mix(docs)


STAGES = [
    ("language id", language_id),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]
#: Language identification and near-duplicate groups have no SQL form; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
