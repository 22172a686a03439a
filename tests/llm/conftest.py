import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids, signs only, non-ASCII."""
    rng = random.Random(5)
    words = [f"w{n}" for n in range(400)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    passage = " ".join(f"shared{n}" for n in range(60))
    return [
        (1, "", "en", "a", 0), (2, None, "en", "a", None), (3, " \t\n\r ", None, None, 5), (None, "no id here but some words", "en", "b", 1), (None, None, None, None, None), (4, long, "en", "b", len(long)),
        (5, f"first words {passage} last words", "en", "c", 1), (6, f"other\n{passage}\nÄÖÜ ñandú", "de", "c", 1), (6, f"other\n{passage}\nÄÖÜ ñandú", "de", "c", 1), (6, "the same id, another text", "de", "c", 1), (7, "!!! ??? ...", "xx", "", 1),
        (8, "a", "fr", "a", 1), (9, f"{passage} {passage}", "en", "a", 1), (10, "\x00nul\x00 and ﻿ mark \U0001f600", "en", "a", 1), (11, "x" * 70_000, "en", "a", 70_000),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(documents):
    """Extra columns with the names that operators use inside, or give their results."""
    from pyspark.sql import functions as F

    names = "id key row fp h host found text_language language confidence n_lines n_removed runs left topic n_tokens weight probability sampled words window items start end _id _key m0 f_m0 largest component_id a b digest keep_id group_size kept spans n_bytes license_scan".split()
    return documents.limit(60).select("*", *[F.lit(f"own {n}").alias(n) for n in names])
