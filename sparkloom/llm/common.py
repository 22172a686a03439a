"""Shared pieces of the training-data operators: inputs, shared storage and text expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from ..scratch import scratch_path, shared_dir

__all__ = ["scratch_path", "shared_dir"]

#: ASCII white space as the text contracts define it: space and U+0009 to U+000D.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
#: What separates words of letters and digits; it is applied after lower-casing A-Z.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A side is broadcast only when a count has shown that it has no more rows, and no more bytes in texts and arrays.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 1 << 25


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends in files that outlive any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sized(side: DataFrame, limit: int | None = None) -> DataFrame:
    """``side`` with a broadcast hint if it has at most ``limit`` rows (BROADCAST_ROWS) and BROADCAST_BYTES bytes; else as it
    is, for a shuffled join.

    ``side`` is counted, so it should be materialized or small to compute."""
    limit = BROADCAST_ROWS if limit is None else limit
    wide = [F.col(f"`{f.name}`") for f in side.schema if isinstance(f.dataType, StringType | BinaryType | ArrayType | MapType | StructType)]
    size = F.octet_length(F.to_json(F.struct(*wide))) if wide else F.lit(0)
    n, total = side.limit(limit + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("bigint")), F.lit(0))).first()
    return F.broadcast(side) if n <= limit and total <= BROADCAST_BYTES else side


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once for a row, however often ``then`` or lambdas in it use it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def space_words(text: Column) -> Column:
    """The runs of non-space characters, as an array (empty for blank text)."""
    return let(
        F.btrim(text, F.lit(SPACE_CHARS)),
        lambda bare: F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE)),
    )


def normal_words(text: Column) -> Column:
    """Words of letters, digits and non-ASCII characters, lower-cased, joined by and enclosed in single spaces.

    Text without words gives one space."""
    joined = F.concat(F.lit(" "), ascii_lower(text), F.lit(" "))
    return F.regexp_replace(joined, NON_WORD, " ")


def spaces_in(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))).cast("bigint")


def row_key(*columns: str) -> Column:
    """A hash that tells rows with the same id but other contents apart (together with the id itself)."""
    return F.xxhash64(*columns)


def packed(docs: DataFrame) -> Column:
    """The whole row as one value, so that no column of an operator can clash with one of its input."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def unpacked(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` out of its packed rows, some of them changed; further names are added."""
    kept = [changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    return kept + [x.alias(c) for c, x in changed.items() if c not in docs.columns]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one row (null: none), and where each text starts, with the end of the last."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)), ends - ends[0]


def byte_slices(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have ``limit`` bytes together, or one row; they bound what numpy holds at a time."""
    sizes = np.cumsum(np.nan_to_num(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False).astype(float)))
    i = 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + limit, "right")))
        yield i, j
        i = j
