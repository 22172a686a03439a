"""Vectors as arrays of numbers; sums are in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DIMENSIONS = 16_384


def literal(values: list[float]) -> Column:
    if len(values) > MAX_DIMENSIONS:
        raise ValueError(f"a vector has at most {MAX_DIMENSIONS} dimensions")
    return F.array(*[F.lit(float(v)) for v in values]).cast("array<float>")


def from_string(text: Column) -> Column:
    return F.from_json(text, "array<float>")


def to_string(v: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: x.cast("string")), ","), F.lit("]"))


def dim(v: Column) -> Column:
    return F.when(v.isNotNull(), F.size(v))


def _sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2.0)))))


def cosine(a: Column, b: Column) -> Column:
    """One less the cosine; NULL for a zero vector."""
    return 1 - F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
