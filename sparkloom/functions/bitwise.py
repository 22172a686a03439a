"""Operations on 64-bit words. Right shifts fill with zeros; shifts by 64 or more give zero."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def bit_and(x: Column, *more: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseAND(b), more, x.cast("bigint"))


def bit_or(x: Column, *more: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), more, x.cast("bigint"))


def bit_xor(x: Column, *more: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), more, x.cast("bigint"))


def bit_count(x: Column) -> Column:
    return F.bit_count(x)


def get_bit(x: Column, place: Column | int) -> Column:
    place = place if isinstance(place, Column) else F.lit(place)
    return F.getbit(x.cast("bigint"), place).cast("int")


def _shift(function: str, x: Column, n: Column | int) -> Column:
    n = n if isinstance(n, Column) else F.lit(n)
    word = F.call_function(function, x.cast("bigint"), n.cast("int"))
    return F.when(x.isNotNull() & n.isNotNull(), F.when(n.between(0, 63), word).otherwise(F.lit(0).cast("bigint")))


def shift_left(x: Column, n: Column | int) -> Column:
    return _shift("shiftleft", x, n)


def shift_right(x: Column, n: Column | int) -> Column:
    return _shift("shiftrightunsigned", x, n)
