"""Numeric functions with NULL where the input has no answer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


_LARGE = 2.0**53


def _col(x: Column | float) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def round_(x: Column, digits: int = 0) -> Column:
    """Half away from zero."""
    return F.round(x, digits)


def power(base: Column | float, exponent: Column | float) -> Column:
    return F.pow(_col(base), _col(exponent))


pow_ = power


def sqrt(x: Column) -> Column:
    """NULL for negative numbers."""
    return F.when(x >= 0, F.sqrt(x))


def mod(a: Column, b: Column | float) -> Column:
    """NULL for a zero divisor."""
    return F.try_mod(a, _col(b))


def divide(a: Column, b: Column | float) -> Column:
    """NULL for a zero divisor."""
    return F.try_divide(a, _col(b))


def ceil(x: Column) -> Column:
    return F.ceil(x)


def floor(x: Column) -> Column:
    return F.floor(x)


def truncate(x: Column, digits: int = 0) -> Column:
    """Toward zero, to ``digits`` places (above 22 nothing is cut); negative digits clear places before the point.

    Numbers of 2^53 and more, NaN and infinities have no places after the point and stay as they are."""
    wide = x.cast("double")
    if digits > 22:
        return wide
    if digits <= 0:
        scaled = wide / F.lit(10.0**-digits)
        return F.signum(scaled) * _whole(F.abs(scaled)) * F.lit(10.0**-digits)
    exact = F.when(F.abs(wide) < _LARGE, x).cast("decimal(38,22)")
    return F.coalesce(F.when(exact >= 0, F.floor(exact, F.lit(digits))).otherwise(F.ceil(exact, F.lit(digits))).cast("double"), wide)


def _whole(x: Column) -> Column:
    return F.when(x < _LARGE, F.floor(F.when(x < _LARGE, x)).cast("double")).otherwise(x)


def greatest(*xs: Column) -> Column:
    """NULL if any argument is."""
    return F.when(reduce(lambda a, b: a & b, [x.isNotNull() for x in xs]), F.greatest(*xs))


def least(*xs: Column) -> Column:
    """NULL if any argument is."""
    return F.when(reduce(lambda a, b: a & b, [x.isNotNull() for x in xs]), F.least(*xs))
