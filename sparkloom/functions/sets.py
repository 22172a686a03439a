"""Enumerations and comma-joined sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def find_in_set(value: Column | str, members: Column) -> Column:
    """Place of a value in comma-joined members from 1, 0 if absent."""
    return F.find_in_set(value if isinstance(value, Column) else F.lit(value), members)


def contains_all(members: Column, values: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [find_in_set(v, members) > 0 for v in values], F.lit(True))


def elt(place: Column, *values: Column | str) -> Column:
    """The value at a place from 1, NULL outside."""
    return F.get(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), place - 1)


def field(value: Column, *values: Column | str) -> Column:
    """Place of the first equal value from 1; 0 if absent or NULL."""
    return F.coalesce(F.array_position(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), value), F.lit(0))


def set_literal(values: list[str], allowed: list[str]) -> Column:
    """Checked members as sorted comma-joined text; at most 64 are allowed."""
    if len(allowed) > 64:
        raise ValueError("a set has at most 64 members")
    if wrong := sorted(set(values) - set(allowed)):
        raise ValueError(f"not members of the set: {wrong}")
    return F.lit(",".join(sorted(set(values))))


def to_array(members: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(members, ","), lambda x: x != "")))


def enum_index(value: Column, members: list[str]) -> Column:
    """1-based index of an enumeration's value, NULL for others."""
    return F.nullif(field(value, *members), F.lit(0))


def enum_value(index: Column, members: list[str]) -> Column:
    return elt(index, *members)
