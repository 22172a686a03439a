"""JSON documents as rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Field:
    """A column: its type and path; ``exists`` gives 1 or 0; on errors NULL, a default, or an error."""

    name: str
    kind: str = "string"
    path: str = ""
    ordinality: bool = False
    exists: bool = False
    on_error: str = "null"
    default: object = None


@dataclass
class Nested:
    path: str
    fields: list[Field | Nested] = field(default_factory=list)


def _value(item: Column, f: Field, place: Column) -> Column:
    if f.ordinality:
        return (place + 1).cast("int")
    at = F.try_variant_get(item, f.path, "variant")
    if f.exists:
        return at.isNotNull().cast("int")
    text = F.try_variant_get(item, f.path, "string")
    if f.kind == "json":
        return F.to_json(at)
    if f.on_error == "error":
        return text.cast(f.kind)
    cast = text.try_cast(f.kind)
    return F.coalesce(cast, F.lit(f.default).cast(f.kind)) if f.on_error == "default" else cast


def _rows(df: DataFrame, source: Column, path: str, fields: list[Field | Nested], outer: bool, depth: int) -> DataFrame:
    if path.endswith("[*]"):
        items = F.try_variant_get(source, path[:-3] or "$", "array<variant>")
    else:
        items = F.array(F.try_variant_get(source, path, "variant"))
    at, item = f"_at{depth}", f"_item{depth}"
    kept = [F.col(f"`{c}`") for c in df.columns]
    out = df.select(*kept, (F.posexplode_outer if outer else F.posexplode)(items).alias(at, item))
    for f in fields:
        if isinstance(f, Field):
            out = out.withColumn(f.name, _value(F.col(item), f, F.col(at)))
    for f in fields:
        if isinstance(f, Nested):
            out = _rows(out, F.col(item), f.path, f.fields, True, depth + 1)
    return out


def json_table(df: DataFrame, doc: str, path: str, fields: list[Field | Nested]) -> DataFrame:
    """``df`` with a row for each item at ``path`` (items of an array with ``[*]``) and a column for each field.

    Nested paths give a row for each of their items, or one of NULLs. A document that is NULL or no JSON, or lacks
    the path, gives no rows."""
    parsed = df.withColumn("_doc", F.try_parse_json(F.col(doc)))
    out = _rows(parsed, F.col("_doc"), path, fields, False, 0)
    return out.drop(*[c for c in out.columns if c == "_doc" or c.startswith(("_at", "_item"))])
