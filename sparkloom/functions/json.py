"""JSON text. Reads use variants inside the JVM; edits and searches of arbitrary paths use Arrow batches of Python."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_KINDS = {"BIGINT": "INTEGER", "TINYINT": "INTEGER", "SMALLINT": "INTEGER", "INT": "INTEGER", "DOUBLE": "DOUBLE", "FLOAT": "DOUBLE", "STRING": "STRING", "BOOLEAN": "BOOLEAN", "VOID": "NULL"}


def extract(doc: Column, *paths: str) -> Column:
    """The value at a path as JSON text, strings quoted; of several paths the array of values found."""
    at = [F.to_json(F.try_variant_get(F.try_parse_json(doc), p, "variant")) for p in paths]
    if len(at) == 1:
        return at[0]
    return F.when(F.coalesce(*at).isNotNull(), F.concat(F.lit("["), F.concat_ws(",", *at), F.lit("]")))


def unquote(doc: Column, path: str = "$") -> Column:
    return F.get_json_object(doc, path)


value = unquote


def object_(**members: Column) -> Column:
    """NULL members stay."""
    return F.to_json(F.struct(*[v.alias(k) for k, v in members.items()]), {"ignoreNullFields": "false"})


def array_(*items: Column) -> Column:
    """Items of any types; NULL items stay."""
    one = [F.regexp_extract(F.to_json(F.array(x), {"ignoreNullFields": "false"}), r"(?s)^\[(.*)\]$", 1) for x in items]
    return F.concat(F.lit("["), F.concat_ws(",", *one), F.lit("]"))


def type_(doc: Column) -> Column:
    kind = F.schema_of_variant(F.try_parse_json(doc))
    out = F.when(kind.startswith("OBJECT"), "OBJECT").when(kind.startswith("ARRAY"), "ARRAY").when(kind.startswith("DECIMAL"), "DOUBLE")
    for spark, name in _KINDS.items():
        out = out.when(kind == spark, name)
    return out


def valid(doc: Column) -> Column:
    return F.when(doc.isNotNull(), F.try_parse_json(doc).isNotNull())


def keys(doc: Column) -> Column:
    return F.json_object_keys(doc)


def _steps(path: str) -> list[str | int]:
    if not re.fullmatch(r'\$(\.[A-Za-z_][\w]*|\."[^"]*"|\[\d+\])*', path):
        raise ValueError(f"not a plain JSON path: {path}")
    return [int(i) if i else name or quoted for name, quoted, i in re.findall(r'\.([A-Za-z_]\w*)|\."([^"]*)"|\[(\d+)\]', path)]


def _edit(doc, steps: list, value, add: bool, change: bool):
    """Set the value at a path, if its parent is there and the kind of edit allows it."""
    if not steps:
        return value if change else doc
    at = doc
    for s in steps[:-1]:
        try:
            at = at[s]
        except (KeyError, IndexError, TypeError):
            return doc
    last = steps[-1]
    if isinstance(at, dict) and isinstance(last, str):
        if change if last in at else add:
            at[last] = value
    elif isinstance(at, list) and isinstance(last, int):
        if last < len(at):
            at[last] = value if change else at[last]
        elif add:
            at.append(value)
    return doc


def _drop(doc, steps: list):
    at = doc
    try:
        for s in steps[:-1]:
            at = at[s]
        if isinstance(at, dict if isinstance(steps[-1], str) else list):
            del at[steps[-1]]
    except (KeyError, IndexError, TypeError):
        pass
    return doc


def _merge(doc, patch):
    if not isinstance(patch, dict):
        return patch
    out = dict(doc) if isinstance(doc, dict) else {}
    for k, v in patch.items():
        if v is None:
            out.pop(k, None)
        else:
            out[k] = _merge(out.get(k), v)
    return out


def _has(target, want) -> bool:
    if isinstance(want, list):
        return isinstance(target, list) and all(_has(target, w) for w in want)
    if isinstance(target, list):
        return any(_has(t, want) for t in target)
    if isinstance(want, dict):
        return isinstance(target, dict) and all(k in target and _has(target[k], w) for k, w in want.items())
    return type(target) is type(want) and target == want


def _paths(doc, like: re.Pattern, at: str = "$"):
    if isinstance(doc, str):
        if like.fullmatch(doc):
            yield at
    elif isinstance(doc, list):
        for i, x in enumerate(doc):
            yield from _paths(x, like, f"{at}[{i}]")
    elif isinstance(doc, dict):
        for k, x in doc.items():
            yield from _paths(x, like, f"{at}.{k}" if re.fullmatch(r"[A-Za-z_]\w*", k) else f'{at}."{k}"')


_ENCODER = json.JSONEncoder(separators=(",", ":"), ensure_ascii=False, check_circular=False)


def _compact(x) -> str:
    return _ENCODER.encode(x)


def _rowwise(result: str, f: Callable, *columns: Column) -> Column:
    """``f`` over parsed documents, NULL where one is NULL or no JSON."""

    @F.arrow_udf(result)
    def over(*batch: pa.Array) -> pa.Array:
        return _mapped(pa.bool_() if result == "boolean" else pa.string(), f, batch)

    return over(*columns)


def _kinds(batch: tuple[pa.Array, ...]) -> tuple[pa.Array, pa.Array]:
    """The kind of each row, and the first row of each kind of equal rows."""
    code, first = np.zeros(len(batch[0]), np.int64), np.arange(min(1, len(batch[0])))
    for c in batch:
        found = c.dictionary_encode(null_encoding="encode")
        if len(found.dictionary) > 1:
            _, first, code = np.unique(code * len(found.dictionary) + found.indices.to_numpy(), return_index=True, return_inverse=True)
    return pa.array(code), pa.array(first)


def _reader(texts: list[str | None]) -> Callable:
    """Reads a text as JSON; a number, string, boolean or null that all rows share is read once (an edit can change others in place)."""
    one = texts[0] if texts else None
    if one is None or texts.count(one) < len(texts):
        return json.loads
    try:
        value = json.loads(one)
    except ValueError:
        return json.loads
    return json.loads if isinstance(value, dict | list) else lambda _: value


def _mapped(kind: pa.DataType, f: Callable, batch: tuple[pa.Array, ...]) -> pa.Array:
    """``f`` is called once for equal rows of a batch."""
    code, first = _kinds(batch)
    texts = [c.take(first).to_numpy(zero_copy_only=False).tolist() for c in batch]  # faster than to_pylist
    readers = [_reader(x) for x in texts]
    out = []
    for row in zip(*texts, strict=True):
        try:
            out.append(None if None in row else f(*[read(x) for read, x in zip(readers, row, strict=True)]))
        except ValueError:
            out.append(None)
    return pa.array(out, kind).take(code)


def _edited(doc: Column, pairs: tuple[tuple[str, Column], ...], add: bool, change: bool) -> Column:
    steps = [_steps(p) for p, _ in pairs]

    def f(d, *values):
        for s, v in zip(steps, values, strict=True):
            d = _edit(d, s, v, add, change)
        return _compact(d)

    return _rowwise("string", f, doc, *[v for _, v in pairs])


def set_(doc: Column, *pairs: tuple[str, Column]) -> Column:
    """Values are JSON text; members are added or changed."""
    return _edited(doc, pairs, True, True)


def insert(doc: Column, *pairs: tuple[str, Column]) -> Column:
    return _edited(doc, pairs, True, False)


def replace(doc: Column, *pairs: tuple[str, Column]) -> Column:
    return _edited(doc, pairs, False, True)


def remove(doc: Column, *paths: str) -> Column:
    steps = [_steps(p) for p in paths]

    def f(d):
        for s in steps:
            d = _drop(d, s)
        return _compact(d)

    return _rowwise("string", f, doc)


def merge_patch(doc: Column, patch: Column) -> Column:
    return _rowwise("string", lambda d, p: _compact(_merge(d, p)), doc, patch)


def contains(target: Column, candidate: Column, path: str | None = None) -> Column:
    """Both are JSON text; a candidate array needs each of its items, an object each of its members."""
    return _rowwise("boolean", _has, extract(target, path) if path else target, candidate)


def search(doc: Column, text: str, all_paths: bool = False) -> Column:
    """Path of the first string like ``text`` (% and _ as in LIKE), or of all: JSON text, NULL if there is none."""
    like = re.compile("".join(".*" if c == "%" else "." if c == "_" else re.escape(c) for c in text), re.DOTALL)

    def f(d):
        found = list(_paths(d, like))
        if not found:
            return None
        return _compact(found if all_paths and len(found) > 1 else found[0])

    return _rowwise("string", f, doc)
