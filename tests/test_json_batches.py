"""JSON edits over batches: equal rows are worked on once, and rows share nothing that an edit changes."""

import json as std

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkloom.functions import json


def test_equal_rows_once():
    seen = []
    got = json._mapped(pa.string(), lambda d, v: seen.append((d, v)) or f"{d}{v}", (pa.array(["1", None, "{", "2"] * 500), pa.array(["7", "8"] * 1000)))
    assert sorted(seen) == [(1, 7), (2, 8)]
    assert got.to_pylist() == ["17", None, None, "28"] * 500


@pytest.mark.parametrize("rows", [[], [(None, "1")], [("1", None)], [("{}", "{oops")] * 3, [(f"[{i % 7}]", f"{i % 5}") for i in range(300)], [(f'{{"é":{i}.0}}', '"x"') for i in range(40)], [(" 1 ", "1"), ("1", " 1 "), ("1 2", "1")]])
def test_batch_is_as_its_rows(rows):
    def each(row):
        try:
            return None if None in row else std.dumps([*map(std.loads, row)], separators=(",", ":"), ensure_ascii=False)
        except ValueError:
            return None

    batch = tuple(pa.array([r[i] for r in rows], pa.string()) for i in range(2))
    assert json._mapped(pa.string(), lambda *x: json._compact([*x]), batch).to_pylist() == [each(r) for r in rows]


def test_edits_share_nothing(spark):
    """A constant object is put into each document and changed there."""
    df = spark.range(0, 60, 1, 1).select(F.col("id"), F.concat(F.lit('{"k":'), (F.col("id") % 20).cast("string"), F.lit("}")).alias("d"))
    out = json.set_(F.col("d"), ("$.a", F.lit("{}")), ("$.b", F.lit("[0]")), ("$.a.x", F.col("id").cast("string")), ("$.b[1]", F.lit("null")))
    want = [(i, f'{{"k":{i % 20},"a":{{"x":{i}}},"b":[0,null]}}') for i in range(60)]
    assert [tuple(r) for r in df.select("id", out).orderBy("id").collect()] == want
    merged = json.merge_patch(F.col("d"), F.lit('{"a":{"b":[1,null]},"k":null}'))
    assert {r[0] for r in df.select(merged).collect()} == {'{"a":{"b":[1,null]}}'}
