"""Semantics that the sample tables don't show: NULLs, zeros, edges of ranges."""

import struct

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import bitwise, dates, json, math, sets, spatial, vector


def one(spark, *columns):
    return list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


def test_math(spark):
    null = F.lit(None).cast("int")
    got = one(spark, math.round_(F.lit(2.5)), math.round_(F.lit(-1.5)), math.sqrt(F.lit(-1.0)), math.mod(F.lit(5), F.lit(0)), math.divide(F.lit(1), F.lit(0)), math.truncate(F.lit(-1.79), 1), math.truncate(F.lit(1279), -2), math.greatest(F.lit(1), null), math.least(F.lit(1), F.lit(2)))
    assert got == [3.0, -2.0, None, None, None, -1.7, 1200.0, None, 1]


@pytest.mark.parametrize("x, digits, want", [(1e30, 2, 1e30), (1e30, 0, 1e30), (1e30, -2, 1e30), (0.123456789012, 11, 0.12345678901), (0.29, 2, 0.29), (-0.29, 1, -0.2), (-1.9, 0, -1.0), (-1279.0, -2, -1200.0), (None, 2, None), (float("inf"), 1, float("inf")), (1.5, 30, 1.5)])
def test_truncate(spark, x, digits, want):
    assert one(spark, math.truncate(F.lit(x).cast("double"), digits)) == [want]


def test_bitwise(spark):
    got = one(spark, bitwise.bit_count(F.lit(-1).cast("bigint")), bitwise.shift_right(F.lit(-1), 1), bitwise.shift_left(F.lit(1), 64), bitwise.shift_left(F.lit(1), 63), bitwise.get_bit(F.lit(5), 2), bitwise.shift_right(F.lit(None).cast("int"), 70), bitwise.bit_xor(F.lit(6), F.lit(3)))
    assert got == [64, 2**63 - 1, 0, -(2**63), 1, None, 5]


def test_sets(spark):
    got = one(spark, sets.elt(F.lit(4), "a", "b"), sets.field(F.lit("x"), "a"), sets.field(F.lit(None).cast("string"), "a"), sets.find_in_set("b", F.lit("a,b")), sets.set_literal(["b", "a", "b"], ["a", "b", "c"]), sets.enum_index(F.lit("zz"), ["a"]), sets.enum_value(F.lit(1), ["a"]), sets.to_array(F.lit("b,a,b")))
    assert got == [None, 0, 0, 2, "a,b", None, "a", ["a", "b"]]
    with pytest.raises(ValueError):
        sets.set_literal(["z"], ["a"])
    with pytest.raises(ValueError):
        sets.set_literal([], [str(i) for i in range(65)])


def test_dates():
    assert dates.pattern("%Y-%m-%d at %H:%i") == "yyyy-MM-dd 'at' HH:mm"
    with pytest.raises(ValueError):
        dates.pattern("%Q")


def test_json(spark):
    d = F.lit('{"a":{"b":[1,"x",null]},"n":"John"}')
    got = one(spark, json.extract(d, "$.n"), json.unquote(d, "$.n"), json.extract(d, "$.a.b", "$.n"), json.extract(d, "$.zz"), json.type_(F.lit("null")), json.valid(F.lit("{")), json.valid(F.lit(None).cast("string")))
    assert got == ['"John"', "John", '[[1,"x",null],"John"]', None, "NULL", False, None]
    edits = one(spark, json.set_(d, ("$.a.b[1]", F.lit("2"))), json.remove(d, "$.a.b[0]", "$.n"), json.insert(d, ("$.x.y", F.lit("1"))), json.set_(F.lit("{oops"), ("$.a", F.lit("1"))))
    assert edits == ['{"a":{"b":[1,2,null]},"n":"John"}', '{"a":{"b":["x",null]}}', '{"a":{"b":[1,"x",null]},"n":"John"}', None]
    search = one(spark, json.search(d, "J%"), json.search(F.lit('["ab",{"k":"ab"}]'), "a_", True), json.search(d, "none"))
    assert search == ['"$.n"', '["$[0]","$[1].k"]', None]
    has = one(spark, *[json.contains(F.lit(a), F.lit(b)) for a, b in (("[1,2,[3]]", "[2,3]"), ("[1,2]", "2"), ('{"a":1,"b":2}', '{"b":2}'), ('{"a":1}', '{"a":2}'), ("true", "1"))])
    assert has == [True, True, True, False, False]
    with pytest.raises(ValueError):
        json.remove(d, "$.a[*]")


def test_vector(spark):
    got = one(spark, vector.euclidean(vector.literal([0, 3]), vector.literal([4, 0])), vector.cosine(vector.literal([0, 0]), vector.literal([1, 0])), vector.dim(vector.from_string(F.lit("[1,2]"))), vector.dim(F.lit(None).cast("array<float>")))
    assert got == [5.0, None, 2, None]
    with pytest.raises(ValueError):
        vector.literal([0.0] * 16_385)


def test_spatial(spark):
    g = lambda w: spatial.from_text(F.lit(w))
    square = g("POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,2 1,2 2,1 2,1 1))")
    got = one(
        spark, spatial.distance(g("POINT(0 0)"), g("POINT(3 4)")), spatial.within(g("POINT(3 3)"), square), spatial.within(g("POINT(1.5 1.5)"), square), spatial.contains(square, g("LINESTRING(3 3,3 1)")), spatial.intersects(g("LINESTRING(-1 2,5 2)"), square),
        spatial.distance(g("POINT(7 2)"), square), spatial.as_text(square), spatial.as_geojson(g("POINT(1 2)")), spatial.from_text(F.lit("nothing")), spatial.srid(spatial.from_text(F.lit("POINT(1 1)"), 4326)),
    )
    assert got == [5.0, True, False, True, True, 3.0, "POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,2 1,2 2,1 2,1 1))", '{"type":"Point","coordinates":[1.0,2.0]}', None, 4326]


def test_shift_counts_from_a_column(spark):
    from pyspark.sql import functions as F

    from sparkloom.functions import bitwise

    rows = [(1, 3), (-1, 63), (5, 64), (5, -1), (None, 1), (5, None), (8, 0)]
    df = spark.createDataFrame(rows, "x bigint, n int")
    got = df.select(bitwise.shift_left(F.col("x"), F.col("n")).alias("l"), bitwise.shift_right(F.col("x"), F.col("n")).alias("r")).collect()
    assert [(r.l, r.r) for r in got] == [(8, 0), (-(1 << 63), 1), (0, 0), (0, 0), (None, None), (None, None), (8, 8)]


MULTI = {
    "MULTIPOINT((1 2),(3 4))": '{"type":"MultiPoint","coordinates":[[1.0,2.0],[3.0,4.0]]}',
    "MULTILINESTRING((0 0,1 1),(2 2,3 3,4 4))": '{"type":"MultiLineString","coordinates":[[[0.0,0.0],[1.0,1.0]],[[2.0,2.0],[3.0,3.0],[4.0,4.0]]]}',
    "MULTIPOLYGON(((0 0,4 0,4 4,0 0),(1 1,2 1,2 2,1 1)),((8 8,9 8,9 9,8 8)))": '{"type":"MultiPolygon","coordinates":[[[[0.0,0.0],[4.0,0.0],[4.0,4.0],[0.0,0.0]],[[1.0,1.0],[2.0,1.0],[2.0,2.0],[1.0,1.0]]],[[[8.0,8.0],[9.0,8.0],[9.0,9.0],[8.0,8.0]]]]}',
}


@pytest.mark.parametrize("wkt", MULTI)
def test_spatial_multiples(spark, wkt):
    g = spatial.from_text(F.lit(wkt))
    assert one(spark, spatial.as_text(g), spatial.as_geojson(g)) == [wkt, MULTI[wkt]]
    assert one(spark, spatial.as_text(spatial.from_text(F.lit("MULTIPOINT(1 2, 3 4)")))) == ["MULTIPOINT((1 2),(3 4))"]


def test_spatial_multipolygon_relations(spark):
    g = spatial.from_text(F.lit("MULTIPOLYGON(((0 0,4 0,4 4,0 4,0 0),(1 1,2 1,2 2,1 2,1 1)),((8 8,9 8,9 9,8 9,8 8)))"))
    at = lambda x, y: spatial.point(F.lit(x), F.lit(y))
    assert one(spark, spatial.within(at(3, 3), g), spatial.within(at(1.5, 1.5), g), spatial.intersects(at(8.5, 8.5), g), spatial.distance(at(8.5, 7), g)) == [True, False, True, 1.0]


def test_spatial_binary_forms(spark):
    point = lambda x, y: struct.pack("<BI2d", 1, 1, x, y)
    ring = struct.pack("<I6d", 3, 0, 0, 1, 0, 0, 0)
    polygon = struct.pack("<BII", 1, 3, 1) + ring
    forms = {
        point(1, 2): "POINT(1 2)",
        struct.pack("<BII", 1, 4, 2) + point(1, 2) + point(3, 4): "MULTIPOINT((1 2),(3 4))",
        struct.pack(">BII", 0, 6, 2) + polygon + polygon: "MULTIPOLYGON(((0 0,1 0,0 0)),((0 0,1 0,0 0)))",
        struct.pack("<BII", 1, 5, 1) + point(1, 2): None,  # a point among lines
        struct.pack("<BII", 1, 7, 0): None,
        b"": None,
        point(1, 2)[:-1]: None,
    }
    got = spark.createDataFrame([(bytearray(b),) for b in forms], "b binary").select("b", spatial.as_text(spatial.from_wkb(F.col("b")))).collect()
    assert {bytes(r[0]): r[1] for r in got} == forms
