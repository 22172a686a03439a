"""Planar geometry as struct<type, srid, parts, rings>.

Each part is a list of points: a ring, a line or a single point. ``rings`` has the number of rings of each polygon of a
MULTIPOLYGON, and is NULL for other types."""

from __future__ import annotations

import struct

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

GEOMETRY = "struct<type:string,srid:int,parts:array<array<struct<x:double,y:double>>>,rings:array<int>>"
# Types by their number in the binary form, and names in GeoJSON.
_TYPES = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT", 5: "MULTILINESTRING", 6: "MULTIPOLYGON"}
_NAMES = {"POINT": "Point", "LINESTRING": "LineString", "POLYGON": "Polygon", "MULTIPOINT": "MultiPoint", "MULTILINESTRING": "MultiLineString", "MULTIPOLYGON": "MultiPolygon"}


def from_text(wkt: Column, srid: int = 0) -> Column:
    """Points, lines, polygons and multiples of one of these; text of another form is NULL, collections of mixed types too."""
    kind = F.upper(F.regexp_extract(wkt, r"^\s*([A-Za-z]+)\s*\(", 1))

    def point(text: Column) -> Column:
        xy = F.split(F.btrim(text), r"\s+")
        return F.struct(F.get(xy, F.lit(0)).cast("double").alias("x"), F.get(xy, F.lit(1)).cast("double").alias("y"))

    parts = F.transform(F.regexp_extract_all(wkt, F.lit(r"\(([^()]+)\)"), F.lit(1)), lambda p: F.transform(F.split(p, ","), point))
    parts = F.when(kind == "MULTIPOINT", F.transform(F.flatten(parts), lambda c: F.array(c))).otherwise(parts)
    polygons = F.split(wkt, r"\)\s*\)\s*,\s*\(\s*\(")
    rings = F.when(kind == "MULTIPOLYGON", F.transform(polygons, lambda p: F.regexp_count(p, F.lit(r"[-+.\d][^(),]*(,[^(),]*)*"))))
    return F.when(kind.isin(*_NAMES), F.struct(kind.alias("type"), F.lit(srid).alias("srid"), parts.alias("parts"), rings.alias("rings")).cast(GEOMETRY))


def from_wkb(wkb: Column, srid: int = 0) -> Column:
    """Points, lines, polygons and multiples of one of these in the binary form, decoded in Arrow batches; other bytes give NULL."""

    def decode(b: bytes) -> dict:
        at, order = 0, "<"

        def points(n: int) -> list:
            nonlocal at
            xy = struct.unpack_from(f"{order}{2 * n}d", b, at)
            at += 16 * n
            return [{"x": x, "y": y} for x, y in zip(xy[::2], xy[1::2], strict=True)]

        def number() -> int:
            nonlocal at
            at += 4
            return struct.unpack_from(order + "I", b, at - 4)[0]

        def shape() -> tuple[str, list, list[int] | None]:
            nonlocal at, order
            order = "<" if b[at] else ">"
            at += 1
            kind = _TYPES[number()]
            if kind == "POINT":
                return kind, [points(1)], None
            if kind == "LINESTRING":
                return kind, [points(number())], None
            if kind == "POLYGON":
                return kind, [points(number()) for _ in range(number())], None
            inner = [shape() for _ in range(number())]
            if any(f"MULTI{i[0]}" != kind for i in inner):
                raise ValueError(f"{kind} of other types")
            return kind, [p for i in inner for p in i[1]], [len(i[1]) for i in inner] if kind == "MULTIPOLYGON" else None

        kind, parts, rings = shape()
        return {"type": kind, "srid": srid, "parts": parts, "rings": rings}

    def decoded(b: bytes | None) -> dict | None:
        try:
            return None if b is None else decode(b)
        except (struct.error, IndexError, KeyError, ValueError):
            return None

    xy = pa.struct([("x", pa.float64()), ("y", pa.float64())])
    shape = pa.struct([("type", pa.string()), ("srid", pa.int32()), ("parts", pa.list_(pa.list_(xy))), ("rings", pa.list_(pa.int32()))])

    @F.arrow_udf(GEOMETRY)
    def over(batch: pa.Array) -> pa.Array:
        return pa.array([decoded(b) for b in batch.to_pylist()], shape)

    return over(wkb)


def _number(x: Column) -> Column:
    return F.when(x == F.floor(x), F.floor(x).cast("string")).otherwise(x.cast("string"))


def _polygons(g: Column) -> Column:
    """The parts, by polygon."""

    def of(h: Column) -> Column:
        before = lambda i: F.aggregate(F.slice(h["rings"], F.lit(1), i), F.lit(0), lambda a, n: a + n)
        return F.transform(h["rings"], lambda n, i: F.slice(h["parts"], before(i) + 1, n))

    # Bound once, as geometries may come from Python, which inner functions can't call.
    return F.get(F.transform(F.array(g), of), F.lit(0))


def as_text(g: Column) -> Column:
    part = lambda p: F.array_join(F.transform(p, lambda c: F.concat(_number(c["x"]), F.lit(" "), _number(c["y"]))), ",")
    flat = F.concat(g["type"], F.lit("("), part(F.get(g["parts"], F.lit(0))), F.lit(")"))
    listed = lambda parts: F.concat(F.lit("(("), F.array_join(F.transform(parts, part), "),("), F.lit("))"))
    polygons = F.concat(g["type"], F.lit("("), F.array_join(F.transform(_polygons(g), listed), ","), F.lit(")"))
    return F.when(g["type"].isin("POINT", "LINESTRING"), flat).when(g["type"] == "MULTIPOLYGON", polygons).otherwise(F.concat(g["type"], listed(g["parts"])))


def as_geojson(g: Column) -> Column:
    pair = lambda c: F.concat(F.lit("["), c["x"].cast("string"), F.lit(","), c["y"].cast("string"), F.lit("]"))
    part = lambda p: F.concat(F.lit("["), F.array_join(F.transform(p, pair), ","), F.lit("]"))
    first = F.get(g["parts"], F.lit(0))
    listed = lambda parts: F.concat(F.lit("["), F.array_join(F.transform(parts, part), ","), F.lit("]"))
    polygons = F.concat(F.lit("["), F.array_join(F.transform(_polygons(g), listed), ","), F.lit("]"))
    inner = F.when(g["type"] == "POINT", pair(F.get(first, F.lit(0)))).when(g["type"] == "LINESTRING", part(first)).when(g["type"] == "MULTIPOINT", part(F.flatten(g["parts"])))
    inner = inner.when(g["type"] == "MULTIPOLYGON", polygons).otherwise(listed(g["parts"]))
    name = F.create_map(*[F.lit(x) for item in _NAMES.items() for x in item])[g["type"]]
    return F.concat(F.lit('{"type":"'), name, F.lit('","coordinates":'), inner, F.lit("}"))


def srid(g: Column) -> Column:
    return g["srid"]


def point(x: Column, y: Column, srid: int = 0) -> Column:
    return F.struct(F.lit("POINT").alias("type"), F.lit(srid).alias("srid"), F.array(F.array(F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))).alias("parts"), F.lit(None).cast("array<int>").alias("rings"))


def _edges(g: Column) -> Column:
    """Segments of all parts; a lone point is a segment to itself."""

    def of(p: Column) -> Column:
        n = F.size(p)
        two = F.transform(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), lambda i: F.struct(F.get(p, i).alias("a"), F.get(p, F.least(i + 1, n - 1)).alias("b")))
        return two

    return F.flatten(F.transform(g["parts"], of))


def _points(g: Column) -> Column:
    return F.flatten(g["parts"])


def _inside(c: Column, g: Column) -> Column:
    """Whether a ray from the point crosses the polygon's edges an odd number of times."""
    crossed = F.filter(_edges(g), lambda e: ((e["a"]["y"] > c["y"]) != (e["b"]["y"] > c["y"])) & (c["x"] < F.try_divide((e["b"]["x"] - e["a"]["x"]) * (c["y"] - e["a"]["y"]), e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]))
    return F.size(crossed) % 2 == 1


def within(a: Column, b: Column) -> Column:
    """All points of ``a`` are inside the polygon ``b``."""
    return F.forall(_points(a), lambda c: _inside(c, b))


def contains(a: Column, b: Column) -> Column:
    return within(b, a)


def _turn(a: Column, b: Column, c: Column) -> Column:
    return F.signum((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"]))


def _on(a: Column, b: Column, c: Column) -> Column:
    return (F.least(a["x"], b["x"]) <= c["x"]) & (c["x"] <= F.greatest(a["x"], b["x"])) & (F.least(a["y"], b["y"]) <= c["y"]) & (c["y"] <= F.greatest(a["y"], b["y"]))


def _cross(e: Column, f: Column) -> Column:
    t = [_turn(e["a"], e["b"], f["a"]), _turn(e["a"], e["b"], f["b"]), _turn(f["a"], f["b"], e["a"]), _turn(f["a"], f["b"], e["b"])]
    touch = (t[0] == 0) & _on(e["a"], e["b"], f["a"]) | (t[1] == 0) & _on(e["a"], e["b"], f["b"]) | (t[2] == 0) & _on(f["a"], f["b"], e["a"]) | (t[3] == 0) & _on(f["a"], f["b"], e["b"])
    return (t[0] * t[1] < 0) & (t[2] * t[3] < 0) | touch


def _box(g: Column) -> dict[str, Column]:
    xs, ys = F.transform(_points(g), lambda c: c["x"]), F.transform(_points(g), lambda c: c["y"])
    return {"x0": F.array_min(xs), "x1": F.array_max(xs), "y0": F.array_min(ys), "y1": F.array_max(ys)}


def intersects(a: Column, b: Column) -> Column:
    """They share a point: boxes first, then crossing edges, then one inside the other."""
    p, q = _box(a), _box(b)
    near = (p["x0"] <= q["x1"]) & (q["x0"] <= p["x1"]) & (p["y0"] <= q["y1"]) & (q["y0"] <= p["y1"])
    crossing = F.exists(_edges(a), lambda e: F.exists(_edges(b), lambda f: _cross(e, f)))
    areas = ("POLYGON", "MULTIPOLYGON")
    inner = b["type"].isin(*areas) & F.exists(_points(a), lambda c: _inside(c, b)) | a["type"].isin(*areas) & F.exists(_points(b), lambda c: _inside(c, a))
    return near & (crossing | inner)


def _to_edge(c: Column, e: Column) -> Column:
    dx, dy = e["b"]["x"] - e["a"]["x"], e["b"]["y"] - e["a"]["y"]
    t = F.coalesce(F.try_divide((c["x"] - e["a"]["x"]) * dx + (c["y"] - e["a"]["y"]) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    return F.hypot(c["x"] - (e["a"]["x"] + t * dx), c["y"] - (e["a"]["y"] + t * dy))


def distance(a: Column, b: Column) -> Column:
    """Least distance; zero where they share a point."""
    one = lambda p, q: F.array_min(F.transform(_points(p), lambda c: F.array_min(F.transform(_edges(q), lambda e: _to_edge(c, e)))))
    apart = F.least(one(a, b), one(b, a))
    both = (a["type"] == "POINT") & (b["type"] == "POINT")
    return F.when(both, apart).when(intersects(a, b), F.lit(0.0)).otherwise(apart)
