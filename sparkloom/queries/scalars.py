"""Numeric, bitwise, JSON, set, date and geometry functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bitwise as b
from ..functions import dates, json, sets, spatial
from ..functions import math as m
from ..operators.json_table import Field, Nested, json_table
from .base import query, table


@query("""SELECT o_orderkey, round(o_totalprice, 1) AS r1, round(o_totalprice, -2) AS r2, ceil(o_totalprice)::BIGINT AS c, floor(o_totalprice)::BIGINT AS f, trunc(o_totalprice)::DOUBLE AS t,
  CASE WHEN o_orderkey % 7 - 3 >= 0 THEN round(sqrt(o_orderkey % 7 - 3), 9) END AS s, pow(o_custkey % 10, 2)::DOUBLE AS p, CASE WHEN o_custkey % 3 <> 0 THEN o_orderkey % (o_custkey % 3) END AS md,
  CASE WHEN nullif(o_custkey % 5, 0) IS NOT NULL THEN greatest(o_custkey % 5, 2, o_orderkey % 4) END AS g, CASE WHEN nullif(o_custkey % 5, 0) IS NOT NULL THEN least(o_custkey % 5, 2, o_orderkey % 4) END AS l FROM orders""")
def math_functions(spark, sf_dir):
    c = F.col
    price, five = c("o_totalprice"), F.nullif(c("o_custkey") % 5, F.lit(0).cast("bigint"))
    four, two = c("o_orderkey") % 4, F.lit(2).cast("bigint")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", m.round_(price, 1).alias("r1"), m.round_(price, -2).alias("r2"), m.ceil(price).alias("c"), m.floor(price).alias("f"), m.truncate(price).alias("t"), F.round(m.sqrt(c("o_orderkey") % 7 - 3), 9).alias("s"),
        m.power(c("o_custkey") % 10, 2).alias("p"), m.mod(c("o_orderkey"), c("o_custkey") % 3).alias("md"), m.greatest(five, two, four).alias("g"), m.least(five, two, four).alias("l"),
    )


@query("""SELECT c_custkey, c_custkey & 12 & 7 AS a, c_custkey | 8 AS o, xor(c_custkey, 255) AS x, bit_count(c_custkey)::INT AS n, ((c_custkey >> 3) & 1)::INT AS g,
  c_custkey << 4 AS l, c_custkey >> 2 AS r, 0::BIGINT AS z FROM customer""")
def bitwise_functions(spark, sf_dir):
    k, lit = F.col("c_custkey"), lambda n: F.lit(n).cast("bigint")
    return table(spark, sf_dir, "customer").select(
        k, b.bit_and(k, lit(12), lit(7)).alias("a"), b.bit_or(k, lit(8)).alias("o"), b.bit_xor(k, lit(255)).alias("x"), b.bit_count(k).alias("n"), b.get_bit(k, 3).alias("g"), b.shift_left(k, 4).alias("l"), b.shift_right(k, 2).alias("r"), b.shift_left(k, 64).alias("z")
    )


@query("""SELECT o_orderkey, list_position(['1-URGENT', '2-HIGH', '3-MEDIUM'], o_orderpriority)::BIGINT AS i, ['low', 'mid', 'high'][(o_orderkey % 5)::INT] AS e,
  coalesce(list_position(['5-LOW', '1-URGENT'], o_orderpriority), 0)::BIGINT AS f, o_orderstatus IN ('F', 'P') AS fp FROM orders""")
def enum_set_functions(spark, sf_dir):
    p = F.col("o_orderpriority")
    index = sets.enum_index(p, ["1-URGENT", "2-HIGH", "3-MEDIUM"])
    return table(spark, sf_dir, "orders").select("o_orderkey", index.alias("i"), sets.elt((F.col("o_orderkey") % 5).cast("int"), "low", "mid", "high").alias("e"), sets.field(p, "5-LOW", "1-URGENT").alias("f"), (sets.find_in_set(F.col("o_orderstatus"), F.lit("F,P")) > 0).alias("fp"))


@query("""SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds, bool_or(event_type = 'view') AND bool_or(event_type = 'click') AS both FROM events GROUP BY user_id""")
def set_membership(spark, sf_dir):
    kinds = F.array_join(F.array_sort(F.collect_set("event_type")), ",")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(kinds.alias("kinds")).withColumn("both", sets.contains_all(F.col("kinds"), ["view", "click"]))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%H:%M:%S') AS t, strftime(ts, '%d/%m/%y') AS s, year(ts)::INT AS y, datediff('day', ts::DATE, DATE '2024-12-31')::INT AS left_ FROM events")
def date_functions(spark, sf_dir):
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select("event_id", dates.date_format(ts, "%Y-%m-%d").alias("d"), dates.date_format(ts, "%H:%i:%s").alias("t"), dates.date_format(ts, "%d/%m/%y").alias("s"), F.year(ts).alias("y"), F.date_diff(F.lit("2024-12-31").cast("date"), ts).alias("left_"))


@query("SELECT true AS has_date, true AS has_time, 36 AS uuid_length, true AS has_database")
def session_functions(spark, sf_dir):
    return spark.range(1).select((F.current_date().isNotNull()).alias("has_date"), F.current_timestamp().isNotNull().alias("has_time"), F.length(F.uuid()).alias("uuid_length"), F.current_database().isNotNull().alias("has_database"))


@query("SELECT upper(n_name) AS u, concat(n_name, '-', n_regionkey) AS c, reverse(n_name) AS r, length(n_name) AS l FROM nation")
def call_by_name(spark, sf_dir):
    n = F.col("n_name")
    return table(spark, sf_dir, "nation").select(F.call_function("upper", n).alias("u"), F.call_function("concat", n, F.lit("-"), F.col("n_regionkey")).alias("c"), F.call_function("reverse", n).alias("r"), F.call_function("length", n).cast("bigint").alias("l"))


_DOC = "to_json({id: o_orderkey, status: o_orderstatus, tags: [o_orderstatus, o_orderpriority], who: {c: o_custkey}})"


def _docs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.array("o_orderstatus", "o_orderpriority").alias("tags"), F.struct(F.col("o_custkey").alias("c")).alias("who"))).alias("doc"))


@query(f"""SELECT o_orderkey, json_extract(d, '$.status')::VARCHAR AS quoted, json_extract_string(d, '$.status') AS bare, json_extract(d, '$.who')::VARCHAR AS who, json_extract_string(d, '$.tags[1]') AS tag,
  '[' || o_orderkey || ',' || o_custkey || ']' AS two FROM (SELECT *, {_DOC} AS d FROM orders)""")
def json_extract(spark, sf_dir):
    d = F.col("doc")
    return _docs(spark, sf_dir).select("o_orderkey", json.extract(d, "$.status").alias("quoted"), json.unquote(d, "$.status").alias("bare"), json.extract(d, "$.who").alias("who"), json.unquote(d, "$.tags[1]").alias("tag"), json.extract(d, "$.id", "$.who.c").alias("two"))


@query("""SELECT c_custkey, '{"k":' || c_custkey || ',"seg":"' || c_mktsegment || '","none":null}' AS o, '[' || c_custkey || ',"' || c_mktsegment || '",null]' AS a FROM customer""")
def json_build(spark, sf_dir):
    k, seg, none = F.col("c_custkey"), F.col("c_mktsegment"), F.lit(None).cast("string")
    return table(spark, sf_dir, "customer").select(k, json.object_(k=k, seg=seg, none=none).alias("o"), json.array_(k, seg, none).alias("a"))


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'OBJECT' WHEN 1 THEN 'INTEGER' WHEN 2 THEN 'STRING' WHEN 3 THEN 'ARRAY' WHEN 4 THEN NULL ELSE 'BOOLEAN' END AS kind, event_id % 6 <> 4 AS ok FROM events""")
def json_type_valid(spark, sf_dir):
    doc = F.element_at(F.array(F.col("props"), F.lit("12"), F.lit('"x"'), F.lit("[1,2]"), F.lit("{oops"), F.lit("true")), (F.col("event_id") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", json.type_(doc).alias("kind"), json.valid(doc).alias("ok"))


@query("""SELECT event_id, '{"k":1,"t":"x"}' AS set_, '{"k":' || k || ',"n":0}' AS ins, '{"k":1}' AS rep, '{}' AS rem, '{"a":{"b":2}}' AS merged, k = 7 AS seven FROM (SELECT event_id, json_extract_string(props, '$.k')::INT AS k FROM events)""")
def json_edit(spark, sf_dir):
    p, lit = F.col("props"), F.lit
    return table(spark, sf_dir, "events").select(
        "event_id", json.set_(p, ("$.k", lit("1")), ("$.t", lit('"x"'))).alias("set_"), json.insert(p, ("$.k", lit("1")), ("$.n", lit("0"))).alias("ins"), json.replace(p, ("$.k", lit("1")), ("$.n", lit("0"))).alias("rep"), json.remove(p, "$.k").alias("rem"),
        json.merge_patch(p, lit('{"k":null,"a":{"b":2}}')).alias("merged"), json.contains(p, lit('{"k":7}')).alias("seven"),
    )


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '["$.status","$.tags[0]"]' END AS all_, CASE o_orderstatus WHEN 'F' THEN '"$.status"' END AS one FROM orders""")
def json_search(spark, sf_dir):
    return _docs(spark, sf_dir).select("o_orderkey", json.search(F.col("doc"), "F", True).alias("all_"), json.search(F.col("doc"), "F").alias("one"))


@query("SELECT o_orderkey, ['id', 'status', 'tags', 'who']::VARCHAR AS keys FROM orders")
def json_keys(spark, sf_dir):
    return _docs(spark, sf_dir).select("o_orderkey", F.concat(F.lit("["), F.concat_ws(", ", json.keys(F.col("doc"))), F.lit("]")).alias("keys"))


def _order_items(li):
    items = F.array_sort(F.collect_list(F.struct(F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_quantity").alias("qty"))))
    docs = li.groupBy("l_orderkey").agg(F.to_json(F.struct(items.alias("items"))).alias("doc"))
    fields = [Field("n", ordinality=True), Field("part", "bigint", "$.part"), Field("qty", "double", "$.qty"), Field("has_qty", path="$.qty", exists=True), Field("has_gift", path="$.gift", exists=True), Field("gift", "int", "$.gift", on_error="default", default=-1)]
    return json_table(docs, "doc", "$.items[*]", fields).drop("doc")


@query("""SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)::INT AS n, l_partkey AS part, l_quantity AS qty, 1 AS has_qty, 0 AS has_gift, -1 AS gift FROM lineitem""")
def json_table_items(spark, sf_dir):
    return _order_items(table(spark, sf_dir, "lineitem"))


@query("""SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity)::INT AS n, l_partkey AS part, l_quantity AS qty, 1 AS has_qty, 0 AS has_gift, -1 AS gift FROM lineitem""")
def json_table_items_whole(spark, sf_dir):
    return _order_items(table(spark, sf_dir, "lineitem"))


@query("""SELECT r_name, n_name, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey)::INT AS n FROM region JOIN nation ON n_regionkey = r_regionkey""")
def json_table_nested(spark, sf_dir):
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    inner = F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))))
    docs = n.groupBy("r_name").agg(F.to_json(F.struct(F.array(F.struct(inner.alias("nations"))).alias("regions"))).alias("doc"))
    return json_table(docs, "doc", "$.regions[*]", [Nested("$.nations[*]", [Field("n_name", "string", "$.name"), Field("n", ordinality=True)])]).drop("doc")


@query("""SELECT s_suppkey, 'POINT(' || x || ' ' || y || ')' AS wkt, '{"type":"Point","coordinates":[' || x || '.0,' || y || '.0]}' AS geo, 4326 AS srid, round(sqrt(pow(x - 3, 2) + pow(y - 4, 2)), 6) AS d,
  x > 0 AND x < 10 AND y > 0 AND y < 10 AS inside FROM (SELECT s_suppkey, s_suppkey % 17 + 1 AS x, s_suppkey % 13 + 1 AS y FROM supplier) WHERE x <> 10 AND y <> 10""")
def spatial_points(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 17 + 1).alias("x"), (F.col("s_suppkey") % 13 + 1).alias("y")).where("x <> 10 AND y <> 10")
    g = s.select("s_suppkey", spatial.from_text(F.concat(F.lit("POINT("), "x", F.lit(" "), "y", F.lit(")")), 4326).alias("g"))
    square = spatial.from_text(F.lit("POLYGON((0 0,10 0,10 10,0 10,0 0))"))
    p = F.col("g")
    return g.select("s_suppkey", spatial.as_text(p).alias("wkt"), spatial.as_geojson(p).alias("geo"), spatial.srid(p).alias("srid"), F.round(spatial.distance(p, spatial.point(F.lit(3), F.lit(4))), 6).alias("d"), spatial.within(p, square).alias("inside"))


@query("""SELECT s_suppkey, x < 10 AND x + 2 > 0 AND y < 10 AND y + 2 > 0 AS meets, round(sqrt(pow(greatest(x - 10, 0), 2) + pow(greatest(y - 10, 0), 2)), 6) AS apart, x < 7 AND y < 7 AS held
  FROM (SELECT s_suppkey, s_suppkey % 19 + 0.5 AS x, s_suppkey % 11 + 0.5 AS y FROM supplier)""")
def spatial_squares(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 19 + F.lit(0.5)).alias("x"), (F.col("s_suppkey") % 11 + F.lit(0.5)).alias("y"))
    x, y = F.col("x"), F.col("y")
    corner = lambda a, c: F.concat((x + a).cast("string"), F.lit(" "), (y + c).cast("string"))
    wkt = F.concat(F.lit("POLYGON(("), F.concat_ws(",", corner(0, 0), corner(2, 0), corner(2, 2), corner(0, 2), corner(0, 0)), F.lit("))"))
    big = spatial.from_text(F.lit("POLYGON((0 0,10 0,10 10,0 10,0 0))"))
    held = spatial.from_text(F.lit("POLYGON((0 0,9.2 0,9.2 9.2,0 9.2,0 0))"))
    g = s.select("s_suppkey", spatial.from_text(wkt).alias("g"))
    return g.select("s_suppkey", spatial.intersects(F.col("g"), big).alias("meets"), F.round(spatial.distance(F.col("g"), big), 6).alias("apart"), spatial.contains(held, F.col("g")).alias("held"))


@query("SELECT s_suppkey, 'POINT(' || s_suppkey || ' ' || s_nationkey || ')' AS wkt FROM supplier")
def spatial_binary(spark, sf_dir):
    # The binary form of a point: byte order, kind, two doubles (built here from their big-endian bits).
    s = table(spark, sf_dir, "supplier")

    @F.arrow_udf("binary")
    def encode(x, y):
        import struct

        import pyarrow as pa

        return pa.array([struct.pack(">BI2d", 0, 1, a, c) for a, c in zip(x.to_pylist(), y.to_pylist(), strict=True)], pa.binary())

    return s.select("s_suppkey", spatial.as_text(spatial.from_wkb(encode(F.col("s_suppkey").cast("double"), F.col("s_nationkey").cast("double")))).alias("wkt"))
