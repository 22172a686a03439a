"""Scans, filters, joins, groups, sorting, set operations and common tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import relational as rel
from ..operators.model import Model
from ..sources import tables
from .base import query, table, total


@query("""SELECT l_returnflag, l_linestatus, sum(l_quantity::DECIMAL(18,2))::DOUBLE AS sum_qty, sum(l_extendedprice::DECIMAL(18,2))::DOUBLE AS sum_price,
  round(avg(l_quantity), 6) AS avg_qty, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL ORDER BY ALL""")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    grouped = li.groupBy("l_returnflag", "l_linestatus").agg(total("l_quantity").alias("sum_qty"), total("l_extendedprice").alias("sum_price"), F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.count(F.lit(1)).alias("n"))
    return grouped.orderBy("l_returnflag", "l_linestatus")


@query("SELECT o.o_orderkey, o.o_totalprice AS price FROM orders o")
def scan_table(spark, sf_dir):
    o = table(spark, sf_dir, "orders").alias("o")
    return o.select("o.o_orderkey", F.col("o.o_totalprice").alias("price"))


@query("SELECT 1 + 1 AS two, 'x' AS letter")
def scan_no_table(spark, sf_dir):
    return tables.no_table(spark, (F.lit(1) + 1).alias("two"), F.lit("x").alias("letter"))


@query("SELECT * FROM (VALUES (1, 'a'), (2, 'b'), (3, NULL)) v(id, name)")
def scan_values(spark, sf_dir):
    return tables.values(spark, [(1, "a"), (2, "b"), (3, None)], "id int, name string")


@query("SELECT o_orderkey FROM orders WHERE o_totalprice > 300000 AND o_orderstatus = 'F'")
def scan_raw_sql(spark, sf_dir):
    return spark.sql("SELECT o_orderkey FROM {o} WHERE o_totalprice > ? AND o_orderstatus = ?", args=[300000, "F"], o=table(spark, sf_dir, "orders"))


@query("SELECT n_name, r_name FROM nation, region WHERE n_regionkey = r_regionkey")
def scan_comma_list(spark, sf_dir):
    return rel.comma_join(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("SELECT c, count(*) AS n FROM (SELECT o_custkey % 10 AS c FROM orders WHERE o_totalprice > 100000) t GROUP BY c")
def scan_derived_table(spark, sf_dir):
    t = table(spark, sf_dir, "orders").where("o_totalprice > 100000").select((F.col("o_custkey") % 10).alias("c"))
    return t.groupBy("c").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal > 0")
def scan_view(spark, sf_dir):
    table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).createOrReplaceTempView("solvent")
    return spark.table("solvent")


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("SELECT * FROM region")
def wildcard(spark, sf_dir):
    return table(spark, sf_dir, "region").select("*")


@query("""SELECT p_partkey FROM part WHERE p_name LIKE '%ring%' AND p_size BETWEEN 5 AND 25 AND p_brand IN ('Brand#2', 'Brand#17')
  OR regexp_matches(p_name, '^blue .*t$') AND NOT p_size <> 10""")
def predicates(spark, sf_dir):
    c = F.col
    like = c("p_name").like("%ring%") & c("p_size").between(5, 25) & c("p_brand").isin("Brand#2", "Brand#17")
    return table(spark, sf_dir, "part").where(like | c("p_name").rlike("^blue .*t$") & ~(c("p_size") != 10)).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE p_name ILIKE '%RING%'")
def predicate_case_insensitive(spark, sf_dir):
    return table(spark, sf_dir, "part").where(F.col("p_name").ilike("%RING%")).select("p_partkey")


@query("SELECT o_orderkey, n IS NULL AS no_lines, coalesce(n, 0) AS n, nullif(o_orderstatus, 'P') AS done FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def predicate_null(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    j = table(spark, sf_dir, "orders").join(n, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return j.select("o_orderkey", F.col("n").isNull().alias("no_lines"), F.coalesce("n", F.lit(0)).alias("n"), F.nullif("o_orderstatus", F.lit("P")).alias("done"))


@query("SELECT c_custkey FROM customer WHERE c_acctbal > (SELECT avg(c_acctbal) FROM customer)")
def predicate_scalar_subquery(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return spark.sql("SELECT c_custkey FROM {c} WHERE c_acctbal > (SELECT avg(c_acctbal) FROM {c})", c=c)


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def predicate_exists(spark, sf_dir):
    big = table(spark, sf_dir, "orders").where("o_totalprice > 400000")
    return table(spark, sf_dir, "customer").join(big, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def predicate_not_in(spark, sf_dir):
    return rel.not_in(table(spark, sf_dir, "customer"), "c_custkey", table(spark, sf_dir, "orders"), "o_custkey").select("c_custkey")


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge, l_linenumber % 3 AS m, l_extendedprice / nullif(l_linenumber - 1, 0) AS q FROM lineitem")
def arithmetic(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(c("l_extendedprice") * (1 - c("l_discount")) * (1 + c("l_tax")), 6).alias("charge"), (c("l_linenumber") % 3).alias("m"), F.try_divide("l_extendedprice", c("l_linenumber") - 1).alias("q")
    )


@query("SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 200000")
def join_inner(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_totalprice > 200000")
    return o.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_name", "n_name")


@query("SELECT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def join_theta(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.alias("a").join(n.alias("b"), F.expr("a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")).select(F.col("a.n_name").alias("a"), F.col("b.n_name").alias("b"))


def _outer(how: str):
    """Keys are shifted, so that both sides have rows without a match."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
        return c.join(o, F.col("c_custkey") == F.col("o_custkey") + 40, how).select("c_custkey", "o_orderkey")

    return run


for _how in ("left", "right", "full"):
    query(
        f"SELECT c_custkey, o_orderkey FROM customer {_how.upper()} JOIN orders ON c_custkey = o_custkey + 40",
        f"join_{_how}",
    )(_outer(_how))


@query("SELECT r_name, n_name FROM region CROSS JOIN nation")
def join_cross(spark, sf_dir):
    return table(spark, sf_dir, "region").crossJoin(table(spark, sf_dir, "nation")).select("r_name", "n_name")


@query("SELECT k, a, b FROM (SELECT n_regionkey AS k, n_name AS a FROM nation) NATURAL JOIN (SELECT r_regionkey AS k, r_name AS b FROM region)")
def join_natural(spark, sf_dir):
    return rel.natural_join(table(spark, sf_dir, "nation").selectExpr("n_regionkey AS k", "n_name AS a"), table(spark, sf_dir, "region").selectExpr("r_regionkey AS k", "r_name AS b")).select("k", "a", "b")


@query("SELECT n_name, t.c_custkey, t.c_acctbal FROM nation, LATERAL (SELECT c_custkey, c_acctbal FROM customer WHERE c_nationkey = n_nationkey ORDER BY c_acctbal DESC, c_custkey LIMIT 2) t")
def join_lateral(spark, sf_dir):
    text = "SELECT n_name, t.c_custkey, t.c_acctbal FROM {n} n, LATERAL (SELECT c_custkey, c_acctbal FROM {c} c WHERE c.c_nationkey = n.n_nationkey ORDER BY c_acctbal DESC, c_custkey LIMIT 2) t"
    return spark.sql(text, n=table(spark, sf_dir, "nation"), c=table(spark, sf_dir, "customer"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def join_anti(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


_NODES = "(SELECT 'r' || r_regionkey AS id, NULL AS parent FROM region UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer)"


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region").selectExpr("concat('r', r_regionkey) AS id", "CAST(NULL AS STRING) AS parent")
    n = table(spark, sf_dir, "nation").selectExpr("concat('n', n_nationkey)", "concat('r', n_regionkey)")
    return r.unionAll(n).unionAll(table(spark, sf_dir, "customer").selectExpr("concat('c', c_custkey)", "concat('n', c_nationkey)"))


@query(f"SELECT p.id AS parent, count(*) AS children FROM {_NODES} p JOIN {_NODES} c ON c.parent = p.id GROUP BY p.id")
def join_self_tree(spark, sf_dir):
    n = _nodes(spark, sf_dir)
    return n.alias("p").join(n.alias("c"), F.col("c.parent") == F.col("p.id")).groupBy(F.col("p.id").alias("parent")).agg(F.count(F.lit(1)).alias("children"))


@query(f"""WITH RECURSIVE t AS {_NODES}, walk AS (SELECT id, id AS root, 0 AS depth, id AS path FROM t WHERE parent IS NULL
  UNION ALL SELECT t.id, root, depth + 1, path || '/' || t.id FROM walk JOIN t ON t.parent = walk.id) SELECT * FROM walk""")
def cte_recursive(spark, sf_dir):
    return rel.tree_levels(_nodes(spark, sf_dir), "id", "parent")


@query(f"SELECT p.id AS parent, count(*) AS children FROM {_NODES} p JOIN {_NODES} c ON c.parent = p.id GROUP BY p.id")
def join_self_tree_whole(spark, sf_dir):
    n = _nodes(spark, sf_dir)
    return n.alias("p").join(n.alias("c"), F.col("c.parent") == F.col("p.id")).groupBy(F.col("p.id").alias("parent")).agg(F.count(F.lit(1)).alias("children"))


@query(f"""WITH RECURSIVE t AS {_NODES}, walk AS (SELECT id, id AS root, 0 AS depth, id AS path FROM t WHERE parent IS NULL
  UNION ALL SELECT t.id, root, depth + 1, path || '/' || t.id FROM walk JOIN t ON t.parent = walk.id) SELECT * FROM walk""")
def cte_recursive_whole(spark, sf_dir):
    return rel.tree_levels(_nodes(spark, sf_dir), "id", "parent")


@query("SELECT n_name, len(list(c_custkey)) AS customers, list_sum(list(c_custkey)) AS ids FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey")
def eager_load(spark, sf_dir):
    loaded = rel.eager_load(table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "n_nationkey", "c_nationkey", "customers")
    return loaded.select("n_name", F.size("customers").cast("bigint").alias("customers"), F.aggregate("customers", F.lit(0).cast("bigint"), lambda a, c: a + c["c_custkey"]).alias("ids"))


@query("SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total, min(o_totalprice) AS low, max(o_totalprice) AS high, count(*) AS n, count(DISTINCT o_orderstatus) AS statuses FROM orders GROUP BY o_custkey HAVING count(*) > 12")
def group_having(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(total("o_totalprice").alias("total"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), F.count(F.lit(1)).alias("n"), F.countDistinct("o_orderstatus").alias("statuses"))
    return g.where("n > 12")


@query("SELECT n_regionkey, string_agg(n_name, '|' ORDER BY n_name) AS names FROM nation GROUP BY n_regionkey")
def group_concat(spark, sf_dir):
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(rel.group_concat(F.col("n_name"), "|").alias("names"))


_GROUPED = "SELECT o_orderstatus, o_orderpriority, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total{} FROM orders GROUP BY {}"


@query(_GROUPED.format(", (grouping(o_orderstatus) + grouping(o_orderpriority))::INT AS level", "ROLLUP (o_orderstatus, o_orderpriority)"))
def group_rollup(spark, sf_dir):
    return rel.rollup(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"], total("o_totalprice").alias("total"))


@query(_GROUPED.format("", "CUBE (o_orderstatus, o_orderpriority)"))
def group_cube(spark, sf_dir):
    return table(spark, sf_dir, "orders").cube("o_orderstatus", "o_orderpriority").agg(total("o_totalprice").alias("total"))


@query(_GROUPED.format("", "GROUPING SETS ((o_orderstatus), (o_orderpriority), ())"))
def grouping_sets(spark, sf_dir):
    a, b = F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, sf_dir, "orders").groupingSets([[a], [b], []], a, b).agg(total("o_totalprice").alias("total")).select("o_orderstatus", "o_orderpriority", "total")


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS done, sum(o_totalprice::DECIMAL(18,2)) FILTER (o_totalprice > 100000)::DOUBLE AS large FROM orders GROUP BY 1")
def group_filter_clause(spark, sf_dir):
    return spark.sql("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_totalprice > 100000) AS DOUBLE) AS large FROM {o} GROUP BY 1", o=table(spark, sf_dir, "orders"))


@query("SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.5), 4) AS median FROM orders GROUP BY 1")
def group_ordered_set(spark, sf_dir):
    return spark.sql("SELECT o_orderstatus, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY o_totalprice), 4) AS median FROM {o} GROUP BY 1", o=table(spark, sf_dir, "orders"))


@query("SELECT c_nationkey, bit_and(c_custkey) AS a, bit_or(c_custkey) AS o, bit_xor(c_custkey) AS x FROM customer GROUP BY 1")
def group_bits(spark, sf_dir):
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.bit_and("c_custkey").alias("a"), F.bit_or("c_custkey").alias("o"), F.bit_xor("c_custkey").alias("x"))


@query("SELECT n_regionkey, count(*) AS n, any_value(r_name) AS r_name FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY n_regionkey")
def group_loose(spark, sf_dir):
    j = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rel.loose_group_by(j, ["n_regionkey"], F.count(F.lit(1)).alias("n"), keep=["r_name"])


@query("SELECT count(*) AS n, max(o_totalprice) AS high FROM orders")
def aggregate_with_sort(spark, sf_dir):
    return rel.aggregate_sorted(table(spark, sf_dir, "orders").orderBy("o_orderdate"), F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("high"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def sort_limit(spark, sf_dir):
    return rel.page(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 20)


@query("SELECT o_orderkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 10 OFFSET 30")
def sort_limit_offset(spark, sf_dir):
    return rel.page(table(spark, sf_dir, "orders"), [F.col("o_orderdate"), F.col("o_orderkey")], 10, 30).select("o_orderkey")


@query("SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey OFFSET 20")
def sort_offset(spark, sf_dir):
    return rel.page(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), [F.col("n_nationkey")], None, 20)


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey LIMIT 1")
def model_one(spark, sf_dir):
    return Model(table(spark, sf_dir, "customer"), "c_custkey").query().where("c_mktsegment = ?", ["BUILDING"]).select("c_custkey", "c_name").order_by("c_custkey").limit(1).frame()


@query("SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY ALL")
def model_group(spark, sf_dir):
    return Model(table(spark, sf_dir, "customer"), "c_custkey").query().where(F.col("c_acctbal") > 0).group_by("c_mktsegment").group_by("c_nationkey").agg(F.count(F.lit(1)).alias("n")).frame()


def _keys(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"))


for _name, _word, _op in (
    ("union", "UNION", lambda a, b: a.union(b).distinct()),
    ("union_all", "UNION ALL", lambda a, b: a.union(b)),
    ("intersect", "INTERSECT", lambda a, b: a.intersect(b)),
    ("intersect_all", "INTERSECT ALL", lambda a, b: a.intersectAll(b)),
    ("except", "EXCEPT", lambda a, b: a.subtract(b)),
    ("except_all", "EXCEPT ALL", lambda a, b: a.exceptAll(b)),
):
    query(f"SELECT c_nationkey AS k FROM customer {_word} SELECT s_nationkey FROM supplier", f"set_{_name}")(lambda spark, sf_dir, op=_op: op(*_keys(spark, sf_dir)))


@query("SELECT k FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier) ORDER BY k DESC LIMIT 5 OFFSET 2")
def set_sorted_page(spark, sf_dir):
    a, b = _keys(spark, sf_dir)
    return rel.page(a.union(b).distinct(), [F.desc("k")], 5, 2)


@query("""WITH spend AS (SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2)) AS s FROM orders GROUP BY 1), top AS (SELECT * FROM spend WHERE s > (SELECT avg(s) FROM spend))
  SELECT c_mktsegment, count(*) AS n, sum(s)::DOUBLE AS s FROM top JOIN customer ON c_custkey = o_custkey GROUP BY 1""")
def cte_chain(spark, sf_dir):
    text = """WITH spend AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s FROM {o} GROUP BY 1), top AS (SELECT * FROM spend WHERE s > (SELECT avg(s) FROM spend))
      SELECT c_mktsegment, count(*) AS n, CAST(sum(s) AS DOUBLE) AS s FROM top JOIN {c} ON c_custkey = o_custkey GROUP BY 1"""
    return spark.sql(text, o=table(spark, sf_dir, "orders"), c=table(spark, sf_dir, "customer"))
