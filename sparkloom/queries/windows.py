"""Window functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import relational as rel
from .base import money, query, table

_W = "(PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"


def _by_customer():
    return Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")


@query(f"SELECT o_orderkey, row_number() OVER {_W} AS rn, sum(o_totalprice::DECIMAL(18,2)) OVER (PARTITION BY o_custkey)::DOUBLE AS all_of_it FROM orders")
def window_row_number_sum(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.row_number().over(_by_customer()).cast("bigint").alias("rn"), F.sum(money("o_totalprice")).over(Window.partitionBy("o_custkey")).cast("double").alias("all_of_it"))


@query("""SELECT s_suppkey, rank() OVER w AS r, dense_rank() OVER w AS d, ntile(4) OVER u AS q, round(percent_rank() OVER w, 6) AS p, round(cume_dist() OVER w, 6) AS c
  FROM supplier WINDOW w AS (ORDER BY s_nationkey), u AS (ORDER BY s_nationkey, s_suppkey)""")
def window_ranks(spark, sf_dir):
    w, u = Window.orderBy("s_nationkey"), Window.orderBy("s_nationkey", "s_suppkey")
    s = table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", F.rank().over(w).cast("bigint").alias("r"), F.dense_rank().over(w).cast("bigint").alias("d"), F.ntile(4).over(u).cast("bigint").alias("q"), F.round(F.percent_rank().over(w), 6).alias("p"), F.round(F.cume_dist().over(w), 6).alias("c"))


@query(f"""SELECT o_orderkey, lag(o_totalprice) OVER {_W} AS before, lead(o_totalprice, 2, 0) OVER {_W} AS after, first_value(o_orderkey) OVER {_W} AS f,
  last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l,
  nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS n2 FROM orders""")
def window_offsets(spark, sf_dir):
    w = _by_customer()
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.lag("o_totalprice").over(w).alias("before"), F.lead("o_totalprice", 2, 0.0).over(w).alias("after"), F.first_value("o_orderkey").over(w).alias("f"), F.last_value("o_orderkey").over(full).alias("l"), F.nth_value("o_orderkey", 2).over(full).alias("n2")
    )


@query(f"""SELECT o_orderkey, sum(o_totalprice::DECIMAL(18,2)) OVER {_W}::DOUBLE AS running, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS moving,
  count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderdate ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM orders""")
def window_frames(spark, sf_dir):
    w = _by_customer()
    rest = Window.partitionBy("o_custkey").orderBy("o_orderdate").rowsBetween(0, Window.unboundedFollowing)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.sum(money("o_totalprice")).over(w).cast("double").alias("running"), F.round(F.avg("o_totalprice").over(w.rowsBetween(-2, 0)), 4).alias("moving"), F.count(F.lit(1)).over(rest).alias("rest")
    )


@query("SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY value RANGE BETWEEN 1.0 PRECEDING AND 1.0 FOLLOWING) AS near FROM events")
def window_range_frame(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.count(F.lit(1)).over(Window.partitionBy("event_type").orderBy("value").rangeBetween(-1, 1)).alias("near"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3")
def top_k_per_group(spark, sf_dir):
    return rel.top_k(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), 3, [F.desc("o_totalprice"), F.col("o_orderkey")], ["o_custkey"])


@query("SELECT s_suppkey, s_acctbal, avg_bal FROM (SELECT *, round(avg(s_acctbal) OVER (PARTITION BY s_nationkey), 4) AS avg_bal FROM supplier) WHERE s_acctbal > avg_bal")
def qualify(spark, sf_dir):
    avg = F.round(F.avg("s_acctbal").over(Window.partitionBy("s_nationkey")), 4)
    return rel.qualify(table(spark, sf_dir, "supplier"), "avg_bal", avg, F.col("s_acctbal") > F.col("avg_bal")).select("s_suppkey", "s_acctbal", "avg_bal")


@query("""SELECT user_id, min(ts) AS first_ts, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM
  (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""")
def sessionize(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gap = F.col("ts") - F.lag("ts").over(w)
    e = table(spark, sf_dir, "events").withColumn("new", F.when(gap <= F.expr("INTERVAL 30 MINUTES"), 0).otherwise(1))
    return e.withColumn("s", F.sum("new").over(w)).groupBy("user_id", "s").agg(F.min("ts").alias("first_ts"), F.count(F.lit(1)).alias("n")).drop("s")
