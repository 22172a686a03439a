"""Inserts, replacements, updates and deletions as new snapshots."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dml
from .base import query, table


def _halves(spark, sf_dir):
    """All customers, and a source of as many rows whose keys overlap theirs, with other balances."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return c, c.select((F.col("c_custkey") + 40).alias("c_custkey"), "c_name", (F.col("c_acctbal") + 1000).alias("c_acctbal"))


_T, _S = "(SELECT c_custkey, c_name, c_acctbal FROM customer)", "(SELECT c_custkey + 40 AS c_custkey, c_name, c_acctbal + 1000 AS c_acctbal FROM customer)"


@query(f"SELECT * FROM {_T} UNION ALL SELECT * FROM {_S}")
def dml_insert(spark, sf_dir):
    return dml.insert(*_halves(spark, sf_dir))


@query(f"SELECT * FROM {_T} UNION ALL SELECT * FROM {_S} s WHERE NOT EXISTS (SELECT 1 FROM {_T} t WHERE t.c_custkey = s.c_custkey)")
def dml_insert_ignore(spark, sf_dir):
    t, s = _halves(spark, sf_dir)
    return dml.insert_ignore(t, s, [("c_custkey",)], F.col("c_acctbal"))


@query("""SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT s.* FROM (SELECT n_nationkey + 20 AS n_nationkey, n_name || ' 2' AS n_name, n_regionkey FROM nation) s
    WHERE NOT EXISTS (SELECT 1 FROM nation t WHERE t.n_nationkey = s.n_nationkey OR t.n_name = s.n_name)""")
def dml_insert_ignore_two_keys(spark, sf_dir):
    """Nations under new names, some of them with taken numbers; both columns are unique."""
    t = table(spark, sf_dir, "nation")
    s = t.select((F.col("n_nationkey") + 20).alias("n_nationkey"), F.concat("n_name", F.lit(" 2")).alias("n_name"), "n_regionkey")
    return dml.insert_ignore(t, s, [("n_nationkey",), ("n_name",)], F.col("n_nationkey"))


@query(f"SELECT * FROM {_S} UNION ALL SELECT * FROM {_T} t WHERE NOT EXISTS (SELECT 1 FROM {_S} s WHERE t.c_custkey = s.c_custkey)")
def dml_replace_into(spark, sf_dir):
    t, s = _halves(spark, sf_dir)
    return dml.replace_into(t, s, [("c_custkey",)], F.col("c_acctbal"))


@query(f"SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, CASE WHEN t.c_custkey IS NOT NULL AND s.c_custkey IS NOT NULL THEN upper(s.c_name) ELSE coalesce(t.c_name, s.c_name) END AS c_name, CASE WHEN t.c_custkey IS NOT NULL AND s.c_custkey IS NOT NULL THEN t.c_acctbal + s.c_acctbal ELSE coalesce(t.c_acctbal, s.c_acctbal) END AS c_acctbal FROM {_T} t FULL JOIN {_S} s ON t.c_custkey = s.c_custkey")
def dml_upsert(spark, sf_dir):
    t, s = _halves(spark, sf_dir)
    return dml.upsert(t, s, ("c_custkey",), {"c_acctbal": F.col("old.c_acctbal") + F.col("new.c_acctbal"), "c_name": F.upper("new.c_name")})


@query(f"SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal FROM {_T}")
def dml_update(spark, sf_dir):
    return dml.update(_halves(spark, sf_dir)[0], {"c_acctbal": F.col("c_acctbal") * 2}, F.col("c_acctbal") < 0)


@query(f"SELECT * FROM {_T} WHERE NOT c_acctbal < 0")
def dml_delete(spark, sf_dir):
    return dml.delete(_halves(spark, sf_dir)[0], F.col("c_acctbal") < 0)


@query(f"SELECT count(*) FILTER (t.c_custkey IS NULL) AS inserted, count(t.c_custkey) AS updated, count(*) + count(t.c_custkey) AS affected FROM {_S} s LEFT JOIN {_T} t USING (c_custkey)")
def dml_affected(spark, sf_dir):
    return dml.affected(*_halves(spark, sf_dir), ("c_custkey",))


@query(f"SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(t.c_name, s.c_name) AS c_name, coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal FROM {_T} t FULL JOIN {_S} s ON t.c_custkey = s.c_custkey WHERE NOT coalesce(t.c_custkey IS NOT NULL AND s.c_acctbal < 1000, false)")
def dml_merge(spark, sf_dir):
    t, s = _halves(spark, sf_dir)
    return dml.merge(t, s, ("c_custkey",), {"c_acctbal": F.col("new.c_acctbal")}, delete_when=F.col("new.c_acctbal") < 1000)


@query(f"SELECT c_custkey, c_name, c_acctbal * 2 AS c_acctbal FROM {_T} WHERE c_acctbal < 0")
def dml_returning(spark, sf_dir):
    before = _halves(spark, sf_dir)[0]
    return dml.returning(before, dml.update(before, {"c_acctbal": F.col("c_acctbal") * 2}, F.col("c_acctbal") < 0), ("c_custkey",))
