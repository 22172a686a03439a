"""Trees deeper than the levels of Spark's recursion."""

from pyspark.sql import functions as F

from sparkloom.operators import relational


def test_deep_tree(spark):
    """Spark's own recursion stops at 100 levels."""
    n = spark.range(104).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("parent"))
    rows = relational.tree_levels(n.localCheckpoint(), "id", "parent").collect()
    assert sorted((r.id, r.root, r.depth) for r in rows) == [(i, 0, i) for i in range(104)]
    assert max(rows, key=lambda r: r.depth).path == "/".join(str(i) for i in range(104))
