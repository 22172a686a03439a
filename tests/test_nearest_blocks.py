"""Exact neighbours of more queries than one block holds."""

from pyspark.sql import functions as F

from sparkloom.operators.nearest import nearest


def test_nearest_in_blocks(spark):
    """More queries than one block holds give the rows of a single block."""
    v = spark.range(120).select(F.col("id").alias("vec_id"), F.array((F.col("id") * 37 % 120).cast("float"), (F.col("id") % 7).cast("float")).alias("embedding"))
    whole = sorted(map(tuple, nearest(v, v, 4).collect()))
    assert len(whole) == 480 and sorted(map(tuple, nearest(v, v, 4, limit=25).collect())) == whole
