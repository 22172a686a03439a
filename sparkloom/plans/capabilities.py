"""What the library does natively, and what has no meaning on immutable tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NATIVE = ("joins: inner, left, right, full, cross, natural, lateral, semi, anti", "group by, having, rollup, cube, grouping sets, filter clause", "window functions and frames", "recursive common tables", "set operations", "json", "json_table", "full text", "vectors", "geometry", "insert ignore, replace, upsert, update, delete, merge, returning", "delimited files", "streams")
NOT_APPLICABLE = ("transactions and savepoints", "row locks", "triggers", "sequences and last insert id", "secondary indexes", "server status and grants")


def report(spark: SparkSession) -> DataFrame:
    rows = [(x, True) for x in NATIVE] + [(x, False) for x in NOT_APPLICABLE]
    return spark.createDataFrame(rows, "capability string, supported boolean")
