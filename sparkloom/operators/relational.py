"""Relational shapes that need more than one built-in call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import scratch_path


def loose_group_by(df: DataFrame, keys: list[str], *aggregates: Column, keep: list[str] = ()) -> DataFrame:
    """Group with columns that are neither grouped nor aggregated: any one value of each."""
    return df.groupBy(*keys).agg(*aggregates, *[F.any_value(c).alias(c) for c in keep])


def aggregate_sorted(df: DataFrame, *aggregates: Column) -> DataFrame:
    """A global aggregate; a sort below it has no meaning and the optimizer drops it."""
    return df.agg(*aggregates)


def qualify(df: DataFrame, name: str, windowed: Column, condition: Column) -> DataFrame:
    """Filter on a window function's result."""
    return df.withColumn(name, windowed).where(condition)


def top_k(df: DataFrame, k: int, by: list[Column], within: list[str]) -> DataFrame:
    """The first ``k`` rows of each group; the limit is applied before the shuffle too."""
    w = Window.partitionBy(*within).orderBy(*by)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all columns of one name."""
    common = [c for c in a.columns if c in b.columns]
    return a.join(b, common, how) if common else a.crossJoin(b)


def comma_join(a: DataFrame, b: DataFrame, condition: Column) -> DataFrame:
    """A list of tables with a condition; equalities in it make a hash or merge join."""
    return a.join(b, condition)


def not_in(a: DataFrame, column: str, b: DataFrame, other: str) -> DataFrame:
    """NOT IN: no row at all if ``other`` has a NULL; a NULL on the left only if ``b`` is empty."""
    b = b.select(F.col(other).alias("_in"))
    summary = b.agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_in").isNull()).alias("_nulls"))
    kept = a.join(b.where("_in IS NOT NULL").distinct(), F.col(column) == F.col("_in"), "left_anti")
    return kept.crossJoin(F.broadcast(summary)).where((F.col("_n") == 0) | (F.col("_nulls") == 0) & F.col(column).isNotNull()).drop("_n", "_nulls")


def eager_load(parents: DataFrame, children: DataFrame, key: str, child_key: str, name: str) -> DataFrame:
    """Each parent with the array of its children, by one join. Children are gathered before it."""
    rows = F.array_sort(F.collect_list(F.struct(*children.columns)))
    gathered = children.groupBy(F.col(child_key).alias("_key")).agg(rows.alias(name))
    out = parents.join(gathered, parents[key] == F.col("_key"), "left").drop("_key")
    return out.withColumn(name, F.coalesce(name, F.array().cast(out.schema[name].dataType)))


def tree_levels(nodes: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    """``id``, ``root``, ``depth`` and ``path`` of each node below a root (a node without a parent).

    Each level is a join of the one before with the nodes, written to the shared folder, so that neither the depth
    nor the number of rows has a limit. Nodes on a cycle have no root above them and give no row."""
    spark = nodes.sparkSession
    edges = nodes.select(F.col(id_col).alias("id"), F.col(parent_col).alias("parent"))
    path = scratch_path(spark, "tree_levels")
    level = edges.where("parent IS NULL").select("id", F.col("id").alias("root"), F.lit(0).alias("depth"), F.col("id").cast("string").alias("path"))
    schema, depth = level.schema, 0
    while True:
        level.write.parquet(f"{path}/level={depth}")
        above = spark.read.schema(schema).parquet(f"{path}/level={depth}").alias("w")
        if above.isEmpty():
            return spark.read.schema(schema).parquet(*[f"{path}/level={n}" for n in range(depth + 1)])
        below = edges.alias("n").join(above, F.col("n.parent") == F.col("w.id"))
        level = below.select("n.id", "w.root", (F.col("w.depth") + 1).alias("depth"), F.concat("w.path", F.lit("/"), F.col("n.id").cast("string")).alias("path"))
        depth += 1


def rollup(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """Subtotals for each leading part of the keys; ``level`` says how many keys are rolled up."""
    level = sum((F.grouping(k).cast("int") for k in keys), F.lit(0))
    return df.rollup(*keys).agg(*aggregates, level.alias("level"))


def group_concat(x: Column, separator: str = ",", distinct: bool = False) -> Column:
    """Sorted values of a group joined to one text."""
    gathered = F.collect_set(x.cast("string")) if distinct else F.collect_list(x.cast("string"))
    return F.array_join(F.array_sort(gathered), separator)


def exists(df: DataFrame) -> bool:
    return not df.isEmpty()


def page(df: DataFrame, by: list[Column], limit: int | None = None, offset: int = 0) -> DataFrame:
    out = df.orderBy(*by).offset(offset)
    return out if limit is None else out.limit(limit)
