"""Changes of tables as functions from snapshots to snapshots. ``keys`` are the unique keys, each a tuple of columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import scratch_path

Keys = list[tuple[str, ...]]


def insert(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(source, allowMissingColumns=True)


def _numbered(rows: DataFrame, keys: Keys, *order: Column) -> DataFrame:
    """``rows`` that come first, by ``order``, among those with an equal key, for each of the keys; NULL keys are never equal."""
    numbers = [f"_n{i}" for i in range(len(keys))]
    for name, k in zip(numbers, keys, strict=True):
        null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in k])
        apart = F.when(null, F.monotonically_increasing_id())  # spreads rows with a NULL key
        w = Window.partitionBy(*k, "_apart").orderBy(*order)
        rows = rows.withColumn("_apart", apart).withColumn(name, F.row_number().over(w)).drop("_apart")
    return rows.where(reduce(lambda a, b: a & b, [F.col(n) == 1 for n in numbers])).drop(*numbers)


def _written(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, "rows")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _accepted(source: DataFrame, keys: Keys, order: Column) -> DataFrame:
    """The rows that stay if each is taken in turn unless one taken before has an equal key.

    A round takes the rows that are first for all their keys, and drops those that conflict with them; rows that only
    conflicted with dropped ones go on to the next round. Rounds end in files."""
    left = _written(source.select("*", order.alias("_order"), F.monotonically_increasing_id().alias("_row")))
    taken = []
    while True:
        first = _written(_numbered(left, keys, F.col("_order"), F.col("_row")))
        taken.append(first)
        rest = left.join(first.select("_row"), "_row", "left_anti")
        for k in keys:
            rest = rest.join(first.select(*k), list(k), "left_anti")
        left = _written(rest.select(*left.columns))
        if left.isEmpty():
            return reduce(DataFrame.unionAll, taken).select(*source.columns)


def insert_ignore(target: DataFrame, source: DataFrame, keys: Keys, order: Column) -> DataFrame:
    """Source rows, in turn by ``order``, that conflict in no key with a row of the target or one inserted before."""
    new = source
    for k in keys:
        new = new.join(target.select(*k), list(k), "left_anti").select(*source.columns)
    new = _numbered(new, keys, order) if len(keys) == 1 else _accepted(new, keys, order)
    return target.unionByName(new.select(*target.columns))


def replace_into(target: DataFrame, source: DataFrame, keys: Keys, order: Column) -> DataFrame:
    """Source rows, in turn by ``order``, each take the place of all rows with an equal key, of the target and of the source;
    a row that is itself replaced later has replaced others before."""
    new, old = _numbered(source, keys, order.desc()), target
    for k in keys:
        old = old.join(source.select(*k), list(k), "left_anti").select(*target.columns)
    return old.unionByName(new.select(*target.columns))


def upsert(target: DataFrame, source: DataFrame, key: tuple[str, ...], assign: dict[str, Column] | None = None) -> DataFrame:
    """Insert rows with new keys; of others update columns by ``assign``, which sees the row as ``old.`` and the
    source's as ``new.`` columns. Without assignments the old row stays. Source keys must be unique."""
    assign = assign or {}
    on = reduce(lambda a, b: a & b, [F.col(f"old.{c}") == F.col(f"new.{c}") for c in key])
    both = target.withColumn("_old", F.lit(True)).alias("old").join(source.withColumn("_new", F.lit(True)).alias("new"), on, "full")
    old, new = F.col("old._old").isNotNull(), F.col("new._new").isNotNull()
    pick = lambda c: F.when(old & new, assign.get(c, F.col(f"old.{c}"))).when(old, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}") if c in source.columns else F.lit(None))
    return both.select(*[pick(c).alias(c) for c in target.columns])


def update(target: DataFrame, assign: dict[str, Column], where: Column | None = None) -> DataFrame:
    """Assignments all see the row as it was."""
    hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    return target.select(*[F.when(hit, assign[c].cast(target.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in assign else F.col(c) for c in target.columns])


def delete(target: DataFrame, where: Column | None = None) -> DataFrame:
    """A row stays where the condition is NULL."""
    return target.where(~F.coalesce(where, F.lit(False))) if where is not None else target.limit(0)


def returning(before: DataFrame, after: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Rows of ``after`` whose key is new or that differ in a column; ``key`` is unique and not NULL in both."""
    on = reduce(lambda a, b: a & b, [F.col(f"new.{c}") == F.col(f"old.{c}") for c in key])
    both = after.alias("new").join(before.withColumn("_old", F.lit(True)).alias("old"), on, "left")
    same = reduce(lambda a, b: a & b, [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in after.columns if c in before.columns])
    return both.where(F.col("old._old").isNull() | ~same).select("new.*")


def affected(target: DataFrame, source: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Counts of an upsert: inserted rows count one, updated ones two."""
    found = source.join(target.select(*key).withColumn("_old", F.lit(True)), list(key), "left")
    return found.agg(F.count_if(F.col("_old").isNull()).alias("inserted"), F.count_if(F.col("_old").isNotNull()).alias("updated")).withColumn("affected", F.col("inserted") + 2 * F.col("updated"))


def merge(target: DataFrame, source: DataFrame, key: tuple[str, ...], matched: dict[str, Column] | None = None, delete_when: Column | None = None, insert_new: bool = True) -> DataFrame:
    """Update or delete matched rows and insert the others; conditions see ``old.`` and ``new.`` columns.

    Columns that the source lacks are NULL in inserted rows."""
    on = reduce(lambda a, b: a & b, [F.col(f"old.{c}") == F.col(f"new.{c}") for c in key])
    both = target.withColumn("_old", F.lit(True)).alias("old").join(source.withColumn("_new", F.lit(True)).alias("new"), on, "full" if insert_new else "left")
    old, new = F.col("old._old").isNotNull(), F.col("new._new").isNotNull()
    if delete_when is not None:
        both = both.where(~(old & new & F.coalesce(delete_when, F.lit(False))))
    matched = matched or {}
    return both.select(*[F.when(old & new, matched.get(c, F.col(f"old.{c}"))).when(old, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}") if c in source.columns else F.lit(None)).alias(c) for c in target.columns])
