"""What the query modules share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.named import Registry
from ..sources.tables import load

REGISTRY = Registry()
query = REGISTRY.query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, name)


def money(x: Column | str) -> Column:
    """Sums of exact decimals don't depend on the order of their rows."""
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(18,2)")


def total(x: Column | str) -> Column:
    return F.sum(money(x)).cast("double")
