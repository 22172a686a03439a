"""A table handle with chained query verbs."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .relational import eager_load


@dataclass(frozen=True)
class Query:
    df: DataFrame

    def where(self, condition: Column | str, args: list | None = None) -> Query:
        """A column, or SQL text with ``?`` for each of ``args``, which are bound and not pasted."""
        if args:
            return replace(self, df=self.df.sparkSession.sql(f"SELECT * FROM {{t}} WHERE {condition}", args=args, t=self.df))
        return replace(self, df=self.df.where(condition))

    def select(self, *columns: Column | str) -> Query:
        return replace(self, df=self.df.select(*columns))

    def group_by(self, *keys: str) -> Grouped:
        return Grouped(self.df, keys)

    def order_by(self, *by: Column | str) -> Query:
        return replace(self, df=self.df.orderBy(*by))

    def limit(self, n: int) -> Query:
        return replace(self, df=self.df.limit(n))

    def offset(self, n: int) -> Query:
        return replace(self, df=self.df.offset(n))

    def join(self, other: Query | DataFrame, on: Column | list[str], how: str = "inner") -> Query:
        return replace(self, df=self.df.join(other.df if isinstance(other, Query) else other, on, how))

    def eager_load(self, children: DataFrame, key: str, child_key: str, name: str) -> Query:
        return replace(self, df=eager_load(self.df, children, key, child_key, name))

    def union(self, other: Query) -> Query:
        return replace(self, df=self.df.union(other.df).distinct())

    def intersect(self, other: Query) -> Query:
        return replace(self, df=self.df.intersect(other.df))

    def except_(self, other: Query) -> Query:
        return replace(self, df=self.df.subtract(other.df))

    def frame(self) -> DataFrame:
        return self.df

    def all(self) -> list[Row]:
        return self.df.collect()

    def one(self) -> Row | None:
        return next(iter(self.df.limit(1).collect()), None)

    def count(self) -> int:
        return self.df.count()

    def exists(self) -> bool:
        return not self.df.isEmpty()

    def explain(self, mode: str = "formatted") -> None:
        self.df.explain(mode)


@dataclass(frozen=True)
class Grouped:
    df: DataFrame
    keys: tuple[str, ...]

    def group_by(self, *keys: str) -> Grouped:
        return replace(self, keys=(*self.keys, *keys))

    def agg(self, *columns: Column) -> Query:
        return Query(self.df.groupBy(*self.keys).agg(*columns))


@dataclass(frozen=True)
class Model:
    """A table with its key; with ``deleted`` set, rows where that column has a value are hidden."""

    df: DataFrame
    key: str
    deleted: str | None = None

    def query(self) -> Query:
        return Query(self.df if self.deleted is None else self.df.where(F.col(self.deleted).isNull()))

    def find_one(self, value: object) -> Row | None:
        return self.query().where(F.col(self.key) == F.lit(value)).one()
