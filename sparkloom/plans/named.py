"""Named queries and procedures."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Named = Callable[..., DataFrame]


@dataclass
class Registry:
    """Functions (spark, sf_dir, **params) -> DataFrame by name, each with its SQL for comparison if it has one."""

    functions: dict[str, Named] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def query(self, sql: str | None = None, name: str | None = None) -> Callable[[Named], Named]:
        def add(f: Named) -> Named:
            key = name or f.__name__
            if key in self.functions:
                raise ValueError(f"two queries named {key}")
            self.functions[key] = f
            if sql:
                self.sql[key] = sql
            return f

        return add

    def names(self) -> list[str]:
        return sorted(self.functions)

    def describe(self, name: str) -> str:
        f = self.functions[name]
        return f"{name}{inspect.signature(f)}: {inspect.getdoc(f) or ''}"

    def dry_run(self, name: str, spark: SparkSession, sf_dir: str, **params: object) -> str:
        """The plan, without running it."""
        return self.functions[name](spark, sf_dir, **params)._jdf.queryExecution().toString()

    def run(self, name: str, spark: SparkSession, sf_dir: str, **params: object) -> DataFrame:
        return self.functions[name](spark, sf_dir, **params)


class Abort(Exception):
    """A procedure's own end before its last step."""


@dataclass
class Procedure:
    """Steps over a shared state: bind a result, read a scalar, abort on a condition, run actions side by side."""

    spark: SparkSession
    state: dict[str, object] = field(default_factory=dict)

    def bind(self, name: str, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(name)
        self.state[name] = df
        return df

    def scalar(self, df: DataFrame) -> object:
        row = df.first()
        return row[0] if row else None

    def abort_if(self, condition: bool, why: str) -> None:
        if condition:
            raise Abort(why)

    def parallel(self, *actions: Callable[[], object]) -> list[object]:
        """Jobs of one session that the scheduler interleaves."""
        with ThreadPoolExecutor(len(actions)) as pool:
            return [f.result() for f in [pool.submit(a) for a in actions]]


def run_script(spark: SparkSession, script: str) -> list[DataFrame]:
    """Statements separated by semicolons at line ends."""
    return [spark.sql(s) for s in (x.strip() for x in script.replace("\r\n", "\n").split(";\n")) if s.rstrip(";")]
