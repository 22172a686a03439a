"""What a plan reads and how it joins."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass
class Access:
    pushed: list[str]
    columns: list[list[str]]
    joins: list[str]
    exchanges: int
    text: str


def explain(df: DataFrame, mode: str = "formatted") -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def access(df: DataFrame) -> Access:
    """Filters that reach the scans, the columns they read, the joins, and the number of shuffles."""
    text = explain(df)
    read = [[c.split(":")[0] for c in re.findall(r"\w+:", s)] for s in re.findall(r"ReadSchema: struct<(.*)>", text)]
    tree = text.split("\n\n")[0]
    return Access(re.findall(r"PushedFilters: \[(.*)\]", text), read, re.findall(r"\b(\w+Join)\b", tree), len(re.findall(r"\bExchange\b", tree)), text)
