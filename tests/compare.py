"""Comparison of a query's rows with those of its SQL."""

from __future__ import annotations

import glob
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.sql(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{files}')")
    return con


def _plain(x):
    if isinstance(x, Decimal):
        return float(x)
    if isinstance(x, datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, date):
        return x.isoformat()
    if isinstance(x, bool) or x is None or isinstance(x, str | bytes):
        return x
    if isinstance(x, float):
        return float(f"{x:.9g}")
    return x


def rows_of_spark(df: DataFrame) -> tuple[list[str], Counter]:
    cols = sorted(df.columns)
    return cols, Counter(tuple(_plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())


def rows_of_sql(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    out = con.sql(sql)
    cols = sorted(out.columns)
    at = [out.columns.index(c) for c in cols]
    return cols, Counter(tuple(_plain(r[i]) for i in at) for r in out.fetchall())


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """'' if the rows are the same, else what differs first."""
    (cols, got), (want_cols, want) = rows_of_spark(df), rows_of_sql(con, sql)
    if cols != want_cols:
        return f"columns {cols} and {want_cols}"
    return "" if got == want else f"{cols}: {sum(got.values())} and {sum(want.values())} rows; only here {list((got - want).items())[:3]}; only there {list((want - got).items())[:3]}"
