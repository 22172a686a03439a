"""Loading tables, and a registry of what files can't say: keys, defaults, comments."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Temporary views by table name."""
    for name in names:
        load(spark, sf_dir, name).createOrReplaceTempView(name)


def values(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Rows given in the program."""
    return spark.createDataFrame(list(rows), schema)


def no_table(spark: SparkSession, *columns: Column) -> DataFrame:
    """A projection without a table: one row."""
    return spark.range(1).select(*columns)


@dataclass(frozen=True)
class Table:
    """A declared table: schema, keys, defaults (SQL expressions), a comment; definitions change by copies."""

    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign: tuple[tuple[str, str, str], ...] = ()  # column, table, its column
    defaults: dict[str, str] = field(default_factory=dict)
    comment: str = ""

    def keys(self) -> list[tuple[str, ...]]:
        return [k for k in (self.primary_key, *self.unique) if k]

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.schema)

    def default_row(self, spark: SparkSession) -> DataFrame:
        """One row of the declared defaults, NULL where none is declared."""
        return spark.range(1).select(*[F.expr(self.defaults.get(f.name, "NULL")).cast(f.dataType).alias(f.name) for f in self.schema])

    def like(self, name: str) -> Table:
        return replace(self, name=name)

    def add_column(self, name: str, kind: str, default: str | None = None, after: str | None = None, first: bool = False) -> Table:
        fields = list(self.schema)
        at = 0 if first else self.schema.names.index(after) + 1 if after else len(fields)
        fields.insert(at, T.StructField(name, T._parse_datatype_string(kind)))
        return replace(self, schema=T.StructType(fields), defaults=self.defaults | ({name: default} if default else {}))

    def drop_column(self, name: str) -> Table:
        return replace(self, schema=T.StructType([f for f in self.schema if f.name != name]))

    def change_column(self, name: str, new_name: str | None = None, kind: str | None = None, after: str | None = None, first: bool = False) -> Table:
        """Rename, retype or move a column."""
        old = self.schema[name]
        new = T.StructField(new_name or name, T._parse_datatype_string(kind) if kind else old.dataType, old.nullable)
        fields = [new if f.name == name else f for f in self.schema]
        if first or after:
            fields.remove(new)
            fields.insert(0 if first else [f.name for f in fields].index(after) + 1, new)
        return replace(self, schema=T.StructType(fields))

    def conform(self, df: DataFrame, renamed: dict[str, str] | None = None) -> DataFrame:
        """Rows in this definition's columns: renamed, cast, missing ones at their defaults, others left out."""
        for old, new in (renamed or {}).items():
            df = df.withColumnRenamed(old, new)
        have = set(df.columns)
        return df.select(*[(F.col(f.name) if f.name in have else F.expr(self.defaults.get(f.name, "NULL"))).cast(f.dataType).alias(f.name) for f in self.schema])

    def ddl(self) -> str:
        """A CREATE TABLE statement."""
        columns = [f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in self.schema]
        return f"CREATE TABLE `{self.name}` ({', '.join(columns)}) USING parquet" + (f" COMMENT '{self.comment.replace(chr(39), chr(92) + chr(39))}'" if self.comment else "")


def write(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "errorifexists") -> None:
    """A snapshot, partitioned by columns that queries filter on."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def tables_frame(spark: SparkSession, tables: Iterable[Table]) -> DataFrame:
    rows = [(t.name, len(t.schema), ",".join(t.primary_key), t.comment) for t in tables]
    return spark.createDataFrame(rows, "table_name string, n_columns int, primary_key string, comment string")


def columns_frame(spark: SparkSession, tables: Iterable[Table]) -> DataFrame:
    """What an information schema says of columns."""
    rows = []
    for t in tables:
        for i, f in enumerate(t.schema, 1):
            key = "PRI" if f.name in t.primary_key else "UNI" if (f.name,) in t.unique else ""
            rows.append((t.name, f.name, i, f.dataType.simpleString(), f.nullable, key, t.defaults.get(f.name)))
    return spark.createDataFrame(rows, "table_name string, column_name string, ordinal int, data_type string, nullable boolean, column_key string, column_default string")


def keys_frame(spark: SparkSession, tables: Iterable[Table]) -> DataFrame:
    """Keys and references."""
    rows = []
    for t in tables:
        for n, k in enumerate(t.keys()):
            rows.append((t.name, "PRIMARY" if k == t.primary_key else f"unique_{n}", ",".join(k), None))
        rows += [(t.name, "FOREIGN", c, f"{other}.{c2}") for c, other, c2 in t.foreign]
    return spark.createDataFrame(rows, "table_name string, key_name string, columns string, refers_to string")


def show_tables(spark: SparkSession, like: str = "*") -> DataFrame:
    return spark.sql("SHOW TABLES LIKE :p", {"p": like})


def show_columns(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([(c.name, c.dataType, c.nullable) for c in spark.catalog.listColumns(table)], "name string, data_type string, nullable boolean")
