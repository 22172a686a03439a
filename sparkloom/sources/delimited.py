"""Loading delimited text with separators, quotes, line prefixes, skipped lines, column lists and assignments."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Options:
    charset: str = "UTF-8"
    terminated_by: str = "\t"
    enclosed_by: str | None = None
    escaped_by: str = "\\"
    starting_by: str = ""
    lines_terminated_by: str = "\n"
    ignore_lines: int = 0
    columns: list[str] = field(default_factory=list)
    assignments: dict[str, Column] = field(default_factory=dict)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, options: Options | None = None) -> DataFrame:
    """Rows of ``schema`` from delimited text.

    ``columns`` names the fields in their order in the file (default: the schema's); ``assignments`` compute columns
    from the fields. Lines without the starting text are left out, and what stands before it goes. Skipped lines are
    those at the beginning of each file, at most those of its first split (a file is read in splits of
    ``spark.sql.files.maxPartitionBytes``). ``\\N`` stands for NULL. Other columns of the schema are NULL."""
    o = options or Options()
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = o.columns or schema.names
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    parse = {"sep": o.terminated_by, "quote": o.enclosed_by or "", "escape": o.escaped_by or "", "nullValue": "\\N", "emptyValue": ""}
    simple = not o.starting_by and o.ignore_lines == 0 and len(o.lines_terminated_by) <= 2
    if simple:
        rows = spark.read.csv(path, as_text, encoding=o.charset, lineSep=o.lines_terminated_by, **parse)
    else:
        files = spark.read.text(path, lineSep=o.lines_terminated_by)
        if o.ignore_lines:
            # A task reads a split in order, so its lines have consecutive numbers, and a file's first line the least.
            files = files.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
            first = files.where("start = 0").groupBy("file").agg(F.min("line").alias("first"))
            files = files.join(first, "file").where((F.col("start") > 0) | (F.col("line") >= F.col("first") + o.ignore_lines)).select("value")
        if o.starting_by:
            at = F.instr("value", o.starting_by)
            files = files.where(at > 0).select(F.substring("value", at + len(o.starting_by), F.length("value")).alias("value"))
        parsed = F.from_csv("value", as_text.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), parse)
        rows = files.where("value <> ''").select(parsed.alias("r")).select("r.*")
    rows = rows.withColumns(o.assignments) if o.assignments else rows
    have = set(rows.columns)
    return rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
