"""Exact deduplication against a persistent digest index, bucketed and sorted by hash."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, load, materialize, scratch_path, text_or_empty


def normal_text(text: Column | str) -> Column:
    """Null counts as empty; each run of ASCII white space becomes one space."""
    return F.regexp_replace(text_or_empty(text), SPACE, " ")


class DigestIndex:
    """Digests of all texts seen so far, in a Parquet table bucketed and sorted by digest.

    The files live at ``path`` and outlast the session: opening the same path again, with the same number of
    buckets, continues the index. Each row is ``digest`` (SHA-256, hex) and ``keep_id`` (the id that stays)."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, id_type: str = "bigint"):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:32]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest STRING, keep_id {id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def append(self, rows: DataFrame) -> None:
        """Add rows with new digests. They are dealt out by bucket first, so that each task writes one file."""
        rows.select("digest", "keep_id").repartition(self.buckets, "digest").write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)

    def dedup(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Deduplicate a batch and append its new digests to the index.

        Returns one row for each row of ``docs``: ``id_col``, ``digest``, ``keep_id``, ``group_size`` (rows of
        this batch with an equal text) and ``kept``. Of equal texts the smallest id of the first batch that had
        one stays. A null text counts as empty; rows with a null id are never kept unless all ids of their group
        are null (then ``keep_id`` is null and all its rows are kept). Of rows repeated with the same id all are
        kept, as they can't be told apart. An empty batch gives no rows."""
        rows = docs.select(F.col(id_col).alias("id"), F.sha2(normal_text(docs[text_col]), 256).alias("digest"))
        # One row for each digest, combined before the shuffle, so a text with very many copies is no hot key.
        groups = materialize(rows.groupBy("digest").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("group_size")), "digests")
        fresh = groups.join(self.table().hint("merge"), "digest", "left_anti")
        self.append(fresh.select("digest", F.col("first_id").alias("keep_id")))
        decided = materialize(groups.join(self.table().hint("merge"), "digest").select("digest", "keep_id", "group_size"), "decided")
        # Both sides are shuffled here, so adaptive execution can split the rows of a digest with many copies.
        return rows.join(decided, "digest").select(
            F.col("id").alias(id_col), "digest", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept")
        )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents`` as the first batch of a new index."""
    index = DigestIndex(spark, scratch_path(spark, "digest_index"))
    out = index.dedup(load(spark, sf_dir, "documents"))
    index.close()
    return out.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


QUERIES = {"op9_exact_dedup": op9_exact_dedup}
ORACLE = {
    "op9_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, h AS text_sha256
        FROM d WINDOW w AS (PARTITION BY h)"""
}
