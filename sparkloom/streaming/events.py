"""Windows, sessions and duplicates of an event stream with event time ``ts``. All take batch frames as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..scratch import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str = "events") -> DataFrame:
    """The table's files as a stream; times are instants, as watermarks need."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n", F.col("total").cast("double").alias("total"))


def sliding(events: DataFrame, size: str = "1 hour", every: str = "15 minutes", late: str = "10 minutes") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.window("ts", size, every), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    w = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return w.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def distinct_events(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def run_available(stream: DataFrame, path: str, mode: str = "append", checkpoint: str | None = None) -> None:
    """All that is there now, exactly once, to Parquet files at ``path``.

    ``checkpoint`` must be a folder that outlives the query; without one, a run can't be continued."""
    where = checkpoint or scratch_path(stream.sparkSession, "stream")
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", where).trigger(availableNow=True).format("parquet").start(path)
    query.awaitTermination()


def latest_available(stream: DataFrame, keys: list[str], checkpoint: str | None = None) -> DataFrame:
    """The aggregate's rows after all that is there now, windows still open among them.

    Each batch writes the rows that it changed under its number, again if it is run again; the last of a key counts."""
    spark = stream.sparkSession
    path, where = scratch_path(spark, "changes"), checkpoint or scratch_path(spark, "stream")

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = stream.writeStream.outputMode("update").option("checkpointLocation", where).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    changes = spark.read.schema(T.StructType([*stream.schema, T.StructField("batch", T.LongType())])).option("basePath", path).parquet(path)
    rest = [c for c in stream.columns if c not in keys]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("last"))
    return last.select(*[F.col(c) if c in keys else F.col(f"last.{c}") for c in stream.columns])
