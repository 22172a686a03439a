"""Delimited files, declared tables, catalog frames, procedures, and streams (an extension)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import capabilities
from ..plans.named import Procedure
from ..scratch import scratch_path
from ..sources import delimited, tables
from ..streaming import events
from .base import query, table, total

_NATION = tables.Table("nation", T.StructType().add("n_nationkey", "integer", False).add("n_name", "string").add("n_regionkey", "integer"), ("n_nationkey",), (("n_name",),), (("n_regionkey", "region", "r_regionkey"),), {"n_regionkey": "0"}, "countries")


@query("SELECT n_nationkey, upper(n_name) AS n_name, n_regionkey FROM nation")
def load_delimited(spark, sf_dir):
    path = scratch_path(spark, "delimited")
    table(spark, sf_dir, "nation").select(F.concat(F.lit("row:"), F.concat_ws(";", F.col("n_regionkey"), F.concat(F.lit("'"), "n_name", F.lit("'")), "n_nationkey")).alias("value")).write.text(path)
    o = delimited.Options(terminated_by=";", enclosed_by="'", starting_by="row:", columns=["n_regionkey", "n_name", "n_nationkey"], assignments={"n_name": F.upper("n_name")})
    return delimited.read_delimited(spark, path, _NATION.schema, o)


@query("SELECT n_nationkey AS id, n_name, 'x' AS note FROM nation")
def table_change_columns(spark, sf_dir):
    changed = _NATION.change_column("n_nationkey", "id", "bigint").drop_column("n_regionkey").add_column("note", "string", "'x'", after="n_name")
    return changed.conform(table(spark, sf_dir, "nation"), {"n_nationkey": "id"})


@query("SELECT NULL::INT AS n_nationkey, NULL::VARCHAR AS n_name, 0 AS n_regionkey")
def table_default_values(spark, sf_dir):
    return _NATION.default_row(spark)


@query("SELECT * FROM nation WHERE false")
def table_like(spark, sf_dir):
    return _NATION.like("nation_copy").empty(spark)


@query("SELECT * FROM (VALUES ('nation', 'n_nationkey', 1, 'int', false, 'PRI', NULL), ('nation', 'n_name', 2, 'string', true, 'UNI', NULL), ('nation', 'n_regionkey', 3, 'int', true, '', '0')) t(table_name, column_name, ordinal, data_type, nullable, column_key, column_default)")
def catalog_columns(spark, sf_dir):
    return tables.columns_frame(spark, [_NATION])


@query("SELECT * FROM (VALUES ('nation', 'PRIMARY', 'n_nationkey', NULL), ('nation', 'unique_1', 'n_name', NULL), ('nation', 'FOREIGN', 'n_regionkey', 'region.r_regionkey')) t(table_name, key_name, columns, refers_to)")
def catalog_keys(spark, sf_dir):
    return tables.keys_frame(spark, [_NATION])


@query("SELECT 'nation' AS table_name, 3 AS n_columns, 'n_nationkey' AS primary_key, 'countries' AS comment")
def catalog_tables(spark, sf_dir):
    return tables.tables_frame(spark, [_NATION])


@query()
def catalog_capabilities(spark, sf_dir):
    return capabilities.report(spark)


@query("SELECT o_orderstatus, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders) GROUP BY 1")
def procedure_steps(spark, sf_dir):
    """Bind, scalar, abort, and two actions side by side."""
    p = Procedure(spark)
    o = p.bind("procedure_orders", table(spark, sf_dir, "orders"))
    mean, n = p.parallel(lambda: p.scalar(o.agg(F.avg("o_totalprice"))), lambda: p.scalar(o.agg(F.count(F.lit(1)))))
    p.abort_if(n == 0, "no orders")
    return o.where(F.col("o_totalprice") > F.lit(mean)).groupBy("o_orderstatus").agg(total("o_totalprice").alias("total"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts)::TIMESTAMP AS start, event_type, count(*) AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY ALL")
def stream_tumbling(spark, sf_dir):
    """A stream over the files, run to the end; all rows are what it wrote, those of open windows too."""
    out = events.latest_available(events.tumbling(events.read(spark, sf_dir)), ["start", "event_type"])
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("SELECT event_id, event_type FROM events")
def stream_distinct(spark, sf_dir):
    """Each event twice in the stream, once in what it writes."""
    path, stream = scratch_path(spark, "distinct"), events.read(spark, sf_dir)
    events.run_available(events.distinct_events(stream.unionAll(stream)).select("event_id", "event_type"), path)
    return spark.read.parquet(path)


@query("""SELECT s AS start, event_type, count(*) AS n FROM (SELECT event_type, ts, unnest(generate_series(time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 45 MINUTE, time_bucket(INTERVAL 15 MINUTE, ts), INTERVAL 15 MINUTE)) AS s FROM events) GROUP BY ALL""")
def sliding_windows(spark, sf_dir):
    return events.sliding(table(spark, sf_dir, "events"))


@query("""SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM
  (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""")
def session_windows(spark, sf_dir):
    return events.sessions(table(spark, sf_dir, "events"))
