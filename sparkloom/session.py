"""Session settings that the library's semantics and plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "sparkloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, ANSI errors and adaptive execution. ``conf`` uses '__' for '.' in names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
