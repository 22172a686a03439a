"""Files that a job leaves for its own later steps, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where it is unset, a local master gets a temporary folder; a cluster must name a shared one."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if found is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="sparkloom-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path
