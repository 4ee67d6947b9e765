"""Spark session helpers.

The library never creates a session behind the caller's back; these helpers
exist for tests, the bench and the CLI-style entry points. On a cluster the
session comes from the platform and only ``checkpoint_dir`` is consulted.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (all times are UTC in the data
# model), AQE for runtime re-planning (partition coalescing, skew-join split,
# broadcast conversion from runtime statistics).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "snapwise") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name one that all machines reach; only a local run without
    the setting gets a scratch folder of its own, removed when the driver ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="snapwise-ckpt-")
    delete_at_exit(spark, local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a folder, on whatever file system, when the driver ends."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder for written
    intermediates of this session."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    return path
