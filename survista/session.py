"""Spark session helpers.

On a cluster the session comes from the platform; we only read its settings.
``get_spark`` exists for tests, the bench and local runs, and sets values only
where the caller's environment leaves them unset.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Defaults tuned for local[N] runs; on a cluster the session's own values win
# because ``getOrCreate`` returns the existing session unchanged.
_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Auto-broadcast stays size-checked by the planner (and by AQE at runtime)
    # so only sides measured below this many bytes are ever broadcast.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "survista", extra: dict | None = None) -> SparkSession:
    """Return the active session, creating a local one when none exists."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.appName(app)
    conf = dict(_LOCAL_DEFAULTS)
    # A submitted job brings its master, memory and partition count along; only
    # a plain local run (tests, bench) gets them from here.
    if master or not SparkConf().contains("spark.master"):
        builder = builder.master(master or f"local[{cpus}]")
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
        conf["spark.driver.memory"] = os.environ.get("SPARK_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/S3/ABFS) folder there; we never override it.
    Only when it is unset and the master is local (tests) do we point it at a
    fresh local folder; on a cluster executors could not share that.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="survista-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path
