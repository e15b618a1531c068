"""Spark session helpers.

Where the session runs is the submitter's choice: ``get_spark`` sets a master only if one is given, and leaves partition
counts to the configuration unless told. Intermediate tables go to the folder in ``spark.checkpoint.dir``, which all
executors must share. Only a session on one machine (a local master: tests, benches) may leave it unset; it then gets a
folder of its own, removed when the process ends.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "nextclick",
              driver_memory: str | None = None) -> SparkSession:
    """A session with this library's settings. Call it under spark-submit without arguments."""
    conf = {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf |= {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.default.parallelism": str(shuffle_partitions)}
    if driver_memory or (master or "").startswith("local"):
        conf["spark.driver.memory"] = driver_memory or "16g"  # with a local master the driver does the executors' work
    builder = SparkSession.builder.appName(app).config(map=conf)
    spark = (builder.master(master) if master else builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for ``DataFrame.checkpoint`` and intermediate tables."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: a cluster needs a shared folder "
            "for checkpoints and intermediate tables")
    own = tempfile.mkdtemp(prefix="nextclick-ckpt-", dir=os.environ.get("NEXTCLICK_LOCAL_DIR"))
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    sc.setCheckpointDir(own)
    return sc.getCheckpointDir() or own
