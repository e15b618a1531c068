"""Intermediate tables in the shared checkpoint folder.

A table that several branches of one plan read (the normalised session log,
the ground truth) is written once as Parquet and scanned back: it is the
source's own "prepare, write, read" boundary, it cuts the lineage (a lost
executor does not recompute the upstream shuffle), and the scan keeps
column pruning and filter push-down, unlike an RDD checkpoint.
"""

from __future__ import annotations

import contextlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from nextclick.session import checkpoint_dir


def tables_dir(spark: SparkSession) -> str:
    return os.path.join(checkpoint_dir(spark), "tables")


def drop_tables(spark: SparkSession) -> None:
    """Delete the tables this session has written, once no result that reads them is needed any more."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(tables_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def configured(spark: SparkSession, name: str, value: str):
    """The setting holds inside, and is put back."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def materialise(df: DataFrame, name: str, sort_within: list[str] | None = None) -> DataFrame:
    """Write ``df`` to ``{checkpoint dir}/tables/{name}-{uuid}`` and read it
    back. ``sort_within`` sorts rows inside each file (tight min/max
    statistics for later range filters, e.g. on ``session_dt``)."""
    spark = df.sparkSession
    path = os.path.join(tables_dir(spark), f"{name}-{uuid.uuid4().hex}")
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    # Shuffle files go when the query ends, not when the driver happens to collect its garbage.
    with configured(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete the table of a ``materialise`` result that nothing will read again."""
    jvm = df.sparkSession._jvm
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
