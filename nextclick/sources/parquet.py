"""Parquet scans and sinks (the only format the source system reads or writes).

Paths follow one layout: ``{base}/{split.folder}/train.parquet`` and
``test.parquet`` for datasets, ``{base}/submissions/{split.value}/{name}``
for submissions and ``{base}/frames/{split.value}/{name}`` for stored
intermediate tables such as the item-to-item list. The split is always an
argument; there is no process-wide state.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nextclick.schemas import Split


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Parquet scan; with ``schema`` the file schema is not inferred."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def dataset_path(base: str, split: Split, part: str) -> str:
    return os.path.join(base, split.folder, f"{part}.parquet")


def read_train(spark: SparkSession, base: str, split: Split, schema=None) -> DataFrame:
    return read_table(spark, dataset_path(base, split, "train"), schema)


def read_test(spark: SparkSession, base: str, split: Split, schema=None) -> DataFrame:
    return read_table(spark, dataset_path(base, split, "test"), schema)


def read_vacancies(spark: SparkSession, path: str) -> DataFrame:
    """Vacancy attributes; dotted names become ``area_id`` / ``region_id``."""
    df = read_table(spark, path)
    renames = {"area.id": "area_id", "area.regionId": "region_id"}
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def write_dataset(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Prepared-dataset sink. ``partition_by`` (e.g. a date) gives later
    scans partition pruning."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def submission_path(base: str, experiment: str, split: Split) -> str:
    return os.path.join(base, "submissions", split.value, experiment)


def write_submission(df: DataFrame, base: str, experiment: str, split: Split) -> str:
    """Projected submission export: ``user_id, session_id, predictions``."""
    path = submission_path(base, experiment, split)
    df.select("user_id", "session_id", "predictions").write.mode("overwrite").parquet(path)
    return path


def frame_path(base: str, name: str, split: Split) -> str:
    return os.path.join(base, "frames", split.value, name)


def store_frame(df: DataFrame, base: str, name: str, split: Split) -> str:
    """Intermediate-table sink (e.g. the item-to-item list)."""
    path = frame_path(base, name, split)
    df.write.mode("overwrite").parquet(path)
    return path


def load_frame(spark: SparkSession, base: str, name: str, split: Split) -> DataFrame:
    return read_table(spark, frame_path(base, name, split))


def store_bucketed(df: DataFrame, base: str, name: str, split: Split, key: str = "anchor_vacancy_id", buckets: int = 64) -> str:
    """A5: an intermediate table in ``buckets`` buckets by ``key``, sorted in each, so that joins on ``key`` read it without a shuffle or a
    sort of it. Returns the table's name in the session's catalog; the files are in the layout's frame folder."""
    table = f"{name}_{split.value}_{uuid.uuid4().hex}"
    (df.write.bucketBy(buckets, key).sortBy(key).option("path", frame_path(base, f"{name}_bucketed", split)).saveAsTable(table))
    return table


def load_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def write_by_day(df: DataFrame, path: str, time: str = "session_dt") -> None:
    """A dataset in one folder per day of ``time`` (column ``day``); rows of a day are brought together first, in as many files as the
    shuffle has partitions for it at most."""
    by_day = df.withColumn("day", F.to_date(time))
    spread = F.pmod(F.xxhash64(*[c for c in ("user_id", "session_id") if c in df.columns]), F.lit(16))
    write_dataset(by_day.repartition("day", spread), path, partition_by=["day"])


def read_days(spark: SparkSession, path: str, start: str, end: str, time: str = "session_dt") -> DataFrame:
    """B1 on such a dataset: rows of ``[start, end)``; folders of other days are not read."""
    from_, to = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    df = read_table(spark, path)
    return df.where((F.col("day") >= F.to_date(from_)) & (F.col("day") <= F.to_date(to)) & (F.col(time) >= from_) & (F.col(time) < to)).drop("day")


def read_ranges(spark: SparkSession, path: str, ranges: DataFrame, time: str = "session_dt") -> DataFrame:
    """The same for a table of ranges ``split, start, end`` (few rows): each row of the dataset with the ``split`` it belongs to. The days
    of the ranges are joined on the partition column, so the folders to read are found when the join runs (dynamic pruning)."""
    days = ranges.where(F.col("start") < F.col("end")).select(
        "split", "start", "end", F.explode(F.sequence(F.to_date("start"), F.to_date("end"))).alias("day"))
    hit = (F.col(time) >= F.col("start")) & (F.col(time) < F.col("end"))
    return read_table(spark, path).join(days, "day").where(hit).drop("day", "start", "end")
