"""Shared pieces of the text operators.

Every operator selects the columns it needs by name, so further columns in
its input (also ones with the names of its outputs) never collide with its
own; a null text counts as the empty text.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nextclick.sources.tables import materialise

#: A word is a maximal run of characters other than ASCII white space (Java and Python agree on it).
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "bounded_sample", "file_keyed", "fresh", "let", "materialise", "narrow_batches", "null_to_empty", "read", "row_keyed", "running_totals"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{table}.parquet"))


def null_to_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def narrow_batches(spark: SparkSession, rows: int = 512) -> None:
    """Hand whole texts to Python a few hundred at a time: an Arrow batch of the
    default 10,000 long documents would not fit beside the executor's heap."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def row_keyed(docs: DataFrame, name: str = "row_key") -> DataFrame:
    """Number the rows by (input partition, position): the same on every retry of a task; equal rows stay apart. A later job may deal the
    files to partitions in another way, so the rows are to be read once only (or see ``file_keyed``)."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def file_keyed(docs: DataFrame, name: str = "row_key") -> DataFrame:
    """Key the rows by a 64-bit hash of (file, row in it), which every job that reads them finds again however it splits the files. What
    is not a plain scan of files is written once instead. ``name`` is to be a new one (see ``fresh``)."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return materialise(row_keyed(docs, name), "row_keys")
    place = docs.metadataColumn("_metadata")
    return docs.select(*docs.columns, F.xxhash64(place["file_path"], place["row_index"]).alias(name))


def fresh(docs: DataFrame, name: str) -> str:
    """``name``, or a longer one that the table does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded_sample(df: DataFrame, most: int, key: str = "doc_id", seed: int = 0) -> DataFrame:
    """At most ``most`` rows: those whose key hashes lowest, hence the same ones on every run. A share slightly above ``most`` is
    cut by the hash first, so that what is sorted, and sent on by each task, stays about ``most`` rows in all."""
    steps = 1 << 30
    mark = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(steps))
    n = df.count()
    if n > most:
        df = df.where(mark < F.lit(min(steps, int(steps * (1.05 * most + 1_000) / n) + 1)))
    return df.orderBy(mark, key).limit(most)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for all its uses in ``body``: inside a lambda an expression is evaluated per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_totals(lengths: Column, block: int = 256) -> Column:
    """Sums of the elements before each element. Summed in blocks: appending to one array would copy it for each element."""
    def totals(values: Column) -> Column:
        return F.aggregate(values, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def of(values: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int")),
                             lambda b: totals(F.slice(values, b * block + 1, F.lit(block))))
        return let(blocks, lambda parts: let(
            totals(F.transform(parts, lambda p: F.element_at(p, -1))),
            lambda before: F.flatten(F.transform(parts, lambda p, i: F.transform(
                F.slice(p, F.lit(1), F.size(p) - 1), lambda v: v + F.element_at(before, i + 1))))))

    empty = F.array().cast("array<int>")
    return let(lengths, lambda values: F.when(F.size(values) == 0, empty).otherwise(of(values)))
