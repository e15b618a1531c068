"""Dense label encoding (H14): value -> 0..n-1 in value order, without a
global window (which would put every row in one task).

The distinct values are range-partitioned and sorted inside partitions;
``monotonically_increasing_id`` numbers rows inside each partition; the
per-partition counts (one row per partition: a proven small size) are
turned into offsets and broadcast. The numbered table is checkpointed to
the shared checkpoint folder first, so both uses see one materialisation
and a lost executor does not renumber anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nextclick.session import checkpoint_dir


def fit_dictionary(values: DataFrame, col: str, idx: str = "idx",
                   partitions: int | None = None) -> DataFrame:
    """Dictionary table ``col, idx`` (``idx`` dense from 0, in ``col`` order)."""
    return numbered(values.select(col).where(F.col(col).isNotNull()).distinct(), F.col(col), idx=idx, partitions=partitions).select(col, idx)


def numbered(df: DataFrame, *order: Column, idx: str = "idx", partitions: int | None = None) -> DataFrame:
    """Append ``idx``: 0, 1, ... in ``order``, without a global window (see the module's text). Rows equal in ``order`` get numbers in any order."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
           .withColumn("_p", F.spark_partition_id())
           .withColumn("_m", F.monotonically_increasing_id())
           .checkpoint())
    counts = d.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"), F.min("_m").alias("_m0"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_c").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)),
                           F.lit(0)))
    return (d.join(F.broadcast(offsets.select("_p", "_m0", "_off")), "_p")
             .select(*df.columns, (F.col("_off") + F.col("_m") - F.col("_m0")).alias(idx)))


def running_total(df: DataFrame, order: str, value: str, out: str = "upto") -> DataFrame:
    """Append the sum of ``value`` over the rows up to this one in ``order`` (unique), without a global window: running sums inside
    range partitions, plus what the partitions before hold (one row per partition)."""
    checkpoint_dir(df.sparkSession)
    parts = df.repartitionByRange(F.col(order)).withColumn("_p", F.spark_partition_id()).checkpoint()
    before = parts.groupBy("_p").agg(F.sum(value).alias("_s")).select(
        "_p", F.coalesce(F.sum("_s").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    inside = F.sum(value).over(W.partitionBy("_p").orderBy(order).rowsBetween(W.unboundedPreceding, 0))
    return parts.withColumn("_u", inside).join(F.broadcast(before), "_p").select(*df.columns, (F.col("_u") + F.col("_b")).alias(out))


def encode(df: DataFrame, dictionary: DataFrame, col: str, idx: str = "idx") -> DataFrame:
    """Value -> index; an unknown value gets NULL (left join)."""
    return df.join(dictionary.select(col, idx), col, "left")


def decode(df: DataFrame, dictionary: DataFrame, col: str, idx: str = "idx") -> DataFrame:
    """Index -> value; indices outside the dictionary are dropped (inner join)."""
    return df.join(dictionary.select(col, idx), idx, "inner")


def dense_rank_within(df: DataFrame, key: str, order: str, descending: bool = True,
                      out: str = "rank") -> DataFrame:
    """``dense_rank()`` of ``order`` inside ``key`` without a window
    partitioned by ``key``: one key holding most rows is still spread over
    many tasks.

    The distinct ``(key, order)`` pairs get a global dense index from a
    range-partitioned dictionary (range partitioning splits a large key
    over several partitions); a key's rank is its index minus the key's
    first index, plus one. The per-key minimum is a partial aggregation,
    and the joins back are on ``key`` (one row per key on the small side,
    AQE splits a hot partition) and on ``(key, order)``."""
    pairs = (df.select(key, order).distinct()
               .select(F.struct(F.col(key).alias("a"), F.col(order).alias("b")).alias("_k")))
    idx = fit_dictionary(pairs, "_k", "_i").select(
        F.col("_k.a").alias("_key"), F.col("_k.b").alias("_ord"), "_i")
    # ascending index; a descending rank counts from the key's last index
    edge = idx.groupBy("_key").agg((F.max if descending else F.min)("_i").alias("_e"))
    rank = (F.col("_e") - F.col("_i") + 1) if descending else (F.col("_i") - F.col("_e") + 1)
    ranks = idx.join(edge, "_key").select("_key", "_ord", rank.alias(out))
    cond = (F.col(key) == F.col("_key")) & F.col(order).eqNullSafe(F.col("_ord"))
    return df.join(ranks, cond).drop("_key", "_ord")
