"""MRR@k and Recall@k (R27, R28), MRR without cut-off (R29), and the
submission scoring job (R36). Both metrics come from one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def hit_position(truth: DataFrame, preds: DataFrame, target: str = "target",
                 keys: list[str] | None = None) -> DataFrame:
    """Left join each truth row to its user's list; ``hit_pos`` = first
    1-based position of the target, NULL when absent or no list. A user
    with more than one prediction row is an error (it would inflate Q)."""
    keys = keys or ["user_id"]
    once = F.count(F.lit(1)).over(W.partitionBy(*keys))
    checked = preds.select(*keys, "predictions").withColumn(
        "predictions", F.when(once == 1, F.col("predictions")).otherwise(
            F.raise_error(F.lit("more than one prediction row per user"))))
    joined = truth.join(checked, keys, "left")
    p = F.array_position(F.col("predictions"), F.col(target))
    return joined.withColumn("hit_pos", F.when(p > 0, p))


def mrr_recall(truth: DataFrame, preds: DataFrame, k: int | None = 100,
               target: str = "target", keys: list[str] | None = None) -> DataFrame:
    """R27 + R28: one row ``mrr, recall, n_queries``. Q = truth rows; a
    target beyond position ``k`` (or absent) scores 0. ``k=None`` = no cut."""
    hits = hit_position(truth, preds, target, keys)
    pos = F.col("hit_pos")
    ok = pos.isNotNull() if k is None else (pos.isNotNull() & (pos <= k))
    rr = F.when(ok, F.lit(1.0) / pos).otherwise(F.lit(0.0))
    hit = F.when(ok, F.lit(1.0)).otherwise(F.lit(0.0))
    return hits.agg(F.avg(rr).alias("mrr"), F.avg(hit).alias("recall"),
                    F.count(F.lit(1)).alias("n_queries"))


def mrr_unbounded(truth: DataFrame, ranked: DataFrame, target: str = "next_item",
                  keys: list[str] | None = None) -> DataFrame:
    """MRR with no cut-off (leave-last-out truth by default), from flat
    positions ``keys, vacancy_id, pos``: no list of a user's items is built."""
    keys = keys or ["user_id"]
    first = ranked.groupBy(*keys, F.col("vacancy_id").alias(target)).agg(F.min("pos").alias("pos"))
    hits = truth.select(*keys, target).join(first, [*keys, target], "left")
    return hits.agg(F.avg(F.coalesce(F.lit(1.0) / F.col("pos"), F.lit(0.0))).alias("mrr"), F.count(F.lit(1)).alias("n_queries"))


def target_position(truth: DataFrame, cands: DataFrame, score: str, target: str = "next_item",
                    ascending: bool = True) -> DataFrame:
    """``user_id, vacancy_id, pos`` of the target items that are among their
    users' candidates (one row per user and item): the number of candidates
    that come before it by score, then item id, plus one. Counted per
    target instead of ranking a user's whole list."""
    wanted = truth.select("user_id", F.col(target).alias("_t")).distinct()
    own = cands.join(wanted, (cands["user_id"] == wanted["user_id"]) & (cands["vacancy_id"] == F.col("_t"))).select(
        cands["user_id"].alias("_u"), "_t", F.col(score).alias("_s"))
    better = F.col(score) < F.col("_s") if ascending else F.col(score) > F.col("_s")
    before = better | ((F.col(score) == F.col("_s")) & (F.col("vacancy_id") < F.col("_t")))
    return (cands.join(own, cands["user_id"] == F.col("_u"))
                 .groupBy(F.col("_u").alias("user_id"), F.col("_t").alias("vacancy_id"))
                 .agg((F.count_if(before) + 1).alias("pos")))


def score_submission(truth: DataFrame, submission: DataFrame, k: int = 100,
                     row_limit: int = -1) -> DataFrame:
    """Optional row limit (first ``row_limit`` truth rows by
    ``user_id, session_id``; -1 = all), then MRR@k and Recall@k."""
    if row_limit != -1:
        truth = truth.orderBy("user_id", "session_id").limit(row_limit)
    return mrr_recall(truth, submission, k)
