"""Time split (R2), next-response ground truth (R3), leave-last-out truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nextclick.functions.arrays import all_but_last, first_match_struct, last_element
from nextclick.schemas import RESPONSE


def ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def in_range(df: DataFrame, start: str, end: str, col: str = "session_dt") -> DataFrame:
    """B1: half-open ``[start, end)``."""
    return df.where((F.col(col) >= ts(start)) & (F.col(col) < ts(end)))


def time_split(sessions: DataFrame, train: tuple[str, str], validation: tuple[str, str],
               col: str = "session_dt") -> tuple[DataFrame, DataFrame]:
    """R2: train and validation sessions by ``session_dt``; the two ranges
    must not overlap (no leak from validation into train)."""
    if not (train[1] <= validation[0] or validation[1] <= train[0]):
        raise ValueError(f"train {train} overlaps validation {validation}")
    return in_range(sessions, *train, col=col), in_range(sessions, *validation, col=col)


def next_response_truth(validation: DataFrame, min_len: int = 2, max_len: int = 29) -> DataFrame:
    """One (history session, next response) pair per user at most.

    Sessions get the average rank of ``session_dt`` inside the user. The
    target is the user's earliest response (then smallest item, then
    session id) in any session of rank > 1; ``target_dt`` is that session's
    start. The history is the user's session at rank ``target rank - 1``
    with ``min_len`` to ``max_len`` items. A session without a user or
    without a time has no rank: it is in no pair and shifts no other.

    Sessions of a user that share ``session_dt`` form a tie group; group j
    (by time) of size c_j has average rank C_{j-1} + (c_j + 1) / 2, C the
    running count. Rank > 1 fails only for a lone first group. Two average
    ranks differ by exactly 1 only for neighbouring groups of size 1, so
    the history is the single session of the group just before the
    target's, both groups of size 1, and its rank is C_{j-1}. (A lone
    session is found again by its user and time; ``session_id`` may repeat.)

    Plan: groupBy (user, session_dt) -> per-user first group (groupBy user)
    -> per-user target (groupBy user) -> previous group and running count
    (groupBy user over groups before the target) -> join the history
    session back on (user, session_dt). Every step is a partial aggregation
    or a join whose other side has one row per user (AQE splits a hot
    partition), so no task holds one user's sessions, whatever their number.
    """
    first_resp = first_match_struct("action_dt", "vacancy_id", "action_type", RESPONSE)
    known = validation.where(F.col("user_id").isNotNull() & F.col("session_dt").isNotNull())
    s = known.select("user_id", "session_id", "session_dt", first_resp.alias("fr"))
    groups = s.groupBy("user_id", "session_dt").agg(
        F.count(F.lit(1)).alias("c"),
        F.min(F.when(F.col("fr").isNotNull(), F.struct(
            F.col("fr.dt").alias("dt"), F.col("fr.item").alias("item"),
            F.col("session_id").alias("sid")))).alias("r"))
    first = groups.groupBy("user_id").agg(
        F.min(F.struct("session_dt", "c")).alias("g1"))
    eligible = (groups.join(first, "user_id")
                      .where(F.col("r").isNotNull()
                             & ((F.col("session_dt") > F.col("g1.session_dt")) | (F.col("g1.c") > 1))))
    target = eligible.groupBy("user_id").agg(F.min(F.struct(
        F.col("r.dt").alias("dt"), F.col("r.item").alias("item"), F.col("r.sid").alias("sid"),
        F.col("session_dt").alias("sdt"), F.col("c").alias("c"))).alias("t"))
    target = target.where(F.col("t.c") == 1)
    before = (groups.join(target, "user_id").where(F.col("session_dt") < F.col("t.sdt"))
                    .groupBy("user_id").agg(
                        F.max(F.struct("session_dt", "c")).alias("prev"),
                        F.sum("c").alias("cum"),
                        F.first("t").alias("t")))
    pairs = (before.where(F.col("prev.c") == 1)
                   .select("user_id", F.col("prev.session_dt").alias("session_dt"),
                           F.col("cum").cast("double").alias("val_session_rank"),
                           F.col("t.item").alias("target"), F.col("t.sdt").alias("target_dt")))
    size = F.size("vacancy_id")
    hist = known.where((size >= min_len) & (size <= max_len))
    return hist.join(pairs, ["user_id", "session_dt"])


def leave_last_out(sessions: DataFrame) -> DataFrame:
    """Sessions longer than one action whose last action is a response;
    ``next_item`` = the last item; item and action arrays lose their last
    element (``action_dt`` is kept whole, as in the source)."""
    return (sessions
            .where((F.size("action_type") > 1) & (last_element("action_type") == RESPONSE))
            .withColumn("next_item", last_element("vacancy_id"))
            .withColumn("vacancy_id", all_but_last("vacancy_id"))
            .withColumn("action_type", all_but_last("action_type")))
