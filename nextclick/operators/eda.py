"""Exploratory log statistics (R32-R35): frequency tables and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextclick.operators.dictionary import running_total
from nextclick.operators.sessions import interactions


def sample_sessions(sessions: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the sessions, the same ones however the
    rows are partitioned (by the MD5 of seed, user and session)."""
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("user_id").cast("string"), F.col("session_id")))
    return sessions.where(F.substring(mark, 1, 8) < F.lit(f"{int(fraction * 0xFFFFFFFF):08x}"))


def sessions_per_day(sessions: DataFrame, fraction: float | None = None, seed: int = 42) -> DataFrame:
    """Sessions per calendar day of their first action, ordered by day
    (S8). ``fraction`` samples sessions first."""
    src = sample_sessions(sessions, fraction, seed) if fraction else sessions
    return (src.groupBy(F.to_date("session_dt").alias("day"))
               .agg(F.count(F.lit(1)).alias("n_sessions")).orderBy("day"))


def sessions_per_user(sessions: DataFrame) -> DataFrame:
    """Number of sessions per user."""
    return sessions.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_sessions"))


def item_frequency(sessions: DataFrame) -> DataFrame:
    """Interactions per item over the exploded item arrays (an empty
    session, or a missing item, counts for none)."""
    return (sessions.select(F.explode("vacancy_id").alias("vacancy_id")).where(F.col("vacancy_id").isNotNull())
                    .groupBy("vacancy_id").agg(F.count(F.lit(1)).alias("n_interactions")))


def items_per_user(sessions: DataFrame) -> DataFrame:
    """Interactions (viewed items, repeats counted) per user."""
    flat = interactions(sessions, keep=["user_id"], with_position=False)
    return flat.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_items"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, sample std, min, quartiles (exact, linear
    interpolation) and max, all from the frequency table of the values and
    its running counts (``running_total``: no task sees all distinct values)."""
    freq = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("f"))
    counted = running_total(freq, "v", "f", "hi")
    whole = counted.agg(F.struct(F.sum("f").alias("n"), (F.sum(F.col("v") * F.col("f")) / F.sum("f")).alias("m")).alias("w")).scalar()
    ranked = counted.select("v", "f", "hi", (F.col("hi") - F.col("f")).alias("lo"), whole.alias("w")).select("v", "f", "hi", "lo", "w.n", "w.m")

    def value_at(place):
        return F.max(F.when((F.col("lo") <= place) & (place < F.col("hi")), F.col("v")))

    quartiles = []
    for name, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        place = (F.col("n") - 1) * F.lit(p)
        low, high = value_at(F.floor(place)), value_at(F.ceil(place))
        quartiles.append((low + (high - low) * F.max(place - F.floor(place))).alias(name))
    n = F.coalesce(F.sum("f"), F.lit(0))
    spread = F.sum(F.col("f") * (F.col("v") - F.col("m")) * (F.col("v") - F.col("m")))
    return ranked.agg(n.alias("count"), F.max("m").alias("mean"), F.when(n > 1, F.sqrt(spread / (n - 1))).alias("std"),
                      F.min("v").alias("min"), *quartiles, F.max("v").alias("max"))
