"""Session logs and dimensions derived by Spark from the driver's tables.

* F1 ``events_session_log``: events of type purchase / view / click, one
  session per user and day, item = ``props.k``.
* F2 ``orders_session_log``: orders joined to line items, one session per
  order, user = customer, item = part. ``l_linenumber`` is not unique inside
  an order, so a row position (``pos``) orders the lines and is added to
  the ship date in seconds; ``tie_times=True`` leaves it out (tie tests).
* F4 ``item_vectors``: ``embeddings`` as item vectors.
* F5 ``vacancies``: ``part`` as the vacancy dimension.

Raw session arrays are emitted in item order (not in time order), so the
session normalisation (R1) has real work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Event type -> action code (F1), return flag -> action code (F2).
EVENT_ACTIONS = {"purchase": 1, "view": 2, "click": 3}
RETURNFLAG_ACTIONS = {"R": 1, "N": 2}  # every other flag is 3

F1_TRAIN = ("2024-01-01", "2024-01-16")
F1_VALIDATION = ("2024-01-16", "2024-01-31")
F2_TRAIN = ("1995-01-01", "1998-01-01")
F2_VALIDATION = ("1998-01-01", "2002-01-01")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_interactions(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    """F1 as flat interactions ``user_id, session_id, vacancy_id, action_type, action_dt``.
    ``hot`` gives a third of all users' sessions to one user, 0."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin(*EVENT_ACTIONS))
    code = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in EVENT_ACTIONS.items()])
    user = F.when(F.lit(hot) & (F.col("user_id") % 3 == 0), F.lit(0)).otherwise(F.col("user_id"))
    return ev.select(
        user.cast("bigint").alias("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("_"),
                 F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("vacancy_id"),
        code.cast("int").alias("action_type"),
        F.col("ts").alias("action_dt"),
    )


def orders_interactions(spark: SparkSession, sf_dir: str, tie_times: bool = False) -> DataFrame:
    """F2 as flat interactions (one session per order)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    pos = F.row_number().over(
        W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    dt = F.col("l_shipdate")
    if not tie_times:
        dt = dt + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("pos").cast("decimal(18,6)"))
    code = F.coalesce(*[F.when(F.col("l_returnflag") == k, F.lit(v)) for k, v in RETURNFLAG_ACTIONS.items()],
                      F.lit(3))
    return (li.withColumn("pos", pos)
              .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
              .select(F.col("o_custkey").alias("user_id"),
                      F.col("l_orderkey").alias("_session_key"),
                      F.col("o_orderkey").cast("string").alias("session_id"),
                      F.col("l_partkey").alias("vacancy_id"),
                      code.cast("int").alias("action_type"),
                      dt.alias("action_dt")))


def to_session_log(interactions: DataFrame) -> DataFrame:
    """Flat interactions -> one row per session with three parallel arrays,
    in item order (raw, not yet normalised). A ``_session_key`` column, if
    present, is grouped on instead of the string id (F2: the order key the
    line-item window already partitions by, so no extra shuffle)."""
    if "_session_key" in interactions.columns:
        packed = interactions.groupBy("_session_key", "user_id").agg(
            F.first("session_id").alias("session_id"),
            F.sort_array(F.collect_list(F.struct("vacancy_id", "action_dt", "action_type"))).alias("a"))
        return packed.select(
            "user_id", "session_id",
            F.col("a.vacancy_id").alias("vacancy_id"),
            F.col("a.action_type").alias("action_type"),
            F.col("a.action_dt").alias("action_dt"))
    packed = interactions.groupBy("user_id", "session_id").agg(
        F.sort_array(F.collect_list(F.struct("vacancy_id", "action_dt", "action_type"))).alias("a"))
    return packed.select(
        "user_id", "session_id",
        F.col("a.vacancy_id").alias("vacancy_id"),
        F.col("a.action_type").alias("action_type"),
        F.col("a.action_dt").alias("action_dt"))


def events_session_log(spark: SparkSession, sf_dir: str, hot: bool = False) -> DataFrame:
    return to_session_log(events_interactions(spark, sf_dir, hot))


def orders_session_log(spark: SparkSession, sf_dir: str, tie_times: bool = False) -> DataFrame:
    return to_session_log(orders_interactions(spark, sf_dir, tie_times))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, vec array<double>`` from ``embeddings``."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("key"), F.col("embedding").cast("array<double>").alias("vec"))


def vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``vacancy_id, name, area_id, region_id`` from ``part``."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("vacancy_id"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("area_id"), F.col("p_type").alias("region_id"))
