"""Candidate generators and their merge.

Every generator returns ``user_id, vacancy_id, <name>_score`` with one row
per (user, item) (max-reduced). Score direction: continue-search scores are
"lower is better" (ln of a recency rank); all others are "higher is better".
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nextclick.functions.weights import CONTINUE_SEARCH_WEIGHTS, map_weight
from nextclick.operators.dictionary import dense_rank_within
from nextclick.sources.tables import materialise


def reduce_max(cands: DataFrame, name: str, score: str = "score") -> DataFrame:
    """D1 + rename: max score per (user, item), named ``<name>_score``."""
    return (cands.groupBy("user_id", "vacancy_id")
                 .agg(F.max(score).alias(f"{name}_score")))


# ---------------------------------------------------------------- R25
def _weighted(inter: DataFrame, weights: dict[int, float], strict: bool) -> DataFrame:
    return inter.select("user_id", "vacancy_id", "action_type", "action_dt",
                        map_weight(F.col("action_type"), weights, strict).alias("action_weight"))


def continue_search(train: DataFrame, test: DataFrame,
                    weights: dict[int, float] | None = None, strict: bool = True,
                    drop_seen_responses: bool = False) -> DataFrame:
    """Items the test users already touched, newest first.

    ``train`` and ``test`` are flat interactions. Per (user, item) the row
    with the heaviest action weight wins (then the latest ``action_dt``);
    only the test users' train rows take part (a left-semi join, never a
    collected id list; AQE broadcasts the user side when it is small). Score
    = ln(dense rank of ``action_dt``, newest = 1), lower is better. The
    two-step (fit, predict) reduction of the source is one ``groupBy`` here:
    an arg-max is associative and Spark splits it into partial and final
    aggregation. The rank is found without a window over a user
    (``dense_rank_within``). Rows without a user have no rank and give no candidate.

    ``drop_seen_responses=True`` fuses the seen filter (R21 with the same
    train history): the same aggregation flags pairs with a train response
    and drops them, saving the anti join's two shuffles. Ranks are computed
    before the drop, as with a separate filter.
    """
    weights = weights or CONTINUE_SEARCH_WEIGHTS
    users = test.select("user_id").distinct()
    tr = _weighted(train.join(users, "user_id", "left_semi"), weights, strict)
    te = _weighted(test.where(F.col("user_id").isNotNull()), weights, strict)
    rows = (tr.withColumn("_seen", F.col("action_type") == F.lit(1))
              .unionByName(te.withColumn("_seen", F.lit(False))))
    best = (rows.groupBy("user_id", "vacancy_id")
                .agg(F.max_by(F.struct("action_type", "action_dt"),
                              F.struct("action_weight", "action_dt")).alias("b"),
                     F.max("_seen").alias("_seen")))
    best = materialise(best.select("user_id", "vacancy_id", F.col("b.action_dt").alias("_dt"), "_seen"), "continue_search")
    ranked = dense_rank_within(best, "user_id", "_dt", descending=True, out="_r")
    out = ranked.select("user_id", "vacancy_id", F.log(F.col("_r").cast("double")).alias("score"), "_seen")
    if drop_seen_responses:
        out = out.where(~F.col("_seen"))
    return out.drop("_seen")


# ---------------------------------------------------------------- D14
def _heaviest(rows: DataFrame, keys: list[str]) -> DataFrame:
    best = rows.groupBy(*keys).agg(F.max(F.struct("action_weight", "action_dt")).alias("_b"), F.max("seen").alias("seen"))
    return best.select(*keys, "_b.action_weight", "_b.action_dt", "seen")


def continue_search_state(train: DataFrame, by: list[str] | None = None, weights: dict[int, float] | None = None, strict: bool = True) -> DataFrame:
    """D14, fit: the reduced train table ``user_id, vacancy_id, action_weight, action_dt, seen`` (the heaviest row, then the latest;
    ``seen``: any response), one row per (user, item), or per ``by`` and these, such as the day. An arg-max is associative: states of any
    parts of the rows merge into the state of all."""
    keys = [*(by or []), "user_id", "vacancy_id"]
    w = map_weight(F.col("action_type"), weights or CONTINUE_SEARCH_WEIGHTS, strict)
    rows = train.select(*keys, w.alias("action_weight"), "action_dt", (F.col("action_type") == F.lit(1)).alias("seen"))
    return _heaviest(rows, keys)


def merge_states(*states: DataFrame) -> DataFrame:
    """One state of several."""
    columns = ["user_id", "vacancy_id", "action_weight", "action_dt", "seen"]
    rows = reduce(DataFrame.unionByName, [s.select(*columns) for s in states])
    return _heaviest(rows, ["user_id", "vacancy_id"])


def continue_search_from_state(state: DataFrame, test: DataFrame, drop_seen_responses: bool = False) -> DataFrame:
    """D14, predict: R25 from a stored state (of one part or of many, merged here) and the test users' own rows; no train row is read."""
    users = test.select("user_id").distinct()
    own = continue_search_state(test.where(F.col("user_id").isNotNull())).withColumn("seen", F.lit(False))
    best = materialise(merge_states(state.join(users, "user_id", "left_semi"), own).drop("action_weight"), "continue_search")
    ranked = dense_rank_within(best, "user_id", "action_dt", descending=True, out="_r")
    out = ranked.where(~F.col("seen")) if drop_seen_responses else ranked
    return out.select("user_id", "vacancy_id", F.log(F.col("_r").cast("double")).alias("score"))


# ---------------------------------------------------------------- R13
def i2i_candidates(history: DataFrame, i2i: DataFrame) -> DataFrame:
    """Join the user's items to the item-to-item list on the anchor;
    max score per (user, item). ``i2i`` is flat
    ``anchor_vacancy_id, recom_vacancy_id, score``."""
    anchors = history.select("user_id", F.col("vacancy_id").alias("anchor_vacancy_id")).distinct()
    return (anchors.join(i2i, "anchor_vacancy_id")
                   .groupBy("user_id", F.col("recom_vacancy_id").alias("vacancy_id"))
                   .agg(F.max("score").alias("score")))


def i2i_topk_candidates(history: DataFrame, i2i: DataFrame, kneib: int = 20) -> DataFrame:
    """R13, then dense rank of the score (descending) <= ``kneib``
    per user; ties are kept, so a user may get more than ``kneib`` rows."""
    cands = i2i_candidates(history, i2i)
    rank = F.dense_rank().over(W.partitionBy("user_id").orderBy(F.col("score").desc()))
    return cands.withColumn("r", rank).where(F.col("r") <= kneib).drop("r")


# ---------------------------------------------------------------- R11, R12
def round_robin(history: DataFrame, i2i: DataFrame) -> DataFrame:
    """Merge the neighbour lists of a user's items: all first
    neighbours (lists in order of the item's latest ``action_dt``, newest
    first, then item id), then all second neighbours, ...; an item keeps its
    first appearance. Returns ``user_id, vacancy_id, pos`` (1-based).
    ``i2i`` is flat with a 1-based ``pos``.

    Both orders are unique inside a user, so a dense rank is the row
    number; ``dense_rank_within`` finds it without a window over a user's
    pool. Rows without a user have no rank and give nothing."""
    latest = (history.where(F.col("user_id").isNotNull()).groupBy("user_id", "vacancy_id")
                     .agg(F.max("action_dt").alias("last_dt")))
    keyed = materialise(latest.withColumn("_o", F.struct("last_dt", (-F.col("vacancy_id")).alias("nid"))), "round_robin_lists")
    lists = dense_rank_within(keyed, "user_id", "_o", descending=True, out="list_idx").drop("_o")
    lists = lists.withColumnRenamed("vacancy_id", "anchor_vacancy_id")
    first = (lists.join(i2i, "anchor_vacancy_id")
                  .groupBy("user_id", F.col("recom_vacancy_id").alias("vacancy_id"))
                  .agg(F.min(F.struct(F.col("pos").alias("npos"), "list_idx")).alias("f")))
    first = materialise(first, "round_robin_first")
    return dense_rank_within(first, "user_id", "f", descending=False, out="pos").drop("f")


def unique_neighbours(history: DataFrame, i2i: DataFrame) -> DataFrame:
    """The distinct set of neighbours of a user's items."""
    anchors = history.select("user_id", F.col("vacancy_id").alias("anchor_vacancy_id")).distinct()
    return (anchors.join(i2i, "anchor_vacancy_id")
                   .select("user_id", F.col("recom_vacancy_id").alias("vacancy_id")).distinct())


# ---------------------------------------------------------------- R26
def popular_items(interactions: DataFrame, k: int = 100, action: int | None = 1) -> DataFrame:
    """A fixed scored list taken from the data: the ``k`` items with most
    interactions (of ``action``, if given); score = that count."""
    src = interactions if action is None else interactions.where(F.col("action_type") == action)
    counts = src.groupBy("vacancy_id").agg(F.count(F.lit(1)).cast("double").alias("score"))
    # A global top-k (the limit is the feature): Spark plans it as a top-k per
    # partition merged at the end, so no task sorts all items.
    return counts.orderBy(F.col("score").desc(), F.col("vacancy_id")).limit(k)


def constant_candidates(users: DataFrame, items: DataFrame) -> DataFrame:
    """Every user x a fixed scored list (``vacancy_id, score``).

    The result is the product, so the list goes once to each share of the
    users (as many shares as shuffle partitions) and meets them in an equi-join on
    the share; the list may have any length and is not inlined."""
    shares = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = users.select("user_id").distinct().withColumn("_share", F.pmod(F.xxhash64("user_id"), F.lit(shares)).cast("int"))
    listed = items.select(F.col("vacancy_id").cast("bigint").alias("vacancy_id"), F.col("score").cast("double").alias("score"),
                          F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("_share"))
    return own.join(listed, "_share").drop("_share")


# ---------------------------------------------------------------- R24
def join_candidates(generators: dict[str, DataFrame], how: str = "union") -> DataFrame:
    """Merge N max-reduced generators on (user_id, vacancy_id); a
    generator that did not propose a pair leaves NULL (not 0).

    ``how="union"`` (default): ``unionByName`` + one ``groupBy`` with a
    max per generator, one shuffle for any N. ``how="outer"``: the
    full-outer fold of the source (N - 1 joins), kept for comparison."""
    if not generators:
        raise ValueError("join_candidates needs at least one generator")
    names = list(generators)
    if how == "outer":
        frames = [reduce_max(df, n) for n, df in generators.items()]
        return reduce(lambda a, b: a.join(b, ["user_id", "vacancy_id"], "full"), frames)
    parts = []
    for n, df in generators.items():
        cols = [F.col("score").cast("double").alias(f"{m}_score") if m == n
                else F.lit(None).cast("double").alias(f"{m}_score") for m in names]
        parts.append(df.select("user_id", "vacancy_id", *cols))
    merged = reduce(DataFrame.unionByName, parts)
    return merged.groupBy("user_id", "vacancy_id").agg(
        *[F.max(f"{m}_score").alias(f"{m}_score") for m in names])


# ---------------------------------------------------------------- R17
def cold_user_items(test: DataFrame, train_users: DataFrame) -> DataFrame:
    """R17 (cold branch): a test user unseen in train gets their own
    session's items in session order, score 0."""
    cold = test.join(train_users.select("user_id").distinct(), "user_id", "left_anti")
    return cold.select("user_id", "session_id", "vacancy_id", "pos", F.lit(0.0).alias("score"))
