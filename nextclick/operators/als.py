"""User -> item recommendations with implicit ALS (R16) and the cold-user
fallback (R17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextclick.functions.weights import ALS_WEIGHTS, map_weight
from nextclick.operators.als_rounds import rounds
from nextclick.operators.dictionary import encode, fit_dictionary
from nextclick.operators.knn import streamed_topk
from nextclick.sources.tables import materialise


def user_item_matrix(train: DataFrame, weights: dict[int, float] | None = None,
                     strict: bool = True) -> DataFrame:
    """B10 + D10: ``user_id, vacancy_id, weight`` with duplicate pairs summed
    (as a sparse matrix built from coordinates adds them)."""
    w = map_weight(F.col("action_type"), weights or ALS_WEIGHTS, strict)
    return (train.select("user_id", "vacancy_id", w.alias("weight"))
                 .groupBy("user_id", "vacancy_id").agg(F.sum("weight").alias("weight")))


class AlsRecommender:
    """Implicit ALS on the weighted user x item matrix. Ids are dense-encoded
    first (ALS needs int32 ids). Spark's ALS checks the ratings and draws the
    random start; the rounds (``als_rounds``) solve the same equations at a
    cost that follows a user's few items, not the cube of the rank."""

    def __init__(self, rank: int = 150, max_iter: int = 25, reg: float = 0.001, alpha: float = 1.0,
                 seed: int = 42, weights: dict[int, float] | None = None):
        self.rank, self.max_iter, self.reg, self.alpha, self.seed = rank, max_iter, reg, alpha, seed
        self.weights = weights

    def fit(self, train: DataFrame) -> "AlsRecommender":
        from pyspark.ml.recommendation import ALS

        m = user_item_matrix(train, self.weights)
        self.users = fit_dictionary(m, "user_id", "u")
        self.items = fit_dictionary(m, "vacancy_id", "i")
        coded = encode(encode(m, self.users, "user_id", "u"), self.items, "vacancy_id", "i")
        self.matrix = coded.select("user_id", "vacancy_id", "u", "i", "weight")
        als = ALS(rank=self.rank, maxIter=0, regParam=self.reg, implicitPrefs=True,
                  alpha=self.alpha, seed=self.seed, userCol="u", itemCol="i", ratingCol="weight",
                  coldStartStrategy="drop")
        ratings = materialise(self.matrix.select(F.col("u").cast("int"), F.col("i").cast("int"), F.col("weight").cast("float")), "als_ratings")
        start = als.fit(ratings)
        self.user_factors, self.item_factors = rounds(ratings, start.userFactors, start.itemFactors, self.rank, self.max_iter, self.reg, self.alpha)
        return self

    def recommend(self, users: DataFrame, n: int = 100, block_rows: int = 8192) -> DataFrame:
        """Top ``n`` items per known user by predicted preference, items the
        user already has left out exactly: a known pair travels to the user's
        block and is masked with the block of items it is in, so no
        over-fetch is needed, a user with very many known items never has
        them in memory together, and exactly ``n`` rows (or all unknown
        items) come out per user. Returns ``user_id, vacancy_id, score, pos``."""
        wanted = (encode(users.select("user_id").distinct(), self.users, "user_id", "u")
                  .where(F.col("u").isNotNull()).select("u"))
        uf = (self.user_factors.select(F.col("id").cast("bigint").alias("key"),
                                            F.col("features").cast("array<double>").alias("vec"))
              .join(wanted.select(F.col("u").alias("key")), "key", "left_semi"))
        itf = self.item_factors.select(F.col("id").cast("bigint").alias("key"),
                                            F.col("features").cast("array<double>").alias("vec"))
        known = (self.matrix.select(F.col("u").cast("bigint").alias("key"), F.col("i").alias("other"))
                 .join(wanted.select(F.col("u").alias("key")), "key", "left_semi"))
        top = streamed_topk(uf, n, candidates=itf, exclude=known, block_rows=block_rows)
        top = top.select(F.col("anchor_vacancy_id").alias("u"), F.col("recom_vacancy_id").alias("i"),
                         "score", "pos")
        return (top.join(self.users, "u").join(self.items, "i")
                   .select("user_id", "vacancy_id", "score", "pos"))


def fallback_predictions(test_sessions: DataFrame, train: DataFrame, recs: DataFrame) -> DataFrame:
    """Per test session, a user unseen in train gets the session's own
    items (score 0, session order); a known user gets the model's list.
    Returns ``user_id, session_id, vacancy_id, score, pos``."""
    train_users = train.select("user_id").distinct()
    flat = test_sessions.select("user_id", "session_id",
                                F.posexplode_outer("vacancy_id").alias("p0", "vacancy_id"))
    cold = (flat.join(train_users, "user_id", "left_anti")
                .select("user_id", "session_id", "vacancy_id", F.lit(0.0).alias("score"),
                        (F.col("p0") + 1).alias("pos")))
    warm = (test_sessions.select("user_id", "session_id").join(train_users, "user_id", "left_semi")
                         .join(recs, "user_id"))
    return cold.unionByName(warm.select("user_id", "session_id", "vacancy_id", "score", "pos"))
