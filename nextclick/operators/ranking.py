"""Filter, rank, pack, submit.

A "global sort by score" in the source only fixes list order, so ranking
here is a per-user ``row_number`` (no range shuffle) with explicit tie
breaks, and packing keeps the top ``k`` with ``WindowGroupLimit``
(partial top-k before the shuffle, so a hot user does not move all rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nextclick.schemas import RESPONSE


# ---------------------------------------------------------------- R21
def responses(history: DataFrame, code: int = RESPONSE) -> DataFrame:
    """B5 + distinct keys: the (user, item) pairs the user responded to."""
    return (history.where(F.col("action_type") == code)
                   .select("user_id", "vacancy_id").distinct())


def seen_filter(cands: DataFrame, history: DataFrame, only_responses: bool = True,
                observations: tuple | None = None) -> DataFrame:
    """Drop (user, item) pairs found in ``history`` (its responses by
    default; ``only_responses=False`` drops every seen pair).

    D13: pass ``(Observation("before"), Observation("after"))`` to get the
    row counts before and after the filter from the same job that computes
    the result (``DataFrame.observe``), not from extra ``count()`` jobs."""
    seen = responses(history) if only_responses else history.select("user_id", "vacancy_id").distinct()
    if observations:
        cands = cands.observe(observations[0], F.count(F.lit(1)).alias("rows"))
    out = cands.join(seen, ["user_id", "vacancy_id"], "left_anti")
    if observations:
        out = out.observe(observations[1], F.count(F.lit(1)).alias("rows"))
    return out


# ---------------------------------------------------------------- R18-R20
def random_score(seed: int = 42) -> Column:
    """A repeatable pseudo-random score in [0, 1) from the MD5 of seed,
    user and item (unlike ``rand()``, it does not change with the
    partitioning): its first 52 bits."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("user_id").cast("string"), F.col("vacancy_id").cast("string")))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def random_ranker(cands: DataFrame, name: str = "random_ranker", seed: int = 42) -> DataFrame:
    return cands.withColumn(name, random_score(seed))


def constant_ranker(cands: DataFrame, name: str = "constant_ranker") -> DataFrame:
    """Score 1 for every row; the order then comes from the tie-break
    keys given to ``rank``/``pack`` (the generator's own score)."""
    return cands.withColumn(name, F.lit(1.0))


class LinearScorer:
    """A model given by its weights: bias + sum of weight * feature."""

    def __init__(self, weights: list[float], bias: float = 0.0):
        self.weights, self.bias = list(weights), bias

    def transform(self, df: DataFrame, features: str, out: str) -> DataFrame:
        from pyspark.ml.functions import vector_to_array

        x = vector_to_array(F.col(features))
        return df.withColumn(out, sum((F.lit(w) * x[i] for i, w in enumerate(self.weights)), F.lit(self.bias)))


def feature_ranker(cands: DataFrame, model, features: list[str], name: str = "model_score",
                   fill: float = 0.0) -> DataFrame:
    """Assemble named features (NULL -> ``fill``), score with any fitted
    Spark ML model or a ``LinearScorer``, append the positive-class probability (or the
    prediction for regressors) as ``name``."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    tmp = "__features"
    # fill only the model inputs; the candidate columns keep their NULLs
    inputs = [f"__in_{i}" for i in range(len(features))]
    filled = cands.withColumns({c: F.coalesce(F.col(f).cast("double"), F.lit(float(fill)))
                                for c, f in zip(inputs, features)})
    assembled = VectorAssembler(inputCols=inputs, outputCol=tmp).transform(filled)
    scored = model.transform(assembled, tmp, name) if isinstance(model, LinearScorer) else model.transform(assembled)
    if isinstance(model, LinearScorer):
        score = F.col(name)
    elif "probability" in scored.columns:
        score = vector_to_array(F.col("probability"))[1]
    else:
        score = F.col(model.getOrDefault("predictionCol"))
    scored = scored.withColumn(name, score)
    return scored.drop(*[c for c in scored.columns if c not in cands.columns and c != name])


def training_table(cands: DataFrame, truth: DataFrame, negatives: int = 10, seed: int = 42, target: str = "target") -> DataFrame:
    """R20, fit side: candidates of the truth's users with ``label`` (1: the target), all positive rows and per user the ``negatives`` other
    rows of the lowest MD5 of seed, user and item: the same ones on every run. Users whose target no generator found teach nothing."""
    targets = truth.select("user_id", F.col(target).alias("vacancy_id"), F.lit(1).alias("label")).distinct()
    labelled = cands.join(targets, ["user_id", "vacancy_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))
    found = labelled.where("label = 1").select("user_id").distinct()
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("user_id").cast("string"), F.col("vacancy_id").cast("string")))
    place = F.row_number().over(W.partitionBy("user_id", "label").orderBy(mark, "vacancy_id"))
    return (labelled.join(found, "user_id", "left_semi").withColumn("_p", place)
                    .where((F.col("label") == 1) | (F.col("_p") <= negatives)).drop("_p"))


def fit_ranker(training: DataFrame, features: list[str], path: str, max_iter: int = 20, max_depth: int = 4, seed: int = 42,
               fill: float = 0.0) -> str:
    """Boosted trees on a training table, saved as a pipeline model in ``path`` (a shared folder)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    filled = training.select(*(F.coalesce(F.col(f).cast("double"), F.lit(float(fill))).alias(f) for f in features), F.col("label").cast("double"))
    trees = GBTClassifier(featuresCol="__features", labelCol="label", maxIter=max_iter, maxDepth=max_depth, seed=seed)
    Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="__features"), trees]).fit(filled).write().overwrite().save(path)
    return path


def trained_ranker(cands: DataFrame, path: str, features: list[str], name: str = "model_score", fill: float = 0.0) -> DataFrame:
    """R20, predict side: the stored model's probability of a response, as ``name``."""
    from pyspark.ml import PipelineModel

    return feature_ranker(cands, PipelineModel.load(path).stages[-1], features, name, fill)


# ---------------------------------------------------------------- R22
def rank(cands: DataFrame, order: list[Column], k: int | None = None,
         keys: list[str] | None = None) -> DataFrame:
    """Per-user (or per ``keys``) 1-based position by ``order``; with ``k``,
    positions > k are dropped (partial top-k before the shuffle)."""
    pos = F.row_number().over(W.partitionBy(*(keys or ["user_id"])).orderBy(*order))
    out = cands.withColumn("pos", pos)
    return out.where(F.col("pos") <= k) if k is not None else out


def pack(ranked: DataFrame, item: str = "vacancy_id", out: str = "predictions",
         keys: list[str] | None = None) -> DataFrame:
    """One ordered list per user (or per ``keys``) from ``pos, item``.
    The list length is bounded by the ``k`` given to ``rank``."""
    lst = F.transform(F.array_sort(F.collect_list(F.struct("pos", item))), lambda s: s[item])
    return ranked.groupBy(*(keys or ["user_id"])).agg(lst.alias(out))


# ---------------------------------------------------------------- R23
def submission(skeleton: DataFrame, recs: DataFrame, how: str = "full") -> DataFrame:
    """Skeleton ``(user_id, session_id)`` joined to packed lists on
    ``user_id``; a missing list becomes ``[]``. ``how="full"`` keeps
    recommended users absent from the skeleton (NULL session id)."""
    joined = skeleton.select("user_id", "session_id").join(recs.select("user_id", "predictions"),
                                                           "user_id", how)
    empty = F.array().cast("array<bigint>")
    return joined.withColumn("predictions", F.coalesce(F.col("predictions"), empty))
