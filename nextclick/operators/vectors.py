"""Item representations: item-token dataset (R15), token-count vectors
(R6), ALS item vectors (R8), truncated-SVD item vectors (R7).

Vectors stay flat (``key, token, val``) until a block product needs them;
a popular item is never collected into one list row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextclick.operators.dictionary import encode, fit_dictionary
from nextclick.sources.tables import drop_table, materialise


def geo_user(user: str = "user_id", area: str = "area_id", region: str = "region_id"):
    """User + area + region as one key, NULL if any part is NULL; a
    separator keeps ``1``+``23`` apart from ``12``+``3``."""
    return F.concat(F.col(user).cast("string"), F.lit("|"), F.col(area).cast("string"),
                    F.lit("|"), F.col(region).cast("string"))


def hot_item_filter(positives: DataFrame, by: str = "user_id", min_count: int = 1) -> DataFrame:
    """Keep items with ``count(by) >= min_count`` (every item has one row)."""
    if min_count <= 1:
        return positives.where(F.col(by).isNotNull())
    hot = (positives.groupBy("vacancy_id").agg(F.count(by).alias("_n"))
                    .where(F.col("_n") >= min_count).select("vacancy_id"))
    return positives.join(hot, "vacancy_id", "left_semi")


def item_token_counts(train: DataFrame, vacancies: DataFrame, min_count: int = 1,
                      token: str = "user", dense_tokens: bool = True) -> DataFrame:
    """R15 + R6: flat token-count vectors ``key, token, val``.

    Train interactions are joined to the vacancy attributes, filtered to
    hot items, and each (item, token) pair is counted (a repeated token
    adds up, as a count vectoriser does). ``token="user"`` uses dense user
    ids (the source's default); ``token="geo"`` uses dense ids of
    user + area + region. ``dense_tokens=False`` keeps the raw key as the
    token (hashed for geo keys): cosine scores do not depend on token ids,
    so kNN callers skip the dictionary; int32 consumers (ALS) need it."""
    attrs = vacancies.select("vacancy_id", "area_id", "region_id")
    pos = train.select("user_id", "vacancy_id").join(attrs, "vacancy_id")
    pos = hot_item_filter(pos, "user_id", min_count)
    raw = geo_user() if token == "geo" else F.col("user_id")
    pos = pos.withColumn("_tok", raw).where(F.col("_tok").isNotNull())
    counts = pos.groupBy("vacancy_id", "_tok").agg(F.count(F.lit(1)).cast("double").alias("val"))
    if not dense_tokens:
        tok = F.xxhash64("_tok") if token == "geo" else F.col("_tok").cast("bigint")
        return counts.select(F.col("vacancy_id").alias("key"), tok.alias("token"), "val")
    vocab = fit_dictionary(pos, "_tok", "token")
    return (encode(counts, vocab, "_tok", "token")
            .select(F.col("vacancy_id").alias("key"), "token", "val"))


def text_token_counts(items: DataFrame, key: str, text: str) -> DataFrame:
    """H16 + counts: lower-cased words of two or more word characters
    (Unicode-aware), counted per item: ``key, token, val`` with the word
    as the token (hashed to a bigint id, the word kept alongside)."""
    # Texts are dealt by key before they become words, which take more room.
    texts = items.select(F.col(key).alias("key"), F.col(text).alias("_text")).repartition("key")
    words = F.regexp_extract_all(F.lower(F.col("_text")), F.lit(r"(?U)\b\w\w+\b"), 0)
    flat = texts.select("key", F.explode(words).alias("word"))
    return (flat.groupBy("key", "word").agg(F.count(F.lit(1)).cast("double").alias("val"))
                .withColumn("token", F.xxhash64("word")))


def fit_vocabulary(counts: DataFrame) -> DataFrame:
    """The words of an index with dense ids: ``word, token`` (H14), to be stored and joined to texts that come later."""
    return fit_dictionary(counts, "word", "token")


def known_words(counts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``key, token, val`` of the words that the vocabulary has; others are dropped, as a fitted count vectoriser does."""
    return counts.select("key", "word", "val").join(vocabulary, "word").select("key", "token", "val")


def als_item_vectors(counts: DataFrame, rank: int = 16, max_iter: int = 10, reg: float = 0.1,
                     alpha: float = 1.0, seed: int = 42) -> DataFrame:
    """Implicit ALS on the item x token counts with the item as the
    ALS "user"; the row factors are the item vectors ``key, vec``.
    Ids must fit int32, so both sides are dense-encoded (H14) first."""
    from pyspark.ml.recommendation import ALS

    items = fit_dictionary(counts, "key", "item_idx")
    data = encode(counts, items, "key", "item_idx")
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, implicitPrefs=True, alpha=alpha,
              userCol="item_idx", itemCol="token", ratingCol="val", seed=seed,
              coldStartStrategy="drop", nonnegative=False)
    model = als.fit(data.select(F.col("item_idx").cast("int"), F.col("token").cast("int"), "val"))
    factors = model.userFactors.select(F.col("id").cast("bigint").alias("item_idx"),
                                       F.col("features").cast("array<double>").alias("vec"))
    return factors.join(items, "item_idx").select("key", "vec")


def _orthonormal(d: DataFrame, width: int) -> tuple[DataFrame, int]:
    """Orthonormal basis of the columns of a tall matrix of rows ``key, vec``
    from the eigen-decomposition of its small Gram matrix; directions that
    are numerically absent are left out. A second pass removes what the
    first one's rounding leaves. ``d`` is a table that is dropped."""
    import numpy as np

    from nextclick.operators.linalg import gram, multiply_by_small

    for _ in range(2):
        evals, evecs = np.linalg.eigh(gram(d, width))
        there = evals > max(evals.max(), 0.0) * 1e-13
        if not there.any():
            raise ValueError("the matrix has no non-zero entry")
        before, d = d, materialise(multiply_by_small(d, evecs[:, there] / np.sqrt(evals[there])[None, :]), "svd_basis")
        drop_table(before)
        worst, width = evals[there].min() / evals.max(), int(there.sum())
        if worst > 1e-6:
            break
    return d, width


def svd_item_vectors(counts: DataFrame, k: int = 64, oversample: int = 10, power_iters: int = 5,
                     seed: int = 42) -> DataFrame:
    """Truncated SVD item vectors (not centred) of the item x token
    count matrix, by randomised range finding with DataFrame operations.

    Y = A G (G: Gaussian token x (k+p), generated from a hash of
    (token, column), never stored); ``power_iters`` rounds of
    Z = orth(Aᵀ Q), Q = orth(A Z) sharpen the spectrum, with a fresh
    orthonormal basis after every product, so that small singular values
    are not drowned by large ones; B = Qᵀ A; the eigen-decomposition of the small B Bᵀ gives
    U_B and s; item vectors = Q U_B diag(s) (= U Σ, what a truncated SVD's
    ``transform`` returns), with as many components as the matrix has, ``k`` at most.
    Only (k+p) x (k+p) matrices reach the driver;
    every pass is a join on item or token plus a ``groupBy`` sum.
    Signs of components are arbitrary: compare cosines, not coordinates.
    """
    import numpy as np

    from nextclick.operators.linalg import gram, multiply_by_small, sparse_t_times_dense, sparse_times_dense

    width = k + oversample
    a = materialise(counts.select("key", "token", "val"), "svd_entries")
    tokens = a.select("token").distinct()
    # Box-Muller from two hashes per (token, column): repeatable anywhere.
    def gaussian(jc):
        u1 = (F.pmod(F.xxhash64(F.lit(seed), F.col("token"), jc, F.lit(1)), F.lit(1 << 30)) + 1) \
            / F.lit(float(1 << 30) + 1)
        u2 = F.pmod(F.xxhash64(F.lit(seed), F.col("token"), jc, F.lit(2)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        return F.sqrt(-2 * F.log(u1)) * F.cos(2 * np.pi * u2)
    gauss = tokens.select(F.col("token").alias("key"),
                          F.transform(F.sequence(F.lit(0), F.lit(width - 1)), gaussian).alias("vec"))
    # Each product is written to the shared folder: it cuts the lineage of
    # the rounds and survives a lost executor. It is dropped after its use.
    q, width = _orthonormal(materialise(sparse_times_dense(a, gauss, width), "svd_product"), width)          # items x width
    for _ in range(power_iters):
        z, width = _orthonormal(materialise(sparse_t_times_dense(a, q, width), "svd_product"), width)        # tokens x width
        drop_table(q)
        q, width = _orthonormal(materialise(sparse_times_dense(a, z, width), "svd_product"), width)
        drop_table(z)
    bt = materialise(sparse_t_times_dense(a, q, width), "svd_product")   # tokens x width (= Bᵀ)
    evals, evecs = np.linalg.eigh(gram(bt, width))                # B Bᵀ
    for table in (bt, a):
        drop_table(table)
    order = np.argsort(evals)[::-1][:k]
    s = np.sqrt(np.clip(evals[order], 0, None))
    return multiply_by_small(q, evecs[:, order] * s[None, :])
