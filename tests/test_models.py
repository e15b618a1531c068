"""Invariants and brute-force checks for the non-unique operators."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from conftest import SF001
from nextclick.operators import als_rounds, ann, knn, linalg, lsh
from nextclick.operators import ranking as R
from nextclick.operators import vectors as V
from nextclick.operators.als import AlsRecommender, fallback_predictions, user_item_matrix
from nextclick.plans import catalog, models
from nextclick.sources import fixtures as fx
from nextclick.sources.tables import materialise, tables_dir


def test_randomised_svd_matches_numpy(spark):
    rng = np.random.default_rng(0)
    A = (rng.random((60, 40)) < 0.2) * rng.integers(1, 5, (60, 40)).astype(float)
    it, tok = np.nonzero(A)
    df = spark.createDataFrame(pd.DataFrame({"key": it.astype(np.int64), "token": tok.astype(np.int64),
                                             "val": A[it, tok]}))
    k = 5
    got = V.svd_item_vectors(df, k=k).toPandas().sort_values("key")
    Y = np.vstack(got["vec"].to_numpy())
    U, s, _ = np.linalg.svd(A, full_matrices=False)
    want = U[:, :k] * s[:k]
    present = got["key"].to_numpy()
    # singular values and the spanned subspace agree (signs are arbitrary)
    assert np.allclose(np.linalg.norm(Y, axis=0), s[:k], rtol=1e-3)
    # randomised range finding is approximate (as is a randomised truncated
    # SVD): the vectors lie in the top-k subspace up to a small residual
    proj = want[present] @ np.linalg.pinv(want[present]) @ Y
    assert np.linalg.norm(proj - Y) / np.linalg.norm(Y) < 0.02


def test_svd_keeps_small_components(spark):
    """A fast-falling spectrum: every singular value within 1 %, at default parameters."""
    rng = np.random.default_rng(1)
    u = np.linalg.qr(rng.normal(size=(60, 32)))[0]
    v = np.linalg.qr(rng.normal(size=(50, 32)))[0]
    A = (u * 100 * 0.65 ** np.arange(32)) @ v.T
    it, tok = np.nonzero(A)
    df = spark.createDataFrame(pd.DataFrame({"key": it.astype(np.int64), "token": tok.astype(np.int64), "val": A[it, tok]}))
    Y = np.vstack(V.svd_item_vectors(df, k=32).toPandas()["vec"].to_numpy())
    assert np.allclose(np.linalg.norm(Y, axis=0), 100 * 0.65 ** np.arange(32), rtol=0.01)


@pytest.mark.parametrize("shape", [(7, 900), (300, 90)])
def test_products_with_a_small_matrix(spark, shape, monkeypatch):
    """Both products against NumPy, an entry without its row of D is dropped, and no entry becomes a vector that Spark sorts."""
    monkeypatch.setattr(linalg, "HELD", 64)
    rng = np.random.default_rng(2)
    a = (rng.random(shape) < 0.3) * rng.integers(1, 5, shape)
    it, tok = np.nonzero(a)
    df = spark.createDataFrame(pd.DataFrame({"key": it.astype(np.int64), "token": tok.astype(np.int64), "val": a[it, tok].astype(float)}))
    for product, m in ((linalg.sparse_times_dense, a), (linalg.sparse_t_times_dense, a.T)):
        d = rng.normal(size=(m.shape[1], 6))
        out = product(df, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(d[1:], 1)], "key long, vec array<double>"), 6)
        assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
        got = {r.key: r.vec for r in out.collect()}
        m, d = m[:, 1:], d[1:]
        assert set(got) == set(np.flatnonzero(m.any(axis=1)).tolist())
        assert all(np.allclose(got[i], m[i] @ d) for i in got)


def test_svd_drops_its_tables(spark):
    df = spark.createDataFrame([(i, i * j % 23, 1.0 + j) for i in range(30) for j in range(9)], "key long, token long, val double")
    df = df.groupBy("key", "token").agg(F.sum("val").alias("val"))
    tables = lambda: {f for f in os.listdir(tables_dir(spark).removeprefix("file:")) if f.startswith("svd_")}
    materialise(df, "svd_other")
    before = tables()
    assert V.svd_item_vectors(df, k=30).count() == 30
    assert len(tables() - before) == 1  # the basis that the result reads


def test_als_recommendations_exclude_known_items(spark):
    p = catalog.f1(spark, SF001)
    model = AlsRecommender(rank=8, max_iter=5).fit(p.train)
    recs = model.recommend(p.test, 10).cache()
    known = user_item_matrix(p.train).select("user_id", "vacancy_id")
    assert recs.join(known, ["user_id", "vacancy_id"]).count() == 0
    per_user = recs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("m")).collect()
    assert per_user and all(r.n == r.m <= 10 for r in per_user)
    # scores are non-increasing along the list
    w = recs.toPandas().sort_values(["user_id", "pos"])
    assert all((g.score.diff().dropna() <= 1e-12).all() for _, g in w.groupby("user_id"))
    n_items = known.select("vacancy_id").distinct().count()
    n_known = known.groupBy("user_id").count().toPandas().set_index("user_id")["count"]
    for r in per_user:  # a user gets min(10, unseen items) recommendations
        assert r.n == min(10, n_items - n_known[r.user_id])


def _als_ratings():
    """A busy user (0), an item that nearly all have (0), weights of both signs and zero; the other users have few items."""
    rng = np.random.default_rng(3)
    pairs = {(0, i) for i in range(40)} | {(u, 0) for u in range(1, 70)} | {(u, int(i)) for u in range(70) for i in rng.integers(0, 45, u % 6)}
    return [(u, i, float(rng.choice([1.0, 4.0, 2.5, -1.0, 0.0]))) for u, i in sorted(pairs)]


@pytest.mark.parametrize("per_block, reg", [(20, 0.01), (10_000, 0.01), (20, 2.0)])
def test_als_rounds_equal_sparks(spark, monkeypatch, per_block, reg):
    monkeypatch.setattr(als_rounds, "FEW_RATINGS", per_block)
    rows = spark.createDataFrame(_als_ratings(), "u int, i int, weight float").cache()
    als = lambda n: ALS(rank=6, maxIter=n, regParam=reg, implicitPrefs=True, alpha=1.5, seed=42, userCol="u", itemCol="i", ratingCol="weight").fit(rows)
    start, whole = als(0), als(4)
    got = als_rounds.rounds(rows, start.userFactors, start.itemFactors, 6, 4, reg, 1.5)
    for have, want in zip(got, (whole.userFactors, whole.itemFactors), strict=True):
        have, want = ({r.id: list(r.features) for r in f.collect()} for f in (have, want))
        assert have.keys() == want.keys()
        assert all(np.allclose(have[k], want[k], rtol=1e-3, atol=1e-4) for k in want)


def test_als_rows_with_few_ratings_take_small_systems(monkeypatch):
    """100 users with 3 items each at rank 150: no 150 x 150 system is solved."""
    sizes, solve = set(), np.linalg.solve
    monkeypatch.setattr(np.linalg, "solve", lambda a, b: sizes.add(a.shape[-1]) or solve(a, b))
    rng = np.random.default_rng(1)
    y = rng.normal(size=(30, 150)).astype(np.float32)
    users, items = np.repeat(np.arange(100, dtype=np.int32), 3), np.tile(np.arange(30, dtype=np.int32), 10)
    block = als_rounds._Block(0, 150, 0.1, 1.0)
    block.take(als_rounds.RATINGS, users.tobytes(), items.tobytes(), np.full(300, 4, np.float32).tobytes(), None, None)
    gram = y.astype(float).T @ y
    block.take(als_rounds.MESSAGE, np.arange(30, dtype=np.int32).tobytes(), b"", y.tobytes(), b"", gram[np.triu_indices(150)].tobytes())
    (row,) = block.finish(1, send=False, keep=True)
    x = np.frombuffer(row.column("values")[0].as_py(), np.float32).reshape(100, 150)
    assert sizes == {3}
    own = y[:3].astype(float)
    assert np.allclose(x[0], solve(gram + 0.3 * np.eye(150) + 4 * own.T @ own, 5 * own.sum(axis=0)), atol=1e-4)


def test_fallback_cold_users_get_own_items(spark):
    test = spark.createDataFrame([(1, "a", [5, 6]), (2, "b", [7])], "user_id long, session_id string, vacancy_id array<long>")
    train = spark.createDataFrame([(2, 9)], "user_id long, vacancy_id long")
    recs = spark.createDataFrame([(2, 3, 0.5, 1)], "user_id long, vacancy_id long, score double, pos int")
    got = sorted(tuple(r) for r in fallback_predictions(test, train, recs).collect())
    assert got == [(1, "a", 5, 0.0, 1), (1, "a", 6, 0.0, 2), (2, "b", 3, 0.5, 1)]


def test_ivf_and_cluster_knn_invariants(spark):
    vecs = fx.item_vectors(spark, SF001)
    exact = knn.dense_i2i(vecs, asked=20)
    approx = ann.ivf_i2i(vecs, nlist=4, asked=20).cache()
    assert approx.where(F.col("anchor_vacancy_id") == F.col("recom_vacancy_id")).count() == 0
    assert {r["count"] for r in approx.groupBy("anchor_vacancy_id").count().collect()} == {19}   # full lists
    recalls = [ann.recall_at_k(ann.ivf_i2i(vecs, nlist=8, nprobe=n, asked=20), exact).first().recall for n in (1, 6, 8)]
    assert recalls[0] < recalls[1] < recalls[2] == pytest.approx(1.0)
    crowded = ann.ivf_i2i(vecs, nlist=200, nprobe=1, asked=100)   # cells smaller than a list: further ones are asked
    assert {r["count"] for r in crowded.groupBy("anchor_vacancy_id").count().collect()} == {99}
    ck = ann.cluster_knn(vecs, n_clusters=5, top_size=30)
    sizes = ck.groupBy("anchor_vacancy_id").count().collect()
    assert len(sizes) == 500 and all(s["count"] == 30 for s in sizes)


@pytest.mark.parametrize("sf", [SF001, "/root/testdata/sf0.1"])
def test_approximate_lists_reach_their_recall(spark, sf):
    """Both forms of R9 at the parameters of their queries: recall of 0.9, full lists; LSH scores at most a third of all pairs."""
    vecs = fx.item_vectors(spark, sf)
    n = vecs.count()
    ivf = ann.ivf_i2i(vecs, **models.IVF_EMBEDDINGS)
    assert ann.recall_at_k(ivf, knn.dense_i2i(vecs, asked=models.IVF_EMBEDDINGS["asked"])).first().recall >= 0.9
    scored = spark.sparkContext.accumulator(0)
    lists = lsh.lsh_i2i(vecs, **models.LSH_EMBEDDINGS, scored=scored).cache()
    found = ann.recall_at_k(lists, knn.dense_i2i(vecs, asked=models.LSH_EMBEDDINGS["asked"])).first()
    assert found.recall >= 0.9 and 0 < scored.value <= n * (n - 1) / 2 / 3
    sizes = lists.groupBy("anchor_vacancy_id").agg(F.count("*").alias("n"), F.countDistinct("recom_vacancy_id").alias("m")).collect()
    assert len(sizes) == n and {(s.n, s.m) for s in sizes} == {(19, 19)}


def test_lsh_with_small_blocks_is_the_same_and_short_lists_are_filled(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(12, 16))
    mat = np.vstack([centers[i % 12] + 0.05 * rng.normal(size=16) for i in range(240)] + [-centers[:3], np.zeros((1, 16)), centers[:1], centers[:1]])
    vecs = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(mat)], "key long, vec array<double>")
    rows = lambda **kw: {tuple(r) for r in lsh.lsh_i2i(vecs, asked=11, cosine=0.95, recall=0.99, bits=8, **kw).collect()}
    got = rows()
    assert got == rows(block_rows=7)
    exact = {tuple(r) for r in knn.dense_i2i(vecs, asked=11).collect()}
    assert len(got) == len(exact) == 245 * 10 and len(got & exact) >= 0.95 * len(exact)
    alone = {r for r in exact if 240 <= r[0] < 243}  # no neighbour in their buckets: searched exactly
    assert alone <= got


@pytest.mark.parametrize("bits,tables", [(2, 9), (4, 2)])
def test_lsh_lists_are_the_best_of_the_pairs_that_meet(spark, bits, tables):
    """Coarse buckets (every pair looked at once) and fine ones give the lists of all pairs in NumPy; few pairs are scored."""
    rng = np.random.default_rng(8)
    n, k, signs, least = 1500, 6, 64, 34
    mat = rng.normal(size=(n, 12))
    mat[40:60] = mat[3]  # copies: ties go to the smallest ids
    mat /= np.linalg.norm(mat, axis=1, keepdims=True)
    unit = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(mat)], "key long, vec array<double>")
    placed = lsh.place(unit, bits, tables, signs).cache()
    scored = spark.sparkContext.accumulator(0)
    got = {(r.anchor_vacancy_id, r.pos): (r.recom_vacancy_id, r.score)
           for r in lsh.lsh_lists(placed, k, least, signs, bits, tables, scored=scored).collect()}
    rows = {r.key: r for r in placed.collect()}
    codes = np.array([rows[i].codes for i in range(n)])
    sketch = np.array([np.frombuffer(rows[i].sketch, np.uint8) for i in range(n)])
    agree = signs - np.bitwise_count(sketch[:, None] ^ sketch[None]).sum(axis=2, dtype=int)
    ok = (codes[:, None] == codes[None]).any(axis=2) & (agree >= least) & ~np.eye(n, dtype=bool)
    score = np.where(ok, np.round(mat @ mat.T, 9), -np.inf)
    order = np.argsort(-score, axis=1, kind="stable")[:, :k]
    want = {(i, p + 1): (int(j), score[i, j]) for i in range(n) for p, j in enumerate(order[i]) if np.isfinite(score[i, j])}
    assert got.keys() == want.keys()
    assert all(got[x][0] == want[x][0] and got[x][1] == pytest.approx(want[x][1], abs=2e-9) for x in want)
    assert 0 < scored.value < 0.4 * ok.sum()
    dealt, blocks = lsh.bucket_blocks(placed, 1024)
    assert (blocks > 0) == (tables > 2 ** bits)
    if blocks:  # a vector goes once to each block of anchors, not once for every table
        assert dealt.count() == n * (blocks + 1)


def test_tables_and_sketch_follow_from_the_recall():
    assert lsh.tables_for(1.0, 0.9, 8) == 1 and lsh.tables_for(0.8, 0.9, 8) < lsh.tables_for(0.5, 0.9, 8)
    p = lsh.agreement(0.5)
    assert p == pytest.approx(2 / 3) and 1 - (1 - p ** 6) ** lsh.tables_for(0.5, 0.97, 6) >= 0.97
    agree = np.random.default_rng(0).binomial(512, p, 20_000)
    assert (agree >= lsh.agreement_for(0.5, 0.97, 512)).mean() == pytest.approx(0.97, abs=0.01)


def test_random_ranker_is_repeatable(spark):
    df = spark.range(50).select(F.lit(1).cast("long").alias("user_id"), F.col("id").alias("vacancy_id"))
    a = R.random_ranker(df).orderBy("vacancy_id").collect()
    b = R.random_ranker(df.repartition(7)).orderBy("vacancy_id").collect()
    assert a == b and all(0.0 <= r.random_ranker < 1.0 for r in a)


def test_feature_ranker_appends_probability(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    train = spark.createDataFrame([(float(i), float(i % 2)) for i in range(20)], "f double, label double")
    model = LogisticRegression(featuresCol="__features").fit(
        VectorAssembler(inputCols=["f"], outputCol="__features").transform(train))
    cands = spark.createDataFrame([(1, 1, None), (1, 2, 3.0)], "user_id long, vacancy_id long, f double")
    out = R.feature_ranker(cands, model, ["f"]).collect()
    assert out[0].f is None and all(0.0 <= r.model_score <= 1.0 for r in out)
    assert set(out[0].asDict()) == {"user_id", "vacancy_id", "f", "model_score"}


def test_product_with_a_small_matrix_moves_entries_not_vectors(spark):
    """Many tokens, few keys: the entries are dealt by token before the product, whose sums then need no shuffle."""
    from nextclick.operators.linalg import sparse_t_times_dense
    rng = np.random.default_rng(3)
    dense = (rng.random((6, 400)) < 0.3) * rng.integers(1, 4, (6, 400))
    it, tok = np.nonzero(dense)
    a = spark.createDataFrame([(int(i), int(t), float(dense[i, t])) for i, t in zip(it, tok, strict=True)], "key long, token long, val double")
    small = rng.normal(size=(6, 3))
    d = spark.createDataFrame([(i, list(map(float, r))) for i, r in enumerate(small)], "key long, vec array<double>")
    out = sparse_t_times_dense(a, d, width=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_COL" in plan
    got = {r.key: r.vec for r in out.collect()}
    want = dense.T @ small
    assert set(got) == set(tok.tolist())
    assert all(np.allclose(v, want[k]) for k, v in got.items())
