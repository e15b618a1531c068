"""Registered queries whose result is not unique (model fits, hashing,
approximate search). They run over the whole tables like the others; their
checks are invariants and brute-force comparisons in ``tests/``."""

from __future__ import annotations

from pyspark.sql import functions as F

from nextclick.operators import ann, knn, lsh
from nextclick.operators import candidates as C
from nextclick.operators import vectors as V
from nextclick.operators.als import AlsRecommender, fallback_predictions
from nextclick.operators.metrics import mrr_unbounded
from nextclick.operators.sessions import interactions
from nextclick.operators.truth import leave_last_out, time_split
from nextclick.plans import catalog
from nextclick.plans.render import num
from nextclick.sources import fixtures as fx
from nextclick.sources.tables import materialise


def als_recommend_events(spark, d):
    """Implicit ALS (150 factors, 25 iterations, reg 0.001, seed 42;
    weights 1:4, 2:1, 3:2) on F1 train; top 100 unseen items per truth user."""
    p = catalog.f1(spark, d)
    recs = AlsRecommender().fit(p.train).recommend(p.test, 100)
    return recs.select("user_id", "vacancy_id", num("score").alias("score"),
                       F.col("pos").cast("bigint").alias("pos"))


def als_fallback_mrr_events(spark, d):
    """R17 + R29: leave-last-out truth over the validation sessions; cold
    users get their own session items, known users the ALS top 100; MRR
    with no cut-off."""
    sessions = materialise(catalog.f1_sessions(spark, d), "sessions", sort_within=["session_dt"])
    train_s, val_s = time_split(sessions, fx.F1_TRAIN, fx.F1_VALIDATION)
    train = interactions(train_s, keep=["user_id", "session_id"])
    llo = leave_last_out(val_s)
    recs = AlsRecommender().fit(train).recommend(llo, 100)
    preds = fallback_predictions(llo, train, recs)
    m = mrr_unbounded(llo, preds, "next_item", keys=["user_id", "session_id"])
    return m.select(num("mrr").alias("mrr"), "n_queries")


def _f1_counts(spark, d):
    return V.item_token_counts(catalog.f1(spark, d).train, fx.vacancies(spark, d))


def svd_item_vectors_events(spark, d):
    """Truncated SVD (32 components) of F1's item x user counts."""
    vecs = V.svd_item_vectors(_f1_counts(spark, d), k=32)
    return vecs.select("key", F.size("vec").cast("bigint").alias("dims"),
                       num(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).alias("norm"))


def als_item_vectors_events(spark, d):
    """Implicit ALS item vectors (16 factors, 10 iterations, reg 0.1)."""
    vecs = V.als_item_vectors(_f1_counts(spark, d), rank=16, max_iter=10, reg=0.1)
    return vecs.select("key", F.size("vec").cast("bigint").alias("dims"),
                       F.array_join(F.transform("vec", lambda x: F.format_number(x, 4)), ",").alias("vec"))


def als_i2i_topk_events(spark, d):
    """R8 -> R4 -> R13b: neighbour lists over ALS item vectors (32 factors), top 20 ranks per user."""
    p = catalog.f1(spark, d)
    vecs = V.als_item_vectors(V.item_token_counts(p.train, fx.vacancies(spark, d)), rank=32, max_iter=10, reg=0.1)
    out = C.i2i_topk_candidates(p.test, knn.dense_i2i(vecs, asked=100), 20)
    return out.select("user_id", "vacancy_id", num("score", 9).alias("score"))


def svd_i2i_events(spark, d):
    """R7 -> R4: neighbour list over SVD item vectors (cosine)."""
    vecs = V.svd_item_vectors(_f1_counts(spark, d), k=32)
    return catalog._i2i_view(knn.dense_i2i(vecs, asked=100))


def ivf_i2i_embeddings(spark, d):
    """Cell search (16 cells, 13 probes, more where the list would be short) over the embeddings, which have no clusters."""
    return catalog._i2i_view(ann.ivf_i2i(fx.item_vectors(spark, d), **IVF_EMBEDDINGS))


#: The embeddings point in all directions alike: the 19 nearest have a cosine of some 0.2 and more.
IVF_EMBEDDINGS = {"nlist": 16, "nprobe": 13, "asked": 100}
LSH_EMBEDDINGS = {"asked": 20, "cosine": 0.22, "recall": 0.93, "bits": 3, "signs": 512}


def lsh_i2i_embeddings(spark, d):
    """R9, second form: random-projection tables and sketches for a recall of 0.93 at a cosine of 0.22, 20 asked."""
    return catalog._i2i_view(lsh.lsh_i2i(fx.item_vectors(spark, d), **LSH_EMBEDDINGS))


def cluster_knn_embeddings(spark, d):
    """Cluster kNN (20 clusters, 50 items per centroid)."""
    return catalog._i2i_view(ann.cluster_knn(fx.item_vectors(spark, d), n_clusters=20, top_size=50))


def text_knn_clusters(spark, d):
    """R14 over clusters (the source's preset: 50 items per centroid): part names as word counts, reduced by R7
    so that k-means sees dense rows, then R10; distinct neighbours of a user's items. Where there are fewer different
    names than components the reduction keeps all of them."""
    names = V.text_token_counts(fx.vacancies(spark, d), "vacancy_id", "name").select("key", "token", "val")
    lists = ann.cluster_knn(V.svd_item_vectors(names, k=64), n_clusters=40, top_size=50)
    return C.unique_neighbours(catalog.f2(spark, d).test, lists)


INVARIANT_CHECKED = {
    "als_recommend_events": als_recommend_events,
    "als_fallback_mrr_events": als_fallback_mrr_events,
    "svd_item_vectors_events": svd_item_vectors_events,
    "als_item_vectors_events": als_item_vectors_events,
    "svd_i2i_events": svd_i2i_events,
    "ivf_i2i_embeddings": ivf_i2i_embeddings,
    "lsh_i2i_embeddings": lsh_i2i_embeddings,
    "cluster_knn_embeddings": cluster_knn_embeddings,
    "als_i2i_topk_events": als_i2i_topk_events,
    "text_knn_clusters": text_knn_clusters,
    "trained_rank_events": catalog.trained_rank_events,
}
