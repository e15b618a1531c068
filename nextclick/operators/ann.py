"""Approximate and cluster-based neighbour lists: cell search (R9) and
cluster kNN (R10), both on k-means over item vectors (Spark ML)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextclick.operators.knn import SCORE_DIGITS, cell_topk, query_topk, unit_vectors
from nextclick.sources.tables import materialise


def fit_centers(vectors: DataFrame, k: int, seed: int = 42, max_iter: int = 20) -> np.ndarray:
    """Unit centres of a k-means over unit vectors (at most ``k`` rows)."""
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features").fit(vectors.withColumn("features", array_to_vector("vec")))
    return unit_rows(np.array([np.asarray(c, dtype=np.float64) for c in model.clusterCenters()]))


def unit_rows(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.where(n > 0, m / np.where(n > 0, n, 1), 0.0)


def _cell_order(vecs: np.ndarray, centers: np.ndarray, keep: int) -> np.ndarray:
    """The ``keep`` nearest cells of each row, nearest (largest cosine, then smallest number) first."""
    s = np.round(vecs @ centers.T, SCORE_DIGITS)
    if keep < s.shape[1]:
        edge = -np.partition(-s, keep - 1, axis=1)[:, keep - 1: keep]  # cells beyond the edge are out, whatever their number
        s = np.where(s >= edge, s, -np.inf)
    return np.argsort(-s, axis=1, kind="stable")[:, :keep].astype("int32")


def nearest_cells(vectors: DataFrame, centers: np.ndarray, keep: int | None = None) -> DataFrame:
    """``key, vec, cells``: the ``keep`` nearest cells of an item (all of them, if not given), nearest first."""
    keep = min(keep or len(centers), len(centers))

    @F.pandas_udf("array<int>")
    def order(v: pd.Series) -> pd.Series:
        return pd.Series(list(_cell_order(np.vstack(v.to_numpy()), centers, keep)) if len(v) else [], dtype=object)

    return vectors.select("key", "vec", order("vec").alias("cells"))


def ivf_i2i(vectors: DataFrame, nlist: int = 100, nprobe: int = 1, asked: int = 100, seed: int = 42, spare: int = 4) -> DataFrame:
    """R9 (re-aimed from a graph index to an inverted file): unit vectors in
    ``nlist`` k-means cells; every item is searched exactly, by cosine, in
    its ``nprobe`` nearest cells, and in further ones, in order of
    nearness, until those hold ``asked`` items: every item gets its full
    list of ``asked - 1`` (or all others). ``nprobe = nlist`` is the exact
    search. An item keeps its ``nprobe + spare`` nearest cells; only one that
    needs still more is placed among all of them again. Recall against the
    exact list (R4) is the quality measure."""
    unit = materialise(unit_vectors(vectors), "ivf_vectors")
    centers = fit_centers(unit, nlist, seed)
    placed = materialise(nearest_cells(unit, centers, nprobe + spare), "ivf_cells")
    counts = {r["cell"]: r["n"] for r in placed.groupBy(F.col("cells")[0].alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = np.array([counts.get(i, 0) for i in range(nlist)])  # one number per cell
    need = min(asked, int(sizes.sum()))

    @F.pandas_udf("array<int>")
    def probes(vec: pd.Series, cells: pd.Series) -> pd.Series:
        out = []
        for v, c in zip(vec, cells, strict=True):
            if sizes[c].sum() < need:
                c = _cell_order(v[None, :], centers, len(centers))[0]
            out.append(c[: max(nprobe, int(np.searchsorted(np.cumsum(sizes[c]), need)) + 1)])
        return pd.Series(out, dtype=object)

    queries = placed.select("key", "vec", F.explode(probes("vec", "cells")).alias("cell"))
    return cell_topk(queries, placed.select("key", "vec", F.col("cells")[0].alias("cell")), asked - 1)


def cluster_knn(vectors: DataFrame, n_clusters: int = 100, top_size: int = 300, seed: int = 42,
                centers: np.ndarray | None = None) -> DataFrame:
    """K-means on unit vectors; for every centroid the ``top_size``
    nearest items (by cosine to the centroid) are listed once; a query item
    gets the list of its nearest centroid (the asked k is ignored, as in the
    source). Centroids, fitted or given, are bounded by their number and
    ship with the task closure. Returns i2i rows ``anchor_vacancy_id,
    recom_vacancy_id, score, pos``."""
    unit = materialise(unit_vectors(vectors), "cluster_vectors")
    centers = fit_centers(unit, n_clusters, seed) if centers is None else unit_rows(centers)
    lists = query_topk(np.arange(len(centers), dtype=np.int64), centers, unit, top_size)
    lists = lists.select(F.col("anchor_vacancy_id").alias("cell"), "recom_vacancy_id", "score", "pos")
    cells = nearest_cells(unit, centers, 1).select(F.col("key").alias("anchor_vacancy_id"), F.col("cells")[0].cast("bigint").alias("cell"))
    return cells.join(lists, "cell").drop("cell")


def recall_at_k(approx: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact neighbours that the approximate list also holds."""
    keys = ["anchor_vacancy_id", "recom_vacancy_id"]
    found = approx.select(*keys).withColumn("_hit", F.lit(1))
    joined = exact.select(*keys).join(found, keys, "left")
    return joined.agg((F.count("_hit") / F.count(F.lit(1))).alias("recall"),
                      F.count("_hit").alias("hits"), F.count(F.lit(1)).alias("total"))
