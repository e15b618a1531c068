"""Exact neighbour lists against NumPy brute force, with the block-pair
split forced (several blocks), a hot item and a hot token."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from nextclick.operators import knn
from nextclick.operators.dictionary import decode, encode, fit_dictionary


def brute(mat, keys, asked, include_self=False):
    norms = np.linalg.norm(mat, axis=1)
    ok = norms > 0
    mat, keys = mat[ok] / norms[ok, None], keys[ok]
    order = np.argsort(keys)
    mat, keys = mat[order], keys[order]
    S = np.round(mat @ mat.T, knn.SCORE_DIGITS)
    keep = asked if include_self else asked - 1
    out = set()
    for i, k in enumerate(keys):
        row = S[i].copy()
        if not include_self:
            row[i] = -np.inf
        idx = np.argsort(-row, kind="stable")[:keep]
        for rank, j in enumerate(idx, 1):
            if np.isfinite(row[j]):
                out.add((int(k), int(keys[j]), rank))
    return out


def test_dense_matches_brute_force_across_blocks(spark):
    rng = np.random.default_rng(0)
    mat = rng.normal(size=(300, 8)).round(2)
    mat[5] = 0.0                                  # a zero vector is dropped
    odd = [np.array([np.nan] * 8), np.array([np.inf] + [1.0] * 7)]  # and so is one without a direction
    keys = rng.permutation(1000)[:300].astype(np.int64)
    df = spark.createDataFrame(pd.DataFrame({"key": np.append(keys, [5000, 5001]), "vec": list(mat) + odd}))
    got = {(r.anchor_vacancy_id, r.recom_vacancy_id, r.pos)
           for r in knn.dense_i2i(df, asked=10, block_rows=64).collect()}
    assert got == brute(mat, keys, 10)


@pytest.mark.parametrize("token_rows", [1024, 16])
def test_sparse_matches_brute_force_with_hot_item_and_token(spark, token_rows):
    rng = np.random.default_rng(1)
    n_items, n_tok = 200, 50
    dense = (rng.random((n_items, n_tok)) < 0.05) * rng.integers(1, 4, (n_items, n_tok))
    dense[7, :] = rng.integers(1, 5, n_tok)       # a hot item: every token
    dense[:, 3] = rng.integers(1, 3, n_items)     # a hot token: every item
    dense[50:90] = dense[50]                      # a group of equal vectors, longer than a list
    dense[120] = 2 * dense[121]                   # parallel, not equal
    it, tok = np.nonzero(dense)
    flat = pd.DataFrame({"key": (it * 3 + 11).astype(np.int64), "token": tok.astype(np.int64),
                         "val": dense[it, tok].astype(float)})
    df = spark.createDataFrame(flat)
    got = {(r.anchor_vacancy_id, r.recom_vacancy_id, r.pos)
           for r in knn.sparse_i2i(df, asked=15, token_rows=token_rows).collect()}
    keys = (np.arange(n_items) * 3 + 11).astype(np.int64)
    assert got == brute(dense.astype(float), keys, 15)


def test_sparse_zero_fill_matches_brute_force(spark):
    """Few shared tokens: most anchors need zero-score neighbours (smallest
    ids first), as a full kNN query returns them."""
    rng = np.random.default_rng(4)
    n_items, n_tok = 120, 400
    dense = (rng.random((n_items, n_tok)) < 0.01) * rng.integers(1, 3, (n_items, n_tok))
    dense[11, :40] = 1                             # one hot item
    it, tok = np.nonzero(dense)
    keys = rng.permutation(10_000)[:n_items].astype(np.int64)
    flat = pd.DataFrame({"key": keys[it], "token": tok.astype(np.int64), "val": dense[it, tok].astype(float)})
    got = {(r.anchor_vacancy_id, r.recom_vacancy_id, r.pos)
           for r in knn.sparse_i2i(spark.createDataFrame(flat), asked=30).collect()}
    present = np.unique(it)
    assert got == brute(dense[present].astype(float), keys[present], 30)


def test_sparse_include_self(spark):
    flat = pd.DataFrame({"key": [1, 1, 2, 3], "token": [1, 2, 1, 2], "val": [1.0, 1.0, 1.0, 1.0]})
    rows = knn.sparse_i2i(spark.createDataFrame(flat), asked=2, include_self=True).collect()
    got = {(r.anchor_vacancy_id, r.recom_vacancy_id) for r in rows}
    assert (1, 1) in got and (2, 2) in got and len(got) == 6


def test_query_topk_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    cand = rng.normal(size=(120, 5))
    q = rng.normal(size=(4, 5))
    df = spark.createDataFrame(pd.DataFrame({"key": np.arange(120, dtype=np.int64), "vec": list(cand)}))
    rows = knn.query_topk(np.arange(4, dtype=np.int64), q, df, 7, rows=25).collect()
    S = np.round(q @ cand.T, knn.SCORE_DIGITS)
    want = {(i, int(j), r) for i in range(4) for r, j in enumerate(np.argsort(-S[i], kind="stable")[:7], 1)}
    assert {(r.anchor_vacancy_id, r.recom_vacancy_id, r.pos) for r in rows} == want


def test_two_sided_streamed_topk_with_exclusions(spark):
    rng = np.random.default_rng(3)
    cand = rng.normal(size=(90, 4))
    qv = rng.normal(size=(30, 4))
    excl = {(i, int(j)) for i in range(30) for j in rng.choice(90, rng.integers(0, 40), replace=False)}
    qdf = spark.createDataFrame(pd.DataFrame({"key": np.arange(30, dtype=np.int64), "vec": list(qv)}))
    cdf = spark.createDataFrame(pd.DataFrame({"key": np.arange(90, dtype=np.int64), "vec": list(cand)}))
    edf = spark.createDataFrame(sorted(excl), "key long, other long")
    top = knn.streamed_topk(qdf, 5, candidates=cdf, exclude=edf, block_rows=16, candidate_rows=20).toPandas()
    S = np.round(qv @ cand.T, knn.SCORE_DIGITS)
    for i in range(30):
        row = S[i].copy()
        for (a, j) in excl:
            if a == i:
                row[j] = -np.inf
        want = [j for j in np.argsort(-row, kind="stable")[:5] if np.isfinite(row[j])]
        got = top[top.anchor_vacancy_id == i].sort_values("pos")
        assert got.recom_vacancy_id.tolist() == want
        assert got.pos.tolist() == list(range(1, len(want) + 1))


def test_norm_bounds_skip_blocks_and_change_nothing(spark):
    """Candidates of very different norms, ties and a zero vector: equal to brute force, most blocks not scored."""
    rng = np.random.default_rng(8)
    cand = rng.normal(size=(600, 6)) * (10.0 ** -np.arange(600) ** 0.3)[:, None]
    cand[50], cand[77], cand[100] = cand[51], 0.0, cand[51]
    cand = cand[rng.permutation(600)]
    qv = np.vstack([rng.normal(size=(70, 6)), np.zeros(6)])
    frame = lambda m: spark.createDataFrame(pd.DataFrame({"key": np.arange(len(m), dtype=np.int64), "vec": list(m)}))
    skips = [spark.sparkContext.accumulator(0) for _ in range(2)]
    top = knn.streamed_topk(frame(qv), 4, candidates=frame(cand), block_rows=32, candidate_rows=20, skipped=skips).toPandas()
    S = np.round(qv @ cand.T, knn.SCORE_DIGITS)
    want = {(i, int(j), r) for i in range(len(qv)) for r, j in enumerate(np.argsort(-S[i], kind="stable")[:4], 1)}
    assert set(zip(top.anchor_vacancy_id, top.recom_vacancy_id, top.pos, strict=True)) == want
    assert skips[0].value > 0.5 * skips[1].value


def test_few_anchors_are_searched_by_many_tasks(spark):
    vecs = spark.createDataFrame(pd.DataFrame({"key": np.arange(500, dtype=np.int64), "vec": list(np.random.default_rng(0).normal(size=(500, 8)))}))
    assert knn.streamed_topk(vecs, 5).select(F.spark_partition_id()).distinct().count() == 8
    lists = knn.streamed_topk(vecs, 5, block_rows=64).groupBy("anchor_vacancy_id").count().collect()
    assert {r["count"] for r in lists} == {5} and len(lists) == 500


def test_dictionary_dense_ids(spark):
    vals = spark.createDataFrame([(v,) for v in [50, 7, 7, 300, 12, None, 999, 50]], "v long")
    d = fit_dictionary(vals, "v", "idx", partitions=3).orderBy("v").collect()
    assert [(r.v, r.idx) for r in d] == [(7, 0), (12, 1), (50, 2), (300, 3), (999, 4)]
    probe = spark.createDataFrame([(12,), (13,)], "v long")
    enc = {r.v: r.idx for r in encode(probe, fit_dictionary(vals, "v", "idx"), "v", "idx").collect()}
    assert enc == {12: 1, 13: None}
    idx = spark.createDataFrame([(0,), (4,), (5,), (-1,)], "idx long")
    assert sorted(r.v for r in decode(idx, fit_dictionary(vals, "v", "idx"), "v", "idx").collect()) == [7, 999]


def test_unicode_words(spark):
    from nextclick.operators.vectors import text_token_counts
    df = spark.createDataFrame([(1, "Привет мир, ÉTÉ été x y2 a_b 42")], "k long, t string")
    words = sorted(r.word for r in text_token_counts(df, "k", "t").collect())
    assert words == sorted(["привет", "мир", "été", "y2", "a_b", "42"])


def test_document_knn_matches_brute_force(spark):
    from conftest import SF001
    from nextclick.operators.vectors import text_token_counts
    from nextclick.sources import fixtures as fx
    docs = fx.table(spark, SF001, "documents").select("doc_id", "text")
    counts = text_token_counts(docs, "doc_id", "text").select("key", "token", "val").toPandas()
    keys = np.sort(counts.key.unique())
    toks = {t: i for i, t in enumerate(counts.token.unique())}
    mat = np.zeros((len(keys), len(toks)))
    mat[np.searchsorted(keys, counts.key), counts.token.map(toks)] = counts.val
    got = {(r.anchor_vacancy_id, r.recom_vacancy_id, r.pos)
           for r in knn.sparse_i2i(spark.createDataFrame(counts), asked=20).collect()}
    assert got == brute(mat, keys.astype(np.int64), 20)


def test_common_tokens_travel_together_and_lists_of_single_keys_are_final(spark, monkeypatch):
    """A token of all items costs a row per item and block; lists without equal vectors are not ranked again."""
    rng = np.random.default_rng(12)
    dense = (rng.random((150, 30)) < 0.2) * rng.integers(1, 4, (150, 30))
    dense[:, 0] = 1
    dense[3, 5] += 7                              # no vector occurs twice
    dense[:, 1:9] += (np.arange(150)[:, None] >> np.arange(8)) & 1
    it, tok = np.nonzero(dense)
    flat = pd.DataFrame({"key": it.astype(np.int64), "token": tok.astype(np.int64), "val": dense[it, tok].astype(float)})
    written = {}
    keep = knn.materialise
    monkeypatch.setattr(knn, "materialise", lambda df, name, *a: written.setdefault(name, keep(df, name, *a)))
    got = {(r.anchor_vacancy_id, r.recom_vacancy_id, r.pos)
           for r in knn.sparse_i2i(spark.createDataFrame(flat), asked=12, token_rows=8).collect()}
    assert got == brute(dense.astype(float), np.arange(150, dtype=np.int64), 12)
    assert written["sparse_tokens"].where("_all").count() > 0
    assert written["i2i_top"].count() == 0


def test_cell_lists_leave_a_task_once_per_query_and_cell(spark, monkeypatch):
    """A cell of several blocks of candidates: its blocks are streamed past the queries, and only the best of the cell go on."""
    rng = np.random.default_rng(13)
    mat = rng.normal(size=(5000, 4)).round(2)
    frame = lambda n: spark.createDataFrame(pd.DataFrame({"key": np.arange(n, dtype=np.int64), "vec": list(mat[:n]), "cell": np.zeros(n, np.int32)}))
    parts = []
    last = knn._final_topk
    monkeypatch.setattr(knn, "_final_topk", lambda df, k: parts.append(df) or last(df, k))
    got = knn.cell_topk(frame(60), frame(5000), 7).collect()
    assert parts[0].count() == 60 * 7
    S = np.round(mat[:60] @ mat.T, knn.SCORE_DIGITS)
    S[np.arange(60), np.arange(60)] = -np.inf
    want = {(i, int(j), r) for i in range(60) for r, j in enumerate(np.argsort(-S[i], kind="stable")[:7], 1)}
    assert {(r.anchor_vacancy_id, r.recom_vacancy_id, r.pos) for r in got} == want


def test_blocks_that_share_many_tokens_are_searched_by_sketches(spark):
    """Exact lists, from few of the products."""
    rng = np.random.default_rng(14)
    dense = (rng.random((400, 60)) < 0.5) * rng.integers(1, 6, (400, 60)).astype(float)
    it, tok = np.nonzero(dense)
    flat = spark.createDataFrame(pd.DataFrame({"key": it.astype(np.int64), "token": tok.astype(np.int64), "val": dense[it, tok]}))
    counted = [spark.sparkContext.accumulator(0) for _ in range(3)]
    got = {(r.anchor_vacancy_id, r.recom_vacancy_id, r.pos)
           for r in knn.sparse_topk(flat, 9, block_rows=128, counted=counted, normalise=True).collect()}
    assert got == brute(dense, np.arange(400, dtype=np.int64), 10)
    assert 0 < counted[2].value < ((dense > 0).sum(axis=0) ** 2).sum() / 2


def test_an_entry_is_stored_once_whatever_the_number_of_blocks(spark, monkeypatch):
    rng = np.random.default_rng(15)
    dense = (rng.random((500, 40)) < 0.2) * rng.integers(1, 4, (500, 40)).astype(float)
    dense[:, 0] = 1
    it, tok = np.nonzero(dense)
    flat = spark.createDataFrame(pd.DataFrame({"key": it.astype(np.int64), "token": tok.astype(np.int64), "val": dense[it, tok]}))
    stored, names = [], []
    keep = knn.materialise

    def seen(df, name, *a):
        out = keep(df, name, *a)
        names.append(name)
        if name == "sparse_anchors":
            stored.extend(knn._Block(r.blob) for r in out.collect())
        return out

    monkeypatch.setattr(knn, "materialise", seen)
    got = {(r.anchor_vacancy_id, r.recom_vacancy_id, r.pos) for r in knn.sparse_topk(flat, 5, block_rows=50, normalise=True).collect()}
    want = {(a, r, p) for a, r, p in brute(dense, np.arange(500, dtype=np.int64), 6)}
    assert got == want
    assert len(stored) == 10 and sum(len(b.code) for b in stored) == len(it) and sum(len(b.keys) for b in stored) == 500
