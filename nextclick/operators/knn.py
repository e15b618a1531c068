"""Exact item-to-item neighbour lists (R4 dense, R5 sparse) and top-k
searches used by cluster kNN (R10), the cell index (R9) and ALS (R16).

Dense vectors (``streamed_topk``). A grid of anchor blocks (hashed,
``block_rows``) and groups of candidate blocks; a task has one cell of it,
streams the group's small candidate blocks past the anchor block, multiplies
them in NumPy and keeps a running best ``k`` per anchor: it holds one anchor
block, one candidate block and ``k`` per anchor. Few anchors make smaller
blocks, and very few make groups, so that there are ``SPREAD`` tasks; the
lists of an anchor's groups are then merged. Candidates of another table come by
falling norm, their blocks dealt to the groups in turn, and an anchor is not
scored against a block if its norm times the block's largest cannot reach
its k-th score. A vector is copied to every anchor block, ``n / block_rows``
times, and an anchor to every group, whatever the cluster. An exact dense
search stays quadratic in the worst case; at scale use the approximate ones (R9).

Sparse vectors (``sparse_i2i``, ``sparse_topk``). Equal vectors are scored
once. Items lie in packed blocks, written once; a task has one block of
anchors and reads the blocks of candidates from the table, so nothing is
copied on disk for a pair of blocks, and only the best ``k`` of an anchor
leave a task. Blocks that share few tokens are compared through these, and an
anchor is left out of a block of candidates if its tokens' weights times the
largest weights there cannot reach its k-th score. Blocks that share many
(long texts) are compared by sketches, a product in single precision that is
never below the score; only pairs that may enter a list are scored.
Every block of anchors reads every block of candidates.

Ties: scores are rounded to ``SCORE_DIGITS`` places before ranking and
broken by the candidate id (ascending), everywhere.

``asked`` follows the source: ``asked`` neighbours are requested with the
item itself among them, then the item is removed, so each anchor keeps
``asked - 1`` neighbours.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from nextclick.operators.dictionary import numbered
from nextclick.sources.tables import configured, drop_table, materialise

SCORE_DIGITS = 9
OUT_SCHEMA = "anchor_vacancy_id long, recom_vacancy_id long, score double"
STREAM_SCHEMA = OUT_SCHEMA + ", pos int"
_NO_ID = np.iinfo(np.int64).max
#: Tasks that a search is spread over at least, if there are candidate blocks enough.
SPREAD = 8
#: Anchors of a dense block at most, and scores that a task holds at once.
BLOCK_ROWS, SCORES = 16384, 1 << 22
#: Anchors whose lists are merged at once.
MERGED = 4096


# ----------------------------------------------------------------- helpers
def norm(vec: str = "vec") -> Column:
    return F.sqrt(F.aggregate(F.col(vec).cast("array<double>"), F.lit(0.0).cast("double"), lambda acc, x: acc + x * x))


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """L2-normalise ``vec``. A vector without a direction (all zero, or
    with a NaN, infinite or missing coordinate) is dropped."""
    n = F.col("_n")
    return (vectors.withColumn("_n", norm()).where((n > 0) & ~F.isnan(n) & (n < float("inf")))
                   .withColumn("vec", F.transform(F.col("vec").cast("array<double>"), lambda x: x / F.col("_n"))).drop("_n"))


def _block_best(S: np.ndarray, cids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the best ``k`` (score desc, id asc) of one block as dense
    ``(rows x k)`` arrays, padded with ``-inf`` / no id. ``cids`` ascending.
    A partition finds each row's k-th value in linear time."""
    na, nc = S.shape
    if nc <= k:
        pad = k - nc
        return (np.pad(S, ((0, 0), (0, pad)), constant_values=-np.inf),
                np.pad(np.broadcast_to(cids, (na, nc)), ((0, 0), (0, pad)), constant_values=_NO_ID))
    thr = np.partition(S, nc - k, axis=1)[:, nc - k][:, None]
    above = S > thr
    need = k - above.sum(axis=1, keepdims=True)
    tie = S == thr
    sel = above | (tie & (np.cumsum(tie, axis=1) <= need))
    rows, cols = np.nonzero(sel)
    return S[rows, cols].reshape(na, k), cids[cols].reshape(na, k)


def _merge_best(bs, bi, ns, ni, k):
    s = np.concatenate([bs, ns], axis=1)
    i = np.concatenate([bi, ni], axis=1)
    order = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, axis=1), np.take_along_axis(i, order, axis=1)


def _mask(scores: np.ndarray, rows: np.ndarray, ids: np.ndarray, ckeys: np.ndarray) -> None:
    """Rule out the pairs (row, id) that are in this block."""
    pos = np.searchsorted(ckeys, ids)
    ok = (pos < len(ckeys)) & (ckeys[np.minimum(pos, len(ckeys) - 1)] == ids)
    scores[rows[ok], pos[ok]] = -np.inf


def _dense_block(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    pdf = pdf.sort_values("key")
    keys = pdf["key"].to_numpy().astype("int64")
    mat = np.vstack(pdf["vec"].to_numpy()).astype(np.float64) if len(pdf) else np.zeros((0, 0))
    return keys, mat


def _final_topk(parts: DataFrame, keep: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("anchor_vacancy_id").orderBy(
        F.col("score").desc(), F.col("recom_vacancy_id").asc()))
    return (parts.withColumn("pos", rank).where(F.col("pos") <= keep)
                 .withColumn("pos", F.col("pos").cast("int")))


def _blocks(n: int, most: int) -> int:
    """Blocks of at most ``most`` rows: SPREAD of them as long as they keep 64 rows each."""
    return max(1, math.ceil(n / min(most, max(64, -(-n // SPREAD)))))


# ----------------------------------------------------------------- R4
def dense_i2i(vectors: DataFrame, asked: int = 100, normalise: bool = True, block_rows: int | None = None,
              digits: int = SCORE_DIGITS) -> DataFrame:
    """Exact cosine neighbour list for ``key, vec array<double>``:
    ``asked - 1`` rows per item. Vectors without a direction are dropped."""
    items = unit_vectors(vectors) if normalise else vectors
    return streamed_topk(items.select("key", "vec"), asked - 1, block_rows=block_rows, digits=digits)


class _Best:
    """The best ``k`` of one block of anchors so far, over candidate blocks given one after another. Scores that may enter a full list
    are collected, and merged when there are half as many as the lists hold."""

    def __init__(self, keys: np.ndarray, mat: np.ndarray, k: int, digits: int):
        self.keys, self.mat, self.k, self.digits = keys, mat, k, digits
        self.norms = np.sqrt((mat * mat).sum(axis=1))
        self.scores = np.full((len(keys), k), -np.inf)
        self.ids = np.full((len(keys), k), _NO_ID, dtype=np.int64)
        self.more: list[tuple[np.ndarray, ...]] = []
        self.n_more = 0

    def take(self, ckeys: np.ndarray, cmat: np.ndarray, apart: bool, out: tuple[np.ndarray, np.ndarray]) -> int:
        """Score a candidate block, itself left out if ``apart``, and without the pairs (anchor key, candidate) of ``out``. An
        anchor whose norm times the block's largest norm cannot reach its k-th score is not scored; returns how many were not."""
        bound = self.norms * np.sqrt((cmat * cmat).sum(axis=1)).max(initial=0.0)
        live = np.flatnonzero(~(bound * (1 + 1e-12) + 10.0 ** -self.digits < self.scores[:, -1]))
        if len(ckeys):
            step = max(1, SCORES // len(ckeys))
            for at in range(0, len(live), step):
                self._score(live[at: at + step], ckeys, cmat, apart, out)
        return len(self.keys) - len(live)

    def _score(self, live: np.ndarray, ckeys: np.ndarray, cmat: np.ndarray, apart: bool, out: tuple[np.ndarray, np.ndarray]) -> None:
        S = self.mat[live] @ cmat.T
        if apart:
            _mask(S, np.arange(len(live)), self.keys[live], ckeys)
        if len(out[0]):
            at = np.searchsorted(self.keys[live], out[0])
            there = (at < len(live)) & (self.keys[live][np.minimum(at, len(live) - 1)] == out[0])
            _mask(S, at[there], out[1][there], ckeys)
        if not np.isfinite(self.scores[live, -1]).all():  # lists to be filled
            self._merge()
            S = np.round(S, self.digits)
            self.scores[live], self.ids[live] = _merge_best(self.scores[live], self.ids[live], *_block_best(S, ckeys, self.k), self.k)
            return
        hit = np.flatnonzero(S >= (self.scores[live, -1] - 10.0 ** -self.digits)[:, None])
        row, col = hit // len(ckeys), hit % len(ckeys)
        self.more.append((live[row], ckeys[col], np.round(S[row, col], self.digits)))
        self.n_more += len(hit)
        if 2 * self.n_more > self.scores.size:
            self._merge()

    def _merge(self) -> None:
        if not self.n_more:
            return
        row, key, score = (np.concatenate(c) for c in zip(*self.more, strict=True))
        self.more, self.n_more = [], 0
        order = np.argsort(row, kind="stable")
        row, key, score = row[order], key[order], score[order]
        ends = np.searchsorted(row, np.arange(0, len(self.scores) + MERGED, MERGED))
        for lo, hi in zip(ends[:-1], ends[1:], strict=True):  # some anchors after others, to hold little at once
            if hi > lo:
                self._merge_rows(row[lo:hi], key[lo:hi], score[lo:hi])

    def _merge_rows(self, row: np.ndarray, key: np.ndarray, score: np.ndarray) -> None:
        touched = np.unique(row)
        old = np.isfinite(self.scores[touched])
        row = np.r_[row, np.repeat(touched, old.sum(axis=1))]
        score, key = np.r_[score, self.scores[touched][old]], np.r_[key, self.ids[touched][old]]
        order = np.lexsort((key, -score, row))
        row, score, key = row[order], score[order], key[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        best = place < self.k
        self.scores[row[best], place[best]], self.ids[row[best], place[best]] = score[best], key[best]

    def rows(self) -> pd.DataFrame:
        self._merge()
        r, c = np.nonzero(np.isfinite(self.scores))
        return pd.DataFrame({"anchor_vacancy_id": self.keys[r], "recom_vacancy_id": self.ids[r, c], "score": self.scores[r, c],
                             "pos": (c + 1).astype("int32")})


def streamed_topk(items: DataFrame, k: int, candidates: DataFrame | None = None, exclude: DataFrame | None = None,
                  block_rows: int | None = None, candidate_rows: int | None = None, digits: int = SCORE_DIGITS, skipped=None) -> DataFrame:
    """Best ``k`` candidates by inner product per item of ``key, vec`` (see the module's text). Without ``candidates`` the items are
    compared with each other, themselves left out. ``exclude`` (``key, other``) lists pairs never to return; a pair travels to its anchor
    block and is read with the candidate block that holds its other side, so a key with very many of them never has them in memory
    together. ``skipped``: two accumulators, which receive the (anchor, candidate block) pairs that a bound ruled out, and all of them."""
    source = items if candidates is None else candidates
    n, nc = items.count(), source.count()
    per = candidate_rows or min(1024, max(64, -(-nc // SPREAD)))
    blocks, parts = max(1, math.ceil(n / min(block_rows or BLOCK_ROWS, max(64, n // (3 * SPREAD))))), max(1, math.ceil(nc / per))
    groups = min(parts, max(1, SPREAD // blocks))
    anchor_block = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks)).cast("int")
    key, none = F.col("key").cast("bigint"), F.lit(None)
    if candidates is None:  # vectors of like norm: no order helps
        placed = source.select("key", "vec", F.pmod(F.xxhash64(key, F.lit(1)), F.lit(parts)).cast("int").alias("cb"))
    else:
        ranked = numbered(source.select(key.alias("key"), "vec", norm().alias("_n")), F.col("_n").desc(), F.col("key"), idx="_i")
        placed = ranked.select("key", "vec", F.floor(F.col("_i") / per).cast("int").alias("cb"))
    group = F.pmod("cb", F.lit(groups))
    anchors = items.select(anchor_block(key).alias("ab"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(-1).alias("cb"),
                           F.lit(0).alias("role"), key.alias("key"), "vec", none.cast("bigint").alias("other"))
    rows = anchors.unionByName(placed.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("ab"), group.alias("g"), "cb", F.lit(2).alias("role"), key.alias("key"), "vec",
        none.cast("bigint").alias("other")))
    if exclude is not None:
        pairs = exclude.select(key.alias("key"), F.col("other").cast("bigint").alias("other")).join(
            placed.select(key.alias("other"), "cb"), "other")
        rows = rows.unionByName(pairs.select(anchor_block(F.col("key")).alias("ab"), group.alias("g"), "cb", F.lit(1).alias("role"), "key",
                                             none.cast("array<double>").alias("vec"), "other"))
    rows = rows.repartitionById(blocks * groups, F.col("ab") * groups + F.col("g"))
    lists = _stream(rows, k, candidates is None, digits, skipped)
    return lists if groups == 1 else _final_topk(lists.drop("pos"), k)


def _stream(rows: DataFrame, k: int, apart: bool, digits: int = SCORE_DIGITS, skipped=None) -> DataFrame:
    """Lists of each (anchor block ``ab``, group ``g``), both in one partition: ``role`` 0 rows are anchors (``cb`` -1), 2 candidates
    of block ``cb``, 1 pairs (``key``, ``other``) left out."""
    def run(batches):
        at = best = None
        held: list[pd.DataFrame] = []

        def flush():
            """Take in what was read of one (anchor block, group, candidate block)."""
            nonlocal best
            if not held:
                return
            got = pd.concat(held, ignore_index=True)
            held.clear()
            role = got["role"].to_numpy()
            if at[2] < 0:
                best = _Best(*_dense_block(got), k, digits)
            elif best is not None and (role == 2).any():
                out = got[role == 1]
                ruled_out = best.take(*_dense_block(got[role == 2]), apart,
                                      (out["key"].to_numpy().astype("int64"), out["other"].to_numpy().astype("int64")))
                if skipped:
                    skipped[0].add(ruled_out)
                    skipped[1].add(len(best.keys))

        for pdf in batches:
            place = pdf[["ab", "g", "cb"]].to_numpy().astype("int64")
            cuts = np.flatnonzero((np.diff(place, axis=0) != 0).any(axis=1)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(pdf)]):
                if hi == lo:
                    continue
                here = tuple(place[lo].tolist())
                if here != at:
                    flush()
                    if at is not None and here[:2] != at[:2]:
                        if best is not None:
                            yield best.rows()
                        best = None
                    at = here
                held.append(pdf.iloc[lo:hi])
        flush()
        if best is not None:
            yield best.rows()

    return rows.sortWithinPartitions("ab", "g", "cb", "role", "key").mapInPandas(run, STREAM_SCHEMA)


# ----------------------------------------------------------------- R5
#: Products that a task holds at once.
PRODUCTS = 1 << 21


class _SparseBest:
    """The best ``k`` of one block of anchors so far, over blocks of sparse candidates given one after another."""

    def __init__(self, keys: np.ndarray, tokens: np.ndarray, vals: np.ndarray, k: int, digits: int):
        self.keys, rows = np.unique(keys, return_inverse=True)
        order = np.argsort(tokens, kind="stable")
        self.rows, self.vals = rows[order], vals[order]
        self.tokens, self.first, self.count = np.unique(tokens[order], return_index=True, return_counts=True)
        self.k, self.digits = k, digits
        self.scores = np.full((len(self.keys), k), -np.inf)
        self.ids = np.full((len(self.keys), k), _NO_ID, dtype=np.int64)
        self.more: list[tuple[np.ndarray, ...]] = []
        self.n_more = 0

    def take(self, keys: np.ndarray, tokens: np.ndarray, vals: np.ndarray, apart: bool) -> tuple[int, int, int]:
        """Score a block of candidates. What a block can add to an anchor is at most the sum, over the anchor's tokens, of its weight
        times the token's largest weight in the block; an anchor whose k-th score is beyond that is left out. Returns the anchors left
        out, all anchors, and the products computed."""
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        known = self.tokens[at] == tokens
        ckeys, col = np.unique(keys[known], return_inverse=True)
        at, vals = at[known], vals[known]
        most = np.zeros(len(self.tokens))
        np.maximum.at(most, at, vals)
        bound = np.bincount(self.rows, self.vals * np.repeat(most, self.count), len(self.keys))
        live = ~(bound + 10.0 ** -self.digits < self.scores[:, -1])
        if live.all():
            rows, weights, first, count = self.rows, self.vals, self.first, self.count
        else:
            keep = live[self.rows]
            of = np.repeat(np.arange(len(self.tokens)), self.count)[keep]
            rows, weights, count = self.rows[keep], self.vals[keep], np.bincount(of, minlength=len(self.tokens))
            first = np.r_[0, np.cumsum(count)[:-1]]
        order = np.argsort(col, kind="stable")
        at, col, vals = at[order], col[order], vals[order]
        before = np.r_[0, np.cumsum(count[at])]
        begin = 0
        while begin < len(col):  # whole candidates, as many as PRODUCTS allow
            end = int(np.searchsorted(before, before[begin] + PRODUCTS, side="right")) - 1
            end = int(np.searchsorted(col, col[min(max(end, begin), len(col) - 1)], side="left")) if end < len(col) else end
            end = end if end > begin else int(np.searchsorted(col, col[begin], side="right"))
            self._products(rows, weights, first, count, at[begin:end], col[begin:end], vals[begin:end], ckeys, apart)
            begin = end
        return int((~live).sum()), len(self.keys), int(before[-1])

    def _products(self, rows, weights, first, count, at, col, vals, ckeys, apart) -> None:
        n = count[at]
        entry = np.repeat(np.arange(len(at)), n)
        left = np.arange(len(entry)) - np.repeat(np.r_[0, np.cumsum(n)[:-1]], n) + first[at][entry]
        low, width = int(col[0]), int(col[-1] - col[0]) + 1
        code = rows[left] * width + (col[entry] - low)
        product = weights[left] * vals[entry]
        if len(self.keys) * width <= 4 * len(code):
            total = np.bincount(code, product, len(self.keys) * width)
            code = np.flatnonzero(total)
            total = total[code]
        else:
            code, where = np.unique(code, return_inverse=True)
            total = np.bincount(where, product, len(code))
        score, row, key = np.round(total, self.digits), code // width, ckeys[code % width + low]
        keep = (score > 0) & (score >= self.scores[row, -1])
        if apart:
            keep &= self.keys[row] != key
        self.more.append((row[keep], key[keep], score[keep]))
        self.n_more += int(keep.sum())
        if 2 * self.n_more > self.scores.size:
            self._merge()

    _merge, _merge_rows = _Best._merge, _Best._merge_rows


#: Entries that a block of items has at most (on average), and that a task deals out at once.
BLOCK_ENTRIES, CHUNK_ENTRIES = 2 << 20, 1 << 20
#: A pair of blocks with more products than this for each pair of items is searched by sketches: common tokens, and buckets of the others.
DENSE, COMMON, BUCKETS = 4, 512, 1024


def _narrow(a: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as they need."""
    whole = a.size > 0 and bool(((a >= 0) & (a == np.floor(a))).all())
    return next((a.astype(kind) for kind in (np.uint8, np.uint16, np.uint32) if whole and a.max() <= np.iinfo(kind).max), a)


def _bytes(*arrays: np.ndarray) -> bytes:
    codec = pa.Codec("zstd", compression_level=1)
    return pickle.dumps([(a.dtype.str, a.nbytes, codec.compress(np.ascontiguousarray(a).tobytes(), asbytes=True)) for a in arrays])


def _arrays(blob: bytes) -> list[np.ndarray]:
    codec = pa.Codec("zstd")
    return [np.frombuffer(codec.decompress(data, size), kind) if size else np.zeros(0, kind) for kind, size, data in pickle.loads(blob)]


def _chunks(batches):
    """Entries ``ab, key, token, val`` as one packed row per block; a row without a token names a key that is wanted."""
    held, n = [], 0

    def rows():
        ab, key, token, val, there = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((key, token, ab))
        ab, key, token, val, there = ab[order], key[order], token[order], val[order], there[order]
        cuts = np.flatnonzero(np.diff(ab)) + 1
        blobs = []
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(ab)], strict=True):
            entry = there[lo:hi]
            keys, at = np.unique(key[lo:hi][entry], return_inverse=True)
            blobs.append(_bytes(key[lo:hi][~entry], keys, _narrow(at), token[lo:hi][entry], _narrow(val[lo:hi][entry])))
        return pa.RecordBatch.from_arrays([pa.array(ab[np.r_[0, cuts]], pa.int32()), pa.array(blobs, pa.binary())], ["ab", "blob"])

    for batch in batches:
        token = batch.column("token")
        there = token.is_valid().to_numpy(zero_copy_only=False)
        ab, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("ab", "key"))
        held.append((ab, key.astype(np.int64), token.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64),
                     batch.column("val").fill_null(0.0).to_numpy(zero_copy_only=False), there))
        n += len(ab)
        if n >= CHUNK_ENTRIES:
            yield rows()
            held, n = [], 0
    if n:
        yield rows()


def _merged(normalise: bool, some: bool):
    """The chunks of a block as one row: ``keys``, entries of each, different tokens, and of each entry its token's place among these and its weight."""
    def run(batches):
        chunks: dict[int, list[bytes]] = {}
        for batch in batches:
            for ab, blob in zip(batch.column("ab").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                chunks.setdefault(ab, []).append(blob)
        for ab in list(chunks):
            parts = [_arrays(blob) for blob in chunks.pop(ab)]
            key = np.concatenate([keys[at] for _, keys, at, _, _ in parts])
            token, val = np.concatenate([p[3] for p in parts]), np.concatenate([p[4].astype(np.float64) for p in parts])
            if some:
                keep = np.isin(key, np.concatenate([p[0] for p in parts]))
                key, token, val = key[keep], token[keep], val[keep]
            if not len(key):
                continue
            keys, row = np.unique(key, return_inverse=True)
            norm = np.sqrt(np.bincount(row, val * val)) if normalise else np.zeros(0)
            tokens, code = np.unique(token, return_inverse=True)
            order = np.lexsort((code, row))
            row, code, val = row[order], code[order], val[order]
            first = np.r_[True, (row[1:] != row[:-1]) | (code[1:] != code[:-1])]
            if not first.all():  # a token twice in an item
                row, code, val = row[first], code[first], np.add.reduceat(val, np.flatnonzero(first))
            blob = _bytes(keys, np.bincount(row).astype(np.int32), tokens, _narrow(code), _narrow(val), norm)
            yield pa.RecordBatch.from_arrays([pa.array([ab], pa.int32()), pa.array([blob], pa.binary())], ["ab", "blob"])

    return run


class _Block:
    """Items of a packed row."""

    def __init__(self, blob: bytes):
        self.keys, self.sizes, self.tokens, code, val, norm = _arrays(blob)
        self.code = code.astype(np.int32)
        self.val = val / np.repeat(norm, self.sizes) if len(norm) else val.astype(np.float64)
        self.first = np.r_[0, np.cumsum(self.sizes, dtype=np.int64)]
        self.count = np.bincount(self.code, minlength=len(self.tokens))

    def sketch(self, common: np.ndarray) -> np.ndarray:
        """A row per item: its weights of the common tokens, and the length of its weights in each bucket of others. The product of two
        rows is at least that of the items (Cauchy-Schwarz in each bucket)."""
        at = np.minimum(np.searchsorted(common, self.tokens), max(0, len(common) - 1))
        bucket = (self.tokens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(BUCKETS) + np.uint64(len(common))
        place = np.where(common[at] == self.tokens, at, bucket.astype(np.int64)) if len(common) else bucket.astype(np.int64)
        width = len(common) + BUCKETS
        out = np.empty((len(self.keys), width), np.float32)
        for lo in range(0, len(out), 1024):
            hi = min(lo + 1024, len(out))
            e = slice(self.first[lo], self.first[hi])
            cell = np.repeat(np.arange(hi - lo) * width, self.sizes[lo:hi]) + place[self.code[e]]
            out[lo:hi] = np.sqrt(np.bincount(cell, self.val[e] ** 2, (hi - lo) * width)).reshape(hi - lo, width)
        return out


class _BlockBest(_SparseBest):
    """The best ``k`` of a block of items, over blocks met one after another."""

    def __init__(self, block: _Block, k: int, digits: int, common: np.ndarray):
        super().__init__(np.repeat(block.keys, block.sizes), block.code.astype(np.int64), block.val, k, digits)
        self.block, self.common, self.own = block, common, None

    def meet(self, other: _Block, apart: bool) -> tuple[int, int, int]:
        """As ``take``."""
        at = np.minimum(np.searchsorted(self.block.tokens, other.tokens), len(self.block.tokens) - 1)
        known = self.block.tokens[at] == other.tokens
        if int((self.block.count[at] * other.count)[known].sum()) > DENSE * len(self.keys) * len(other.keys):
            return self._sketched(other, at, known, apart)
        entry = known[other.code]
        if not entry.any():
            return len(self.keys), len(self.keys), 0
        return self.take(np.repeat(other.keys, other.sizes)[entry], at[other.code[entry]], other.val[entry], apart)

    def _sketched(self, other: _Block, at: np.ndarray, known: np.ndarray, apart: bool) -> tuple[int, int, int]:
        """Pairs whose sketches' product reaches an anchor's k-th score are scored, those with the largest products first."""
        self._merge()
        if self.own is None:
            self.own = self.block.sketch(self.common)
        theirs = other.sketch(self.common)
        place = np.full(len(self.block.tokens), -1)
        place[at[known]] = np.flatnonzero(known)
        longest = float(np.sqrt((theirs * theirs).sum(axis=1)).max())
        slack = 10.0 ** -self.digits + 2e-4 * longest * np.sqrt((self.own * self.own).sum(axis=1))  # single precision
        itself = np.minimum(np.searchsorted(other.keys, self.keys), len(other.keys) - 1)
        apart = apart & (other.keys[itself] == self.keys)
        weight = np.zeros(len(other.tokens))
        products = idle = 0

        def scored(cols: np.ndarray) -> np.ndarray:
            nonlocal products
            n = other.sizes[cols]
            start = np.r_[0, np.cumsum(n)[:-1]]
            entry = np.arange(int(n.sum())) + np.repeat(other.first[cols] - start, n)
            products += len(entry)
            return np.round(np.add.reduceat(weight[other.code[entry]] * other.val[entry], start), self.digits)

        step = max(1, SCORES // len(other.keys))
        for lo in range(0, len(self.keys), step):
            bound = self.own[lo: lo + step] @ theirs.T
            for i, most in enumerate(bound, lo):
                if apart[i]:
                    most[itself[i]] = -np.inf
                cols = np.flatnonzero(most >= max(self.scores[i, -1] - slack[i], 0.0))
                if not len(cols):
                    idle += 1
                    continue
                own = slice(self.block.first[i], self.block.first[i + 1])
                mine = place[self.block.code[own]]
                weight[mine[mine >= 0]] = self.block.val[own][mine >= 0]
                take, score, done = self.k, self.scores[i], []
                while len(cols):
                    if len(cols) > 2 * take:
                        order = np.argpartition(most[cols], len(cols) - take)
                        now, cols = cols[order[-take:]], cols[order[:-take]]
                    else:
                        now, cols = cols, cols[:0]
                    done.append((now, scored(now)))
                    score = np.r_[score, done[-1][1]]
                    reached = np.partition(score, len(score) - self.k)[len(score) - self.k]
                    cols, take = cols[most[cols] >= reached - slack[i]], 8 * take
                cols, score = (np.concatenate(c) for c in zip(*done, strict=True))
                weight[mine[mine >= 0]] = 0.0
                keep = (score > 0) & (score >= self.scores[i, -1])
                if keep.any():
                    score, key = np.r_[self.scores[i], score[keep]], np.r_[self.ids[i], other.keys[cols[keep]]]
                    order = np.lexsort((key, -score))[: self.k]
                    self.scores[i], self.ids[i] = score[order], key[order]
        return idle, len(self.keys), products


def sparse_topk(entries: DataFrame, k: int, candidates: DataFrame | None = None, block_rows: int = 32768, candidate_rows: int = 131072,
                n: int | None = None, counted=None, normalise: bool = False, only: DataFrame | None = None, spent: bool = False) -> DataFrame:
    """Best ``k`` candidates of positive inner product per item, both flat as ``key, token, val`` with positive weights; without
    ``candidates`` the items are compared with each other, themselves left out. Returns ``anchor_vacancy_id, recom_vacancy_id, score, pos``.
    ``n``: how many keys the items have, if known. ``counted``: three accumulators, of the (anchor, candidate block) pairs ruled out, of all of them, and of the products computed.
    ``normalise``: the items are scaled to length 1. ``only``: the keys that take part. ``spent``: ``entries`` is a table to be dropped once it has been packed.

    Items are packed in blocks, a row each, written once. A task has one block of anchors and reads all blocks of candidates (or a share
    of them) from that table, one after another: no copy of an entry is shuffled or stored, whatever the number of blocks."""
    spark = entries.sparkSession
    count = lambda df: df.agg(F.countDistinct("key"), F.count(F.lit(1))).first()
    found, size = count(entries) if n is None else (n, entries.count())
    blocks = max(_blocks(found, block_rows) if candidates is None else max(1, -(-found // block_rows)), -(-size // BLOCK_ENTRIES))

    def packed(df: DataFrame, blocks: int, name: str) -> DataFrame:
        ab = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("ab")
        rows = df.select(ab, F.col("key").cast("bigint").alias("key"), F.col("token").cast("bigint").alias("token"), F.col("val").cast("double").alias("val"))
        rows = rows.where(F.col("key").isNotNull() & F.col("token").isNotNull())
        if only is not None:
            rows = rows.unionByName(only.select(ab, F.col("key").cast("bigint").alias("key"), F.lit(None).cast("bigint").alias("token"), F.lit(None).cast("double").alias("val"))
                                        .where(F.col("key").isNotNull()))
        chunks = rows.mapInArrow(_chunks, "ab int, blob binary").repartitionById(blocks, F.col("ab"))
        return materialise(chunks.mapInArrow(_merged(normalise, only is not None), "ab int, blob binary"), name)

    wanted = entries.groupBy("token").agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) & F.col("token").isNotNull())
    wanted = materialise(wanted.withColumn("_all", 2 * F.col("_n") > blocks), "sparse_tokens")
    common = np.array(sorted(r["token"] for r in wanted.where("_all").orderBy(F.col("_n").desc(), "token").limit(COMMON).collect()), dtype=np.int64)
    anchors = packed(entries, blocks, "sparse_anchors")
    if candidates is None:
        source, parts = anchors, blocks
    else:
        nc, size_c = count(candidates)
        parts = max(_blocks(nc, candidate_rows), -(-size_c // BLOCK_ENTRIES))
        source = packed(candidates, parts, "sparse_candidates")
    if spent:
        drop_table(entries)
    groups = min(parts, max(1, 3 * SPREAD // blocks))
    apart = candidates is None

    def run(batches):
        bests: dict[int, _BlockBest] = {}
        for batch in batches:
            for i in range(len(batch)):
                ab = batch.column("ab")[i].as_py()
                if ab not in bests:
                    bests[ab] = _BlockBest(_Block(batch.column("anchors")[i].as_py()), k, SCORE_DIGITS, common)
                for total, more in zip(counted or (), bests[ab].meet(_Block(batch.column("blob")[i].as_py()), apart), strict=False):
                    total.add(more)
        for best in bests.values():
            yield from _list_batches(best)

    pairs = source.select("blob").coalesce(groups).hint("shuffle_replicate_nl").crossJoin(
        anchors.repartitionById(blocks, F.col("ab")).select("ab", F.col("blob").alias("anchors")))
    with configured(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1"):  # a row holds two blocks
        lists = materialise(pairs.mapInArrow(run, STREAM_SCHEMA), "sparse_lists")
    drop_table(anchors)
    if candidates is not None:
        drop_table(source)
    if groups == 1:
        return lists
    top = materialise(_final_topk(lists.drop("pos"), k), "sparse_top")
    drop_table(lists)
    return top


def _list_batches(best: _SparseBest):
    """The lists in pieces that a task can hand over one by one."""
    best._merge()
    step = max(1, (1 << 18) // best.k)
    for at in range(0, len(best.keys), step):
        keys, scores, ids = best.keys[at: at + step], best.scores[at: at + step], best.ids[at: at + step]
        r, c = np.nonzero(np.isfinite(scores))
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array(keys[r]), pa.array(ids[r, c]), pa.array(scores[r, c]), pa.array((c + 1).astype(np.int32))],
                                             ["anchor_vacancy_id", "recom_vacancy_id", "score", "pos"])


def sparse_i2i(entries: DataFrame, asked: int = 100, include_self: bool = False, token_rows: int = 8192) -> DataFrame:
    """R5 (and R14): exact cosine neighbour list for sparse count vectors
    given flat as ``key, token, val``; zero vectors are dropped.
    ``include_self=True`` keeps the item among its own ``asked``
    neighbours (a plain kNN query) instead of removing it.

    1. Keys with the same vector (a digest of its entries) form a group; the smallest key speaks for it.
    2. The best ``asked + 1`` groups of each group, from blocks of anchors and the entries that share a token with them (``sparse_topk``).
    3. Groups become keys again (of a group only its smallest ``asked + 1`` keys can be needed). A full list of a key alone in its group
       that names only such keys is left as it is; steps 3 and 4 sort and join the others only.
    4. A full kNN query also lists items that share nothing (score 0, the smallest ids first): groups whose list is
       short get them from the smallest ids, a list of bounded length.
    """
    keep = asked if include_self else asked - 1
    wide = asked + 1
    flat = materialise(entries.select(F.col("key").cast("bigint"), F.col("token").cast("bigint"), F.col("val").cast("double"))
                              .where(F.col("val") != 0), "i2i_entries")
    mark = lambda seed: F.sum(F.xxhash64("token", "val", F.lit(seed)).cast("decimal(38,0)"))
    stats = flat.groupBy("key").agg(F.sqrt(F.sum(F.col("val") * F.col("val"))).alias("nrm"), F.count(F.lit(1)).alias("nnz"),
                                    mark(1).alias("d1"), mark(2).alias("d2"))
    stats = materialise(stats, "i2i_stats")
    same = ["nnz", "d1", "d2"]
    heads = stats.groupBy(*same).agg(F.min("key").alias("vid"))
    members = materialise(stats.join(heads, same).select("key", "vid", "nrm"), "i2i_members")
    n, n_groups = members.agg(F.count(F.lit(1)), F.count(F.when(F.col("key") == F.col("vid"), 1))).first()

    # 2. groups against groups
    lists = sparse_topk(flat, wide, block_rows=token_rows * 4, n=n_groups, normalise=True, only=members.where(F.col("key") == F.col("vid")), spent=True)
    heads = members.where(F.col("key") == F.col("vid")).select("vid")
    if include_self:
        plain, odd = None, heads
    else:  # a key alone in its group, whose list is full and names only such keys, has its list already
        crowds = materialise(members.where(F.col("key") != F.col("vid")).select("vid").distinct(), "i2i_crowds")
        full = lists.groupBy("anchor_vacancy_id").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") >= min(keep, n - 1))
        mixed = lists.join(crowds.withColumnRenamed("vid", "recom_vacancy_id"), "recom_vacancy_id", "left_semi").select(F.col("anchor_vacancy_id").alias("vid"))
        odd = materialise(heads.join(full.select(F.col("anchor_vacancy_id").alias("vid")), "vid", "left_anti").unionByName(crowds).unionByName(mixed)
                               .distinct(), "i2i_odd")
        plain = lists.join(odd.withColumnRenamed("vid", "anchor_vacancy_id"), "anchor_vacancy_id", "left_anti").where(F.col("pos") <= keep)
        lists = lists.join(odd.withColumnRenamed("vid", "anchor_vacancy_id"), "anchor_vacancy_id", "left_semi")
    groups = lists.select(F.col("anchor_vacancy_id").alias("vid"), F.col("recom_vacancy_id").alias("other"), "score")
    itself = odd.select("vid", F.col("vid").alias("other"), F.lit(1.0).alias("score"))

    # 3. keys of the groups
    low = F.row_number().over(W.partitionBy("vid").orderBy("key"))
    first = members.withColumn("_m", low).where(F.col("_m") <= wide).select(F.col("vid").alias("other"), F.col("key").alias("recom_vacancy_id"))
    listed = groups.unionByName(itself).join(first, "other").select(F.col("vid").alias("anchor_vacancy_id"), "recom_vacancy_id", "score")
    top = materialise(_final_topk(listed, wide), "i2i_top")

    # 4. zero scores
    short = (top.groupBy("anchor_vacancy_id").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") < min(wide, n)).select("anchor_vacancy_id"))
    smallest = (members.select("key").orderBy("key").limit(2 * wide).agg(F.sort_array(F.collect_list("key")).alias("ids")))
    fill = (short.select("anchor_vacancy_id", F.explode(smallest.scalar()).alias("recom_vacancy_id"))
                 .join(top.select("anchor_vacancy_id", "recom_vacancy_id"), ["anchor_vacancy_id", "recom_vacancy_id"], "left_anti")
                 .withColumn("score", F.lit(0.0)))
    lists = _final_topk(top.drop("pos").unionByName(fill), wide).withColumnRenamed("anchor_vacancy_id", "vid")
    each = members.select("vid", F.col("key").alias("anchor_vacancy_id"))
    if include_self:
        out = each.join(lists.where(F.col("pos") <= keep), "vid")
    else:
        lists = materialise(lists, "i2i_lists")
        own = lists.select("vid", F.col("recom_vacancy_id").alias("anchor_vacancy_id"), F.col("pos").alias("_own"))
        out = (each.join(own, ["vid", "anchor_vacancy_id"], "left").join(lists, "vid")
                   .where(F.col("anchor_vacancy_id") != F.col("recom_vacancy_id"))
                   .withColumn("pos", F.col("pos") - F.when(F.col("pos") > F.col("_own"), 1).otherwise(0)).where(F.col("pos") <= keep))
    columns = ["anchor_vacancy_id", "recom_vacancy_id", "score", F.col("pos").cast("int").alias("pos")]
    return out.select(*columns) if plain is None else out.select(*columns).unionByName(plain.select(*columns))


def sparse_query(queries: DataFrame, index: DataFrame, k: int, keys: DataFrame | None = None) -> DataFrame:
    """R14, query side: the ``k`` nearest items of an index for vectors that are not in it, by cosine; both flat as ``key, token, val``.
    Ties and the items that share nothing (score 0) come by the smallest id, as a full kNN query gives them. ``keys`` names all queries,
    also those without an entry (no known word)."""
    def whole(df: DataFrame, name: str) -> DataFrame:
        """``key, _n`` (norm) and the entries of each item, from one shuffle."""
        flat = df.select(F.col("key").cast("bigint"), F.col("token").cast("bigint"), F.col("val").cast("double")).where(F.col("val") != 0)
        return materialise(flat.groupBy("key").agg(F.sqrt(F.sum(F.col("val") * F.col("val"))).alias("_n"), F.collect_list(F.struct("token", "val")).alias("_e")), name)

    def unit(items: DataFrame) -> DataFrame:
        return items.select("key", "_n", F.explode("_e").alias("_e")).select("key", "_e.token", (F.col("_e.val") / F.col("_n")).alias("val"))

    q = materialise(unit(whole(queries, "query_items")), "query_entries")
    items = whole(index, "index_items")
    known = q.select("token").distinct()
    near = sparse_topk(q, k, candidates=materialise(unit(items).join(known, "token", "left_semi"), "index_entries"))
    asked = (q if keys is None else keys).select(F.col("key").cast("bigint").alias("anchor_vacancy_id")).distinct()
    short = asked.join(near.groupBy("anchor_vacancy_id").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") >= k), "anchor_vacancy_id", "left_anti")
    smallest = items.select("key").orderBy("key").limit(2 * k).agg(F.sort_array(F.collect_list("key")).alias("ids"))
    fill = (short.select("anchor_vacancy_id", F.explode(smallest.scalar()).alias("recom_vacancy_id"))
                 .join(near.select("anchor_vacancy_id", "recom_vacancy_id"), ["anchor_vacancy_id", "recom_vacancy_id"], "left_anti")
                 .withColumn("score", F.lit(0.0)))
    return _final_topk(near.drop("pos").unionByName(fill), k)


# ----------------------------------------------------------------- R9 / R10
def cell_topk(queries: DataFrame, candidates: DataFrame, k: int, rows: int = BLOCK_ROWS, candidate_rows: int = 1024) -> DataFrame:
    """Best ``k`` candidates of the same ``cell`` per query (``key, vec,
    cell``; a query may ask several cells), itself left out. The queries of a
    cell are dealt out in blocks, past which the cell's candidate blocks are
    streamed; the lists of a query's cells are merged at the end."""
    blocks = lambda n: F.ceil(F.count(F.lit(1)) / F.lit(n)).cast("int")
    nq = queries.groupBy(F.col("cell").alias("_q")).agg(blocks(rows).alias("nq"))
    nc = candidates.groupBy(F.col("cell").alias("cell")).agg(blocks(candidate_rows).alias("nc"))
    sizes = nq.join(nc, F.col("_q") == F.col("cell")).select("cell", "nq", "nc")  # a row per cell
    upto = F.sum("nq").over(W.orderBy("cell").rowsBetween(W.unboundedPreceding, -1))
    sizes = materialise(sizes.withColumn("first", F.coalesce(upto, F.lit(0)).cast("int")), "cell_blocks")
    total = sizes.agg(F.sum("nq")).first()[0] or 1
    own = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    rest = [F.col("key").cast("bigint").alias("key"), F.col("vec"), F.lit(None).cast("bigint").alias("other")]
    q = queries.join(sizes, "cell").select((F.col("first") + own("nq")).alias("ab"), F.lit(0).alias("g"), F.lit(-1).alias("cb"), F.lit(0).alias("role"), *rest)
    c = candidates.join(sizes, "cell").select(F.explode(F.sequence("first", F.col("first") + F.col("nq") - 1)).alias("ab"), F.lit(0).alias("g"),
                                              own("nc").alias("cb"), F.lit(2).alias("role"), *rest)
    parts = _stream(q.unionByName(c).repartitionById(int(total), F.col("ab")), k, True)
    return _final_topk(parts.drop("pos"), k)


def query_topk(qkeys: np.ndarray, qmat: np.ndarray, candidates: DataFrame, k: int, rows: int = 4096) -> DataFrame:
    """Best ``k`` candidates (``key, vec``) per query by inner product, for
    a bounded query matrix (shipped with the task closure). Candidates are
    grouped in blocks by key hash and not replicated; a final
    ``row_number() <= k`` per query merges the blocks."""
    nb = max(1, math.ceil(candidates.count() / rows))
    c = candidates.select("key", "vec").withColumn("blk", F.pmod(F.xxhash64("key"), F.lit(nb)).cast("int"))

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        ck, cm = _dense_block(pdf[["key", "vec"]])
        bs, bi = _block_best(np.round(qmat @ cm.T, SCORE_DIGITS), ck, k)
        r, j = np.nonzero(np.isfinite(bs))
        return pd.DataFrame({"anchor_vacancy_id": qkeys[r], "recom_vacancy_id": bi[r, j], "score": bs[r, j]})

    return _final_topk(c.groupBy("blk").applyInPandas(block, OUT_SCHEMA), k)
