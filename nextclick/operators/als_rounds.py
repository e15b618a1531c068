"""Rounds of implicit ALS (Hu, Koren and Volinsky; regularised by the number of positive ratings, as Spark's).

Both sides (users, items) are dealt into blocks by id. One shuffle is one half round: a block's task gets its ratings and, from every block
of the other side, that block's Gram matrix and what the ratings need of it. It solves its rows and sends the like to the other side.
Of a row with few ratings in a block the vectors travel, each once per block; a row with ``rank`` or more there gets the finished
sum of its equations, so that neither a popular item nor a busy user pulls all vectors into one task.

The equations of a row with ratings c on vectors Y are (Y'Y + reg n I + Yr' C Yr) x = Yr' b. Y'Y is the same for a block's rows, its
eigenvectors turn all but the last term into a diagonal, and a row with m < rank / 2 ratings takes an m x m system (Woodbury) in place of a
rank x rank one. The others are solved as they stand. No random number is drawn here; vectors are single precision between half rounds,
sums are double.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextclick.sources.tables import drop_table, materialise

#: Ratings of a block, rows of a block that may all have finished sums, blocks a side should have if it has the rows, and ratings
#: below which fewer blocks do.
BLOCK_RATINGS, BLOCK_ROWS, SPREAD, FEW_RATINGS = 150_000, 512, 16, 10_000
#: Numbers solved together.
TOGETHER = 1 << 22

RATINGS, MESSAGE, FACTORS = 0, 1, 2
#: ratings: own ids, the other side's ids, weights. message: ids and vectors, ids and their sums, Gram matrix. factors: ids, vectors.
SCHEMA = "block int, role int, ids binary, others binary, values binary, sums binary, gram binary"


def _row(block: int, role: int, *fields: np.ndarray | None) -> pa.RecordBatch:
    parts = [None if f is None else np.ascontiguousarray(f).tobytes() for f in fields] + [None] * (5 - len(fields))
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([role], pa.int32()), *(pa.array([p], pa.binary()) for p in parts)],
                                      names=["block", "role", "ids", "others", "values", "sums", "gram"])


def _pack(rows: DataFrame, side: str, blocks: int, role: int) -> DataFrame:
    """One row per block and batch of ``side`` (int) and two more columns (other ids and weights, or a null and a vector)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if role == RATINGS:
                columns = [batch.column(1).to_numpy(), batch.column(2).to_numpy()]
            else:
                columns = [None, batch.column(1).flatten().to_numpy().reshape(len(ids), -1)] if len(ids) else []
            of = ids % blocks
            for block in np.unique(of).tolist():
                at = np.flatnonzero(of == block)
                yield _row(block, role, ids[at], *(None if c is None else c[at] for c in columns))

    return rows.repartition(blocks, F.col(side) % blocks).mapInArrow(run, SCHEMA)


def _triangle(sums: np.ndarray, rank: int) -> np.ndarray:
    """Square symmetric matrices of upper triangles."""
    rows, cols = np.triu_indices(rank)
    out = np.empty((len(sums), rank, rank))
    out[:, rows, cols] = sums
    out[:, cols, rows] = sums
    return out


class _Block:
    """One block of a side while its rows arrive."""

    def __init__(self, block: int, rank: int, reg: float, alpha: float):
        self.block, self.rank, self.reg, self.alpha = block, rank, reg, alpha
        self.ratings: list[tuple] = []
        self.vectors: list[tuple] = []
        self.given: list[tuple] = []
        self.half = rank * (rank + 1) // 2
        self.gram = np.zeros(self.half)
        self.summed: dict[int, np.ndarray] = {}

    def take(self, role: int, ids: bytes, others: bytes | None, values: bytes, sums: bytes | None, gram: bytes | None) -> None:
        ids = np.frombuffer(ids, np.int32)
        values = np.frombuffer(values, np.float32)
        if role == RATINGS:
            self.ratings.append((ids, np.frombuffer(others, np.int32), values))
            return
        (self.vectors if role == MESSAGE else self.given).append((ids, values.reshape(len(ids), self.rank)))
        if role == MESSAGE:
            self.gram += np.frombuffer(gram, np.float64)
            more = np.frombuffer(sums, np.float64).reshape(-1, self.half + self.rank)
            for row, total in zip(np.frombuffer(others, np.int32).tolist(), more, strict=True):
                have = self.summed.get(row)
                if have is None:
                    self.summed[row] = total.copy()
                else:
                    have += total

    def finish(self, other_blocks: int, send: bool, keep: bool) -> Iterator[pa.RecordBatch]:
        if not self.ratings:  # no id falls into the block
            return
        own, other, weight = (np.concatenate(c) for c in zip(*self.ratings, strict=True))
        ids, at = np.unique(own, return_inverse=True)
        confidence = self.alpha * np.abs(weight.astype(np.float64))
        target = np.where(weight > 0, 1.0 + confidence, 0.0)
        if self.given:
            known, x = (np.concatenate(c) for c in zip(*self.given, strict=True))
            x = x[np.argsort(known)]
        else:
            x = self._solve(ids, at, other, weight, confidence, target, other_blocks)
        if keep:
            yield _row(self.block, FACTORS, ids, None, x)
        if send:
            yield from self._messages(at, ids, other, confidence, target, x, other_blocks)

    def _solve(self, ids, at, other, weight, confidence, target, other_blocks) -> np.ndarray:
        rank, n = self.rank, len(ids)
        _, pair, count = np.unique(at * np.int64(other_blocks) + other % other_blocks, return_inverse=True, return_counts=True)
        shift = self.reg * np.bincount(at, weight > 0, n)
        light = np.flatnonzero(count[pair] < rank)
        light = light[np.lexsort((other[light], at[light]))]
        vids, vectors = (np.concatenate(c) for c in zip(*self.vectors, strict=True))
        order = np.argsort(vids)
        vids, vectors = vids[order], vectors[order].astype(np.float64)
        place, at, confidence, target = np.searchsorted(vids, other[light]), at[light], confidence[light], target[light]
        gram = _triangle(self.gram[None], rank)[0]
        size = np.bincount(at, minlength=n)
        first = np.r_[0, np.cumsum(size)]
        whole = (2 * size >= rank) | (shift <= 0) | np.isin(ids, np.fromiter(self.summed, np.int64, len(self.summed)))
        x = np.empty((n, rank), np.float32)

        values, turn = np.linalg.eigh(gram)
        values = np.maximum(values, 0.0)
        turned = vectors @ turn
        for m in np.unique(size[~whole]).tolist():
            rows = np.flatnonzero(~whole & (size == m))
            step = max(1, TOGETHER // (max(m, 1) * rank))
            for some in (rows[i: i + step] for i in range(0, len(rows), step)):
                ratings = first[some][:, None] + np.arange(m)
                z, c, b = turned[place[ratings]], confidence[ratings], target[ratings]
                over = z / (values + shift[some][:, None])[:, None, :]
                s = over @ z.transpose(0, 2, 1)
                y = np.linalg.solve(np.eye(m) + s * c[:, None, :], s @ b[:, :, None])[:, :, 0]
                x[some] = np.einsum("bm,bmk->bk", b - c * y, over) @ turn.T

        nothing = np.zeros(self.half + rank)
        for i in np.flatnonzero(whole).tolist():
            total = self.summed.get(int(ids[i]), nothing)
            y = vectors[place[first[i]: first[i + 1]]]
            c, b = confidence[first[i]: first[i + 1]], target[first[i]: first[i + 1]]
            a = gram + _triangle(total[None, :self.half], rank)[0] + (y * c[:, None]).T @ y
            a[np.diag_indices(rank)] += shift[i]
            x[i] = np.linalg.solve(a, total[self.half:] + y.T @ b)
        return x

    def _messages(self, at, ids, other, confidence, target, x, other_blocks) -> Iterator[pa.RecordBatch]:
        rank = self.rank
        rows, cols = np.triu_indices(rank)
        wide = x.astype(np.float64)
        gram = (wide.T @ wide)[rows, cols]
        theirs, pair, count = np.unique(other, return_inverse=True, return_counts=True)
        light = count[pair] < rank
        wanted = np.unique((other[light] % other_blocks) * np.int64(len(ids)) + at[light])
        order = np.argsort(pair, kind="stable")
        end = np.cumsum(count)
        summed = np.flatnonzero(count >= rank)
        for block in range(other_blocks):
            lo, hi = np.searchsorted(wanted, [block * len(ids), (block + 1) * len(ids)])
            mine = wanted[lo:hi] - block * len(ids)
            here = summed[theirs[summed] % other_blocks == block]
            sums = np.empty((len(here), self.half + rank))
            for j, t in enumerate(here.tolist()):
                r = order[end[t] - count[t]: end[t]]
                y = wide[at[r]]
                sums[j, :self.half] = ((y * confidence[r][:, None]).T @ y)[rows, cols]
                sums[j, self.half:] = y.T @ target[r]
            yield _row(block, MESSAGE, ids[mine], theirs[here], x[mine], sums, gram)


def _half_round(rows: DataFrame, ratings: DataFrame, blocks: int, other_blocks: int, rank: int, reg: float, alpha: float,
                send: bool = True, keep: bool = False) -> DataFrame:
    """Solves a side's rows from what the other side sent (or takes the given ones); messages to the other side and, on demand, the factors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if here is None or here.block != row[0]:
                    if here is not None:
                        yield from here.finish(other_blocks, send, keep)
                    here = _Block(row[0], rank, reg, alpha)
                here.take(*row[1:])
        if here is not None:
            yield from here.finish(other_blocks, send, keep)

    together = ratings.unionByName(rows).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "role")
    return together.mapInArrow(run, SCHEMA)


def _factors(rows: DataFrame, rank: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                vectors = pa.FixedSizeListArray.from_arrays(pa.array(np.frombuffer(values, np.float32)), rank).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids, np.int32)), vectors], names=["id", "features"])

    return rows.where(F.col("role") == FACTORS).select("ids", "values").mapInArrow(run, "id int, features array<float>")


def _blocks(rows: int, ratings: int) -> int:
    return min(rows, max(min(SPREAD, -(-ratings // FEW_RATINGS)), min(-(-ratings // BLOCK_RATINGS), -(-rows // BLOCK_ROWS))))


def rounds(ratings: DataFrame, users: DataFrame, items: DataFrame, rank: int, n: int, reg: float, alpha: float) -> tuple[DataFrame, DataFrame]:
    """``n`` rounds over ``u, i, weight`` (one row per pair) from the users' factors (``id, features``); a round solves the items, then the
    users. User and item factors as ``id, features``."""
    if n == 0:
        return users, items
    total, n_users, n_items = ratings.agg(F.count("*"), F.count_distinct("u"), F.count_distinct("i")).first()
    ub, ib = _blocks(n_users, total), _blocks(n_items, total)
    by_user = materialise(_pack(ratings.select("u", "i", "weight"), "u", ub, RATINGS), "als_by_user")
    by_item = materialise(_pack(ratings.select("i", "u", "weight"), "i", ib, RATINGS), "als_by_item")
    incoming, before = _pack(users.select("id", "features"), "id", ub, FACTORS), None
    for at in range(n):
        sent = _half_round(incoming, by_user, ub, ib, rank, reg, alpha)
        solved = materialise(_half_round(sent, by_item, ib, ub, rank, reg, alpha, keep=at == n - 1), "als_round")
        if before is not None:
            drop_table(before)
        incoming, before = solved.where(F.col("role") == MESSAGE), solved
    last = materialise(_half_round(incoming, by_user, ub, ib, rank, reg, alpha, send=False, keep=True), "als_users")
    return _factors(last, rank), _factors(solved, rank)
