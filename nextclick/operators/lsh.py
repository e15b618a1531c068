"""Approximate neighbour lists by random-projection LSH (R9, second form).

The sign of a unit vector's product with a random direction agrees for two
vectors at angle t with probability 1 - t / pi. ``bits`` signs make a bucket
of one table; vectors of a bucket in any of the tables are compared. The
number of tables follows from the recall wanted at a cosine
(``tables_for``), and so does the number of signs of a longer sketch that
must agree before a pair is scored (``agreement_for``).

The tables are one equi-join on (table, bucket): each vector goes to its
bucket of every table. Where the buckets are so large that they hold more
pairs than there are (few ``bits``, many tables), every pair of vectors is
looked at once instead and its buckets are compared there: the same pairs for
less work. A bucket, or all vectors, is dealt out by blocks of ``block_rows``
anchors; a task streams the others past one block. Their products are one
matrix product in single precision, which only tells the pairs that may enter
a list of the best so far; these are held against buckets and sketch, and
scored in double precision. A pair counts in the first table that has it in
one bucket. Lists of all blocks are merged at the end. An item whose buckets
hold fewer than its full list is searched exactly (``streamed_topk``): every
item gets ``asked - 1`` neighbours, or all others.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextclick.operators.knn import BLOCK_ROWS, SCORE_DIGITS, SPREAD, STREAM_SCHEMA, _Best, _final_topk, streamed_topk, unit_vectors
from nextclick.sources.tables import materialise

#: Vectors streamed past a block at once, scores of a product, and pairs checked at once.
PIECE, PRODUCT, CHECKS = 1024, 1 << 20, 1 << 15


def agreement(cosine: float) -> float:
    """Probability that a random sign is the same for two vectors of this cosine."""
    return 1 - math.acos(max(-1.0, min(1.0, cosine))) / math.pi


def tables_for(cosine: float, recall: float, bits: int) -> int:
    """Tables of ``bits`` signs that bring a pair of this cosine into a common bucket with probability ``recall``."""
    met = agreement(cosine) ** bits
    return 1 if met >= recall else math.ceil(math.log(1 - recall) / math.log(1 - met))


def agreement_for(cosine: float, recall: float, signs: int) -> int:
    """How many of ``signs`` a pair of this cosine has in common, or more, with probability ``recall`` (normal approximation)."""
    p = agreement(cosine)
    return math.floor(signs * p - NormalDist().inv_cdf(recall) * math.sqrt(signs * p * (1 - p)))


def place(unit: DataFrame, bits: int, tables: int, signs: int, seed: int = 42) -> DataFrame:
    """``key, vec, codes`` (bucket per table) and ``sketch`` (all signs, packed). Sketch and tables share their directions."""
    signs = max(signs, bits * tables)

    @F.pandas_udf("struct<codes:array<int>,sketch:binary>")
    def marks(vec: pd.Series) -> pd.DataFrame:
        if not len(vec):
            return pd.DataFrame({"codes": [], "sketch": []}, dtype=object)
        mat = np.vstack(vec.to_numpy())
        ahead = mat @ np.random.default_rng(seed).standard_normal((mat.shape[1], signs)) > 0
        codes = ahead[:, : bits * tables].reshape(len(mat), tables, bits) @ (1 << np.arange(bits))
        return pd.DataFrame({"codes": list(codes.astype("int32")), "sketch": [x.tobytes() for x in np.packbits(ahead, axis=1)]})

    return unit.select("key", "vec", marks("vec").alias("m")).select("key", "vec", "m.codes", "m.sketch")


def bucket_blocks(placed: DataFrame, block_rows: int) -> tuple[DataFrame, int]:
    """Rows of ``placed`` dealt to (table ``tab``, bucket ``code``, block of anchors ``ab``): ``role`` 0 are the block's anchors, 1 the
    bucket's vectors. Table -1 has all vectors in one bucket; it stands for the tables if their buckets hold as many pairs as there are.
    Also the number of blocks, if it is table -1 (else 0)."""
    n = placed.count()
    buckets = (placed.select(F.posexplode("codes").alias("tab", "code")).groupBy("tab", "code").agg(F.count(F.lit(1)).alias("_n"))
                     .where(F.col("_n") > 1))
    rows, pairs = buckets.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.col("_n").cast("double") * F.col("_n")), F.lit(0.0))).first()
    whole = pairs >= float(n) * n
    per = min(block_rows, max(64, -(-(n if whole else rows) // (3 * SPREAD))))
    blocks = max(1, -(-n // per)) if whole else 0
    if whole:
        own = placed.select("*", F.lit(-1).alias("tab"), F.lit(0).alias("code"), F.lit(blocks).alias("_nb"))
    else:
        sizes = buckets.select("tab", "code", F.ceil(F.col("_n") / F.lit(per)).cast("int").alias("_nb"))
        own = placed.select("*", F.posexplode("codes").alias("tab", "code")).join(sizes, ["tab", "code"])
    cell = ["tab", "code", "ab", "role", "key", "vec", "sketch"]
    anchors = own.select("*", F.pmod(F.xxhash64("key", F.lit(3)), F.col("_nb")).cast("int").alias("ab"), F.lit(0).alias("role"))
    others = own.select("*", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)).alias("ab"), F.lit(1).alias("role"))
    return anchors.select(cell).unionByName(others.select(cell)), blocks


class _Lists(_Best):
    """The best ``k`` of one block of anchors so far, of the pairs that share a bucket and enough signs."""

    def __init__(self, table: int, keys: np.ndarray, mat: np.ndarray, sketch: np.ndarray, k: int, least: int, signs: int, bits: int, tables: int):
        super().__init__(keys, mat, k, SCORE_DIGITS)
        self.table, self.sketch, self.apart, self.bits, self.tables = table, sketch, signs - least, bits, tables
        self.small = mat.astype(np.float32)
        self.slack = 10.0 ** -SCORE_DIGITS + (mat.shape[1] + 4) * 2.0 ** -23  # more than single precision can be wrong
        self.admitted = 0

    def _meet(self, row: np.ndarray, col: np.ndarray, ckeys: np.ndarray, csketch: np.ndarray) -> np.ndarray:
        """Which pairs have enough signs in common and meet in this table first (table -1: in any)."""
        other = self.sketch[row] ^ csketch[col]
        ok = (np.bitwise_count(other).sum(axis=1, dtype=np.int64) <= self.apart) & (self.keys[row] != ckeys[col])
        upto = self.tables if self.table < 0 else self.table
        if upto:
            at = np.flatnonzero(ok)
            used = self.bits * upto
            differ = np.unpackbits(other[at, : -(-used // 8)], axis=1)[:, :used].reshape(len(at), upto, self.bits).any(axis=2)
            ok[at] = ~differ.all(axis=1) if self.table < 0 else differ.all(axis=1)
        return ok

    def _bar(self, scores: np.ndarray, rows: np.ndarray, ckeys: np.ndarray, csketch: np.ndarray) -> np.ndarray:
        """For anchors without a full list: a score that ``k`` vectors of this piece reach, found among the likeliest (-inf: not found)."""
        wide = min(4 * self.k, scores.shape[1])
        if wide < self.k:
            return np.full(len(rows), -np.inf)
        col = np.argpartition(-scores, wide - 1, axis=1)[:, :wide] if wide < scores.shape[1] else np.broadcast_to(np.arange(wide), scores.shape)
        out = np.empty(len(rows))
        for at in range(0, len(rows), step := max(1, CHECKS // wide)):
            here = col[at: at + step]
            ok = self._meet(np.repeat(rows[at: at + step], wide), here.ravel(), ckeys, csketch).reshape(here.shape)
            found = np.where(ok, np.take_along_axis(scores[at: at + step], here, axis=1), -np.inf)
            out[at: at + step] = np.partition(found, wide - self.k, axis=1)[:, wide - self.k]
        return out

    def add(self, ckeys: np.ndarray, cmat: np.ndarray, csketch: np.ndarray) -> None:
        """Take in a piece of the bucket's vectors."""
        small = cmat.astype(np.float32).T
        for at in range(0, len(self.keys), step := max(1, PRODUCT // len(ckeys))):
            scores = self.small[at: at + step] @ small
            bar = self.scores[at: at + step, -1].copy()
            open_ = np.flatnonzero(~np.isfinite(bar))
            if len(open_):
                bar[open_] = self._bar(scores[open_], at + open_, ckeys, csketch) - self.slack  # single precision itself
            hits = np.flatnonzero(scores >= np.nextafter((bar - self.slack).astype(np.float32), np.float32(-np.inf))[:, None])
            for lo in range(0, len(hits), CHECKS):
                hit = hits[lo: lo + CHECKS]
                row, col = at + hit // len(ckeys), hit % len(ckeys)
                ok = self._meet(row, col, ckeys, csketch)
                row, col = row[ok], col[ok]
                self.admitted += len(row)
                score = np.round(np.einsum("ij,ij->i", self.mat[row], cmat[col]), self.digits)
                good = score >= self.scores[row, -1]
                self.more.append((row[good], ckeys[col[good]], score[good]))
                self.n_more += int(good.sum())
                if 2 * self.n_more > self.scores.size:
                    self._merge()
            if len(open_):
                self._merge()


def lsh_lists(placed: DataFrame, k: int, least: int, signs: int, bits: int, tables: int, block_rows: int = BLOCK_ROWS, scored=None) -> DataFrame:
    """Best ``k`` of the pairs that share a bucket and ``least`` signs. ``scored``: an accumulator of the pairs scored in double precision."""

    def run(batches):
        at = best = None
        held: list[pd.DataFrame] = []

        def parts(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            sketch = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
            return rows["key"].to_numpy().astype("int64"), np.vstack(rows["vec"].to_numpy()), sketch

        def start() -> None:
            nonlocal best
            if held:
                best = _Lists(at[0], *parts(pd.concat(held, ignore_index=True)), k, least, signs, bits, tables)
                held.clear()

        def end() -> pd.DataFrame:
            if scored is not None:
                scored.add(best.admitted)
            return best.rows()

        for pdf in batches:
            place = pdf[["tab", "code", "ab", "role"]].to_numpy().astype("int64")
            cuts = np.flatnonzero((np.diff(place, axis=0) != 0).any(axis=1)) + 1
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(pdf)]):
                if hi == lo:
                    continue
                here = tuple(place[lo].tolist())
                if here[:3] != at:
                    if best is not None:
                        yield end()
                    best, at = None, here[:3]
                    held.clear()
                if here[3] == 0:
                    held.append(pdf.iloc[lo:hi])
                    continue
                start()
                for piece in range(lo, hi, PIECE) if best is not None else ():
                    best.add(*parts(pdf.iloc[piece: min(piece + PIECE, hi)]))
        if best is not None:
            yield end()

    dealt, blocks = bucket_blocks(placed, block_rows)
    dealt = dealt.repartitionById(blocks, F.col("ab")) if blocks else dealt.repartition("tab", "code", "ab")
    lists = dealt.sortWithinPartitions("tab", "code", "ab", "role").mapInPandas(run, STREAM_SCHEMA)
    return _final_topk(lists.drop("pos"), k)


def lsh_i2i(vectors: DataFrame, asked: int = 100, cosine: float = 0.5, recall: float = 0.95, bits: int = 8, signs: int = 512,
            seed: int = 42, block_rows: int = BLOCK_ROWS, scored=None) -> DataFrame:
    """Neighbour list ``anchor_vacancy_id, recom_vacancy_id, score, pos`` of ``asked - 1`` rows per item (or all others). A neighbour of at
    least ``cosine`` is met in a table with probability sqrt(``recall``), and passes the sketch with the same."""
    unit = materialise(unit_vectors(vectors).select(F.col("key").cast("bigint").alias("key"), "vec"), "lsh_vectors")
    each = math.sqrt(recall)
    tables = tables_for(cosine, each, bits)
    signs = max(-(-signs // 8) * 8, -(-bits * tables // 8) * 8)
    placed = materialise(place(unit, bits, tables, signs, seed), "lsh_places")
    k = asked - 1
    lists = materialise(lsh_lists(placed, k, agreement_for(cosine, each, signs), signs, bits, tables, block_rows, scored), "lsh_lists")
    full = min(k, unit.count() - 1)
    enough = lists.groupBy("anchor_vacancy_id").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") >= full).select(F.col("anchor_vacancy_id").alias("key"))
    short = materialise(unit.join(enough, "key", "left_anti"), "lsh_short")
    if short.isEmpty():
        return lists
    exact = streamed_topk(short, k, candidates=unit, exclude=short.select("key", F.col("key").alias("other")))
    kept = lists.join(enough.withColumnRenamed("key", "anchor_vacancy_id"), "anchor_vacancy_id", "left_semi")
    return kept.unionByName(exact)
