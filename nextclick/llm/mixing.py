"""Mixing sources to target weights by balanced sampling (cube method).

A document of a source that is to give ``r`` times its words is taken
``floor(r)`` times, and once more with probability ``r - floor(r)``. Which
documents get the further copy is decided by the cube method: the vector of
probabilities moves inside the null space of the constraints (documents and
words of the source) until every entry but a few is 0 or 1. The flight runs in blocks of
about a thousand documents of one source; what each block leaves undecided (at most
one document per constraint) meets in blocks of the next level, until one
block per source is left, whose last documents are a small landing problem.

Defined cases: a null text has size 0; a null source is a source, the last one; a
source without words has target 0 and its documents are not taken; equal rows are units of
their own; an empty table gives an empty result. The choice depends on ids, sizes and
the seed only, so reruns agree whatever the partitions.
"""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nextclick.llm.common import WORD, file_keyed, fresh, materialise, read, row_keyed

EPS = 1e-9


def null_direction(a: np.ndarray) -> np.ndarray:
    """A vector u with a @ u = 0 for a matrix with more columns than rows."""
    return np.linalg.svd(a)[2][-1]


def flight(p: np.ndarray, constraints: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move the probabilities ``p`` at random, without changing ``constraints @ p`` or any expectation, until no more
    than one entry per constraint is fractional. Each step looks at one more unit than there are constraints."""
    p = p.copy()
    width = len(constraints) + 1
    scale = np.abs(constraints).max(axis=1, keepdims=True)
    a = constraints / np.where(scale > 0, scale, 1.0)
    waiting = [i for i in range(len(p)) if EPS < p[i] < 1 - EPS]
    active: list[int] = []
    while True:
        while waiting and len(active) < width:
            active.append(waiting.pop())
        if len(active) < width:
            return p
        u = null_direction(a[:, active])
        now = p[active]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > EPS, (1 - now) / u, np.where(u < -EPS, -now / u, np.inf)).min()
            down = np.where(u > EPS, now / u, np.where(u < -EPS, (now - 1) / u, np.inf)).min()
        p[active] = now + (up * u if rng.random() < down / (up + down) else -down * u)
        for i in active:
            p[i] = 0.0 if p[i] <= EPS else 1.0 if p[i] >= 1 - EPS else p[i]
        active = [i for i in active if 0.0 < p[i] < 1.0]


def landing(start: np.ndarray, p: np.ndarray, constraints: np.ndarray) -> np.ndarray:
    """Decide the few entries that the flight from ``start`` has left: of all ways to round them, the one whose totals are
    nearest to what was expected. A long document among them can still leave a gap; then one or two of the units that were open at ``start``
    change sides, where that brings the totals nearer. ``constraints`` are in the order of their weight."""
    open_ = np.flatnonzero((start > EPS) & (start < 1 - EPS))
    left = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    p = p.copy()
    if len(open_) == 0:
        return np.round(p)
    a = constraints / np.maximum(np.abs(constraints[:, open_]).mean(axis=1, keepdims=True), EPS)
    a = a * (0.05 ** np.arange(len(a)))[:, None]
    if len(left):
        ways = np.array(list(itertools.product([0.0, 1.0], repeat=len(left))))
        p[left] = ways[int(np.abs((ways - p[left]) @ a[:, left].T).sum(axis=1).argmin())]
    p = np.round(p)
    off = a @ (p - start)
    step = np.where(p[open_] > 0, -1.0, 1.0) * a[:, open_]
    one = np.abs(off[:, None] + step).sum(axis=0)
    two = np.abs(off[:, None, None] + step[:, :, None] + step[:, None, :]).sum(axis=0)
    np.fill_diagonal(two, np.inf)
    best = min(np.abs(off).sum(), one.min(), two.min())
    if best < np.abs(off).sum():
        flip = np.unravel_index(int(two.argmin()), two.shape) if two.min() <= one.min() else (int(one.argmin()),)
        p[open_[list(flip)]] = 1.0 - p[open_[list(flip)]]
    return p


def balanced_sample(units: DataFrame, group: str, key: list[str], balance: list[str], block: int = 1024, seed: int = 11) -> DataFrame:
    """Decide ``p`` (0 to 1) of every unit: the rows of ``units`` with ``chosen`` 0 or 1.

    Inside each value of ``group`` the number of units and the totals of the columns ``balance`` stay as expected.
    ``key`` orders the units. A task holds a block: about ``block`` units, or what as many blocks have left.
    """
    constraints = len(balance) + 1
    fan = max(2, block // constraints)
    sizes = units.groupBy(group).agg(F.count("*").alias("__n"))
    blocks = F.ceil(F.col("__n") / block).cast("bigint")
    placed = (units.join(sizes.withColumnRenamed(group, "__group"), F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
              .withColumn("__block", F.pmod(F.xxhash64(*key, F.lit(seed)), blocks)).drop("__n"))
    most = sizes.agg(F.max(blocks)).first()[0] or 0
    schema = placed.schema

    def fly(last: bool):
        def run(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values(key, kind="stable").reset_index(drop=True)
            rows = np.vstack([*[frame[c].to_numpy(dtype=float) for c in balance], np.ones(len(frame))])
            start = frame["p"].to_numpy(dtype=float)
            first = frame.iloc[0]
            rng = np.random.default_rng(zlib.crc32(f"{seed}:{first[group]}:{first['__block']}:{len(frame)}".encode()))
            p = flight(start, rows, rng)
            frame["p"] = landing(start, p, rows) if last else p
            return frame
        return run

    done: DataFrame | None = None
    while True:
        last = most <= 1
        placed = materialise(placed.groupBy(group, "__block").applyInPandas(fly(last), schema), "cube_level")
        decided = placed if last else placed.where("p = 0 or p = 1")
        done = decided if done is None else done.unionByName(decided)
        if last:
            return done.withColumn("chosen", F.col("p").cast("int")).drop("__block", "p")
        placed = placed.where("p > 0 and p < 1").withColumn("__block", F.floor(F.col("__block") / fan))
        most = -(-most // fan)


def target_sizes(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """source, source_size in; target added. Sources in code-point order, null last, weigh ``weights`` over and over and share the
    total; none gets more than ``most`` times its size, what is over goes to the others by weight. Sorted by the share at which they
    are full, the full ones are a prefix, so running sums say which. One row per source passes this window."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    full = F.col("source_size") * most
    each = sources.withColumn("__w", F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)).withColumn("__full", full)
    before = Window.orderBy(F.col("__full") / F.col("__w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    each = (each.withColumn("__total", F.sum("source_size").over(whole)).withColumn("__weights", F.sum("__w").over(whole))
            .withColumn("__given", F.coalesce(F.sum("__full").over(before), F.lit(0)))
            .withColumn("__weighed", F.coalesce(F.sum("__w").over(before), F.lit(0))))
    capped = F.col("__full") * (F.col("__weights") - F.col("__weighed")) <= (F.col("__total") - F.col("__given")) * F.col("__w")
    each = each.withColumn("__capped", capped)
    rest = F.col("__total") - F.coalesce(F.sum(F.when(F.col("__capped"), F.col("__full"))).over(whole), F.lit(0))
    weight = F.sum(F.when(~F.col("__capped"), F.col("__w"))).over(whole)
    target = F.when(F.col("__capped"), F.col("__full").cast("double")).otherwise(F.col("__w") * (rest / weight))
    return each.withColumn("target", target).select("source", "source_size", "target")


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 11) -> DataFrame:
    """row_key, doc_id, source and text in; row_key, doc_id, source, size, source_size, target, copies, taken out."""
    units = materialise(docs.select("row_key", "doc_id", "source", words(F.col("text")).alias("size")), "mix_sizes")
    sources = materialise(target_sizes(units.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix_targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = (units.join(sources.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
             .withColumn("__rate", F.round(rate, 12)).withColumn("whole", F.floor("__rate").cast("int")).withColumn("p", F.col("__rate") - F.col("whole")).drop("__rate"))
    chosen = balanced_sample(units, "source", ["doc_id", "size", "row_key"], ["size"], seed=seed)
    return (chosen.withColumn("copies", F.col("whole") + F.col("chosen")).drop("whole", "chosen")
            .withColumn("taken", F.col("size") * F.col("copies")))


def op8_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(row_keyed(read(spark, sf_dir, "documents"))).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its columns as they came."""
    row, times = fresh(docs, "__row"), fresh(docs, "__copies")
    keyed = file_keyed(docs, row)
    taken = mix(keyed.select(F.col(row).alias("row_key"), "doc_id", "source", "text")).where("copies > 0")
    taken = taken.select(F.col("row_key").alias(row), F.col("copies").alias(times))
    return keyed.join(taken, row).select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(times))).alias(times)).drop(times)
