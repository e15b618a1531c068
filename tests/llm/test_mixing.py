import numpy as np
from pyspark.sql import functions as F

from conftest import SF01
from helpers import WORD, frame
from nextclick.llm import mixing
from nextclick.llm.common import row_keyed


def water_filled(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weigh = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, full = dict.fromkeys(names, 0.0), set()
    excess = float(sum(sizes.values()))
    while excess > 1e-9:
        free = [s for s in names if s not in full]
        if not free:
            break
        share = excess / sum(weigh[s] for s in free)
        excess = 0.0
        for s in free:
            target[s] += share * weigh[s]
            if target[s] >= most * sizes[s]:
                excess += target[s] - most * sizes[s]
                target[s] = most * sizes[s]
                full.add(s)
    return target


def test_flight_keeps_totals_and_leaves_few():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 5000, 700).astype(float)
    start = np.full(700, 0.3)
    rows = np.vstack([sizes, np.ones(700)])
    p = mixing.flight(start, rows, rng)
    assert ((p > 0) & (p < 1)).sum() <= 2
    assert np.allclose(rows @ p, rows @ start, rtol=1e-6)
    done = mixing.landing(start, p, rows)
    assert set(done) <= {0.0, 1.0} and abs(sizes @ done - sizes @ start) <= 50


def test_flight_is_unbiased():
    sizes, total = np.array([[1.0, 2.0, 3.0, 4.0, 5.0, 6.0]]), np.zeros(6)
    for seed in range(3000):
        total += mixing.flight(np.full(6, 0.4), sizes, np.random.default_rng(seed))
    assert np.allclose(total / 3000, 0.4, atol=0.04)


def test_targets_by_repeated_sharing(spark):
    sizes = {"a": 10, "B": 4000, "é": 50, None: 700, "z": 0, "y": 9000}
    rows = mixing.target_sizes(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    expected = water_filled(sizes)
    assert {r.source for r in rows} == set(sizes)
    for r in rows:
        assert abs(r.target - expected[r.source]) < 1e-6 * max(1, r.target)


def test_sources_come_near_their_targets_and_reruns_agree(spark):
    out = mixing.op8_cube_mix(spark, SF01).toPandas().sort_values("doc_id")
    again = mixing.op8_cube_mix(spark, SF01).toPandas().sort_values("doc_id")
    assert (out.taken.values == again.taken.values).all() and len(out) == 1000
    docs = spark.read.parquet(f"{SF01}/documents.parquet").toPandas().sort_values("doc_id")
    assert list(out["size"]) == [len(WORD.findall(t)) for t in docs.text]
    assert (out.taken <= 3 * out["size"]).all() and (out.taken % out["size"].clip(lower=1) == 0).all()
    by = out.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by.taken - by.target).abs() <= 0.05 * by.target).all()


def test_many_blocks_and_levels(spark):
    units = spark.range(6000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, "hot").alias("g"), (F.col("id") % 97 + 1).alias("w"), F.lit(0.37).alias("p"))
    out = mixing.balanced_sample(units, "g", ["k"], ["w"], block=64).groupBy("g").agg(
        F.sum(F.col("w") * F.col("chosen")).alias("got"), F.sum("w").alias("all"), F.sum("chosen").alias("n"), F.count("*").alias("m")).collect()
    assert sum(r.m for r in out) == 6000 and len(out) == 2
    for r in out:
        assert abs(r.got - 0.37 * r["all"]) <= 20 and abs(r.n - 0.37 * r.m) <= 8


def test_edges_and_stage(spark):
    docs = frame(spark, [(1, None, "a", 9), (1, "x y", "a", 8), (None, "x y z", None, 7), (1, "x y", "a", 6), (5, "", "zz", 5)],
                 "doc_id long, text string, source string, size long")
    rows = mixing.mix(row_keyed(docs)).collect()
    assert len(rows) == 5 and all(r.taken <= 3 * r["size"] for r in rows)
    assert mixing.mix(row_keyed(docs.limit(0))).count() == 0
    out = mixing.mixing_stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in out.collect()) == sum(r.taken for r in rows)
