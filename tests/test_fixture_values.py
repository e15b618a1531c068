"""Expected values of FIXTURES.md (F1, F2) at sf0.001 and sf0.01."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from nextclick.operators import candidates as C
from nextclick.operators import ranking as R
from nextclick.operators.truth import leave_last_out
from nextclick.plans import flows
from nextclick.sources import fixtures as fx

F1 = {
    SF001: dict(inter=600, users=15, sessions=326, items=99, train=(307, 168), val=158, truth=8, llo=65,
                cands=171, kept=114, mrr=0.011364, recall=0.125000),
    SF01: dict(inter=5969, users=150, sessions=3282, items=100, train=(2969, 1621), val=1661, truth=67,
               llo=563, cands=1344, kept=928, mrr=0.027978, recall=0.149254),
}
F2 = {
    SF001: dict(inter=6000, users=150, sessions=1473, items=200, train=(5425, 1235), val=238, truth=41,
                llo=458, cands=1538, kept=1053, mrr=0.005900, recall=0.073171),
}


def _check(spark, raw, flat, exp, train_r, val_r):
    assert flat.count() == exp["inter"]
    assert flat.select("user_id").distinct().count() == exp["users"]
    assert flat.select("vacancy_id").distinct().count() == exp["items"]
    assert raw.count() == exp["sessions"]
    p = flows.prepare(raw, train_r, val_r)
    assert (p.train.count(), p.train_sessions.count()) == exp["train"]
    assert p.validation_sessions.count() == exp["val"]
    assert p.truth.count() == exp["truth"]
    assert leave_last_out(p.train_sessions.unionByName(p.validation_sessions)).count() <= exp["llo"]
    cs = C.continue_search(p.train, p.test)
    assert cs.count() == exp["cands"]
    assert R.seen_filter(cs, p.train).count() == exp["kept"]
    assert C.continue_search(p.train, p.test, drop_seen_responses=True).count() == exp["kept"]
    m = flows.evaluate(p, flows.continue_search_submission(p, 100), 100).first()
    assert m.mrr == pytest.approx(exp["mrr"], abs=5e-7)
    assert m.recall == pytest.approx(exp["recall"], abs=5e-7)


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_f1_expected(spark, sf):
    from nextclick.operators.sessions import normalise_sessions
    raw = fx.events_session_log(spark, sf)
    _check(spark, raw, fx.events_interactions(spark, sf), F1[sf], fx.F1_TRAIN, fx.F1_VALIDATION)
    assert leave_last_out(normalise_sessions(raw)).count() == F1[sf]["llo"]


def test_f2_expected(spark):
    raw = fx.orders_session_log(spark, SF001)
    _check(spark, raw, fx.orders_interactions(spark, SF001), F2[SF001], fx.F2_TRAIN, fx.F2_VALIDATION)


def test_f2_tie_counts(spark):
    """Without the position offset, times tie inside sessions (FIXTURES F2)."""
    flat = fx.orders_interactions(spark, SF001, tie_times=True)
    ties = flat.groupBy("session_id", "action_dt").count().where(F.col("count") > 1).count()
    assert ties == 6


def test_truth_against_windows_with_ties(spark):
    """The aggregation plan gives what average ranks by a window over each user give."""
    from pyspark.sql import Window as W

    from nextclick.functions.arrays import first_match_struct
    from nextclick.functions.ranks import average_rank
    p = flows.prepare(fx.orders_session_log(spark, SF001, tie_times=True), fx.F2_TRAIN, fx.F2_VALIDATION)
    ranked = p.validation_sessions.withColumn("r", average_rank("user_id", "session_dt"))
    resp = first_match_struct("action_dt", "vacancy_id", "action_type", 1)
    cand = F.when(resp.isNotNull() & (F.col("r") > 1), F.struct(resp["dt"].alias("dt"), resp["item"].alias("item"), F.col("session_id").alias("sid"),
                                                                F.col("r").alias("r"), F.col("session_dt").alias("sdt")))
    paired = ranked.withColumn("t", F.min(cand).over(W.partitionBy("user_id")))
    want = paired.where((F.col("r") == F.col("t.r") - 1) & F.size("vacancy_id").between(2, 29)).select(
        "user_id", "session_id", F.col("r").alias("val_session_rank"), F.col("t.item").alias("target"), F.col("t.sdt").alias("target_dt"))
    assert want.count() > 0 and sorted(want.collect()) == sorted(p.truth.select(want.columns).collect())


def test_dense_rank_within_hot_key(spark):
    from pyspark.sql import Window as W
    from nextclick.operators.dictionary import dense_rank_within
    # key 0 holds most rows; ties in the order column repeat
    df = spark.range(5000).select((F.when(F.col("id") % 10 < 8, 0).otherwise(F.col("id") % 7)).alias("k"),
                                  (F.col("id") % 613).alias("o"))
    want = df.withColumn("r", F.dense_rank().over(W.partitionBy("k").orderBy(F.col("o").desc())))
    got = dense_rank_within(df, "k", "o", descending=True, out="r")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_round_robin_against_windows(spark):
    from pyspark.sql import Window as W

    from nextclick.plans import catalog
    p = catalog.f1(spark, SF001, hot=True)
    i2i = catalog.f1_i2i(spark, SF001, p)
    got = C.round_robin(p.test, i2i)
    latest = p.test.groupBy("user_id", "vacancy_id").agg(F.max("action_dt").alias("dt"))
    lists = latest.withColumn("l", F.row_number().over(W.partitionBy("user_id").orderBy(F.col("dt").desc(), "vacancy_id")))
    first = (lists.withColumnRenamed("vacancy_id", "anchor_vacancy_id").join(i2i, "anchor_vacancy_id")
                  .groupBy("user_id", F.col("recom_vacancy_id").alias("vacancy_id")).agg(F.min(F.struct("pos", "l")).alias("f")))
    want = first.select("user_id", "vacancy_id", F.row_number().over(W.partitionBy("user_id").orderBy("f")).alias("pos"))
    assert want.count() > 0
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
