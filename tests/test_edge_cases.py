"""Literal edge cases (F0 pipeline rows, F3 cases)."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from nextclick.functions.ids import parse_id
from nextclick.functions.weights import CONTINUE_SEARCH_WEIGHTS, map_weight
from nextclick.operators import candidates as C
from nextclick.operators import ranking as R
from nextclick.operators.metrics import mrr_recall
from nextclick.operators.sessions import DEFAULT_CODEC, interactions, normalise_sessions
from nextclick.operators.truth import leave_last_out, next_response_truth, time_split
from nextclick.schemas import SESSION_SCHEMA

T0 = dt.datetime(2024, 1, 1)


def t(sec):
    return T0 + dt.timedelta(seconds=sec)


def sessions(spark, rows):
    return spark.createDataFrame(rows, SESSION_SCHEMA)


def test_normalise_sorts_stably_and_sets_session_dt(spark):
    df = sessions(spark, [(1, "s", [5, 6, 7, 8], [2, 1, 3, 2], [t(30), t(10), t(10), t(20)])])
    r = normalise_sessions(df).first()
    assert r.vacancy_id == [6, 7, 8, 5]          # tie at t(10) keeps original order 6 then 7
    assert r.action_type == [1, 3, 2, 2]
    assert r.session_dt == t(10)


def test_empty_session_gives_null_session_dt_and_one_null_row(spark):
    df = sessions(spark, [(1, "s", [], [], [])])
    assert normalise_sessions(df).first().session_dt is None
    rows = interactions(df).collect()
    assert len(rows) == 1 and rows[0].vacancy_id is None


def test_unequal_arrays_raise(spark):
    df = sessions(spark, [(1, "s", [1, 2], [1], [t(1), t(2)])])
    with pytest.raises(PySparkException):
        interactions(df).collect()
    with pytest.raises(PySparkException):
        normalise_sessions(df).collect()


def test_unknown_action_code_strict_and_lenient(spark):
    df = spark.createDataFrame([(1,), (9,)], "a int")
    lenient = df.select(map_weight(F.col("a"), CONTINUE_SEARCH_WEIGHTS, strict=False).alias("w")).collect()
    assert [r.w for r in lenient] == [-5.0, None]
    with pytest.raises(PySparkException):
        df.select(map_weight(F.col("a"), CONTINUE_SEARCH_WEIGHTS, strict=True)).collect()


def test_id_parse_lenient_and_strict(spark):
    df = spark.createDataFrame([("u_007x",), ("u_12",)], "s string")
    assert [r.v for r in df.select(parse_id(F.col("s"), "u_", strict=False).alias("v")).collect()] == [None, 12]
    with pytest.raises(PySparkException):
        df.select(parse_id(F.col("s"), "u_", strict=True)).collect()


def test_id_codec_round_trip(spark):
    df = spark.createDataFrame([("u_3", ["v_1", "v_20"])], "user_id string, vacancy_id array<string>")
    enc = DEFAULT_CODEC.encode(df)
    assert enc.first().user_id == 3 and enc.first().vacancy_id == [1, 20]
    dec = DEFAULT_CODEC.decode(enc).first()
    assert dec.user_id == "u_3" and dec.vacancy_id == ["v_1", "v_20"]


def _val(spark, rows):
    return normalise_sessions(sessions(spark, rows))


def test_average_rank_ties_and_no_pair_across_tie(spark):
    # sessions at 10, 10, 20: average ranks 1.5, 1.5, 3.0
    rows = [(1, "a", [1, 2], [2, 2], [t(10), t(11)]),
            (1, "b", [3, 4], [2, 2], [t(10), t(12)]),
            (1, "c", [5, 6], [1, 2], [t(20), t(21)])]
    from nextclick.functions.ranks import average_rank
    ranks = sorted(r.r for r in _val(spark, rows).select(average_rank("user_id", "session_dt").alias("r")).collect())
    assert ranks == [1.5, 1.5, 3.0]
    # target session has rank 3, rank 2 does not exist -> no pair
    assert next_response_truth(_val(spark, rows)).count() == 0


def test_truth_length_bounds(spark):
    def user(uid, n):
        hist = (uid, f"h{uid}", list(range(n)), [2] * n, [t(i) for i in range(n)])
        tgt = (uid, f"t{uid}", [100, 101], [2, 1], [t(1000), t(1001)])
        return [hist, tgt]
    rows = user(1, 1) + user(2, 2) + user(3, 29) + user(4, 30)
    got = {r.user_id: r.target for r in next_response_truth(_val(spark, rows)).collect()}
    assert got == {2: 101, 3: 101}


def test_truth_earliest_response_then_smallest_item(spark):
    rows = [(1, "a", [1, 2], [2, 2], [t(0), t(1)]),
            (1, "b", [9, 7, 8], [1, 1, 1], [t(10), t(10), t(5)])]
    r = next_response_truth(_val(spark, rows)).first()
    assert r.target == 8 and r.target_dt == t(5)


def test_leave_last_out(spark):
    rows = [(1, "a", [1, 2, 3], [2, 2, 1], [t(0), t(1), t(2)]),
            (1, "b", [4], [1], [t(3)]),
            (1, "c", [5, 6], [1, 2], [t(4), t(5)])]
    out = leave_last_out(_val(spark, rows)).collect()
    assert len(out) == 1 and out[0].next_item == 3 and out[0].vacancy_id == [1, 2]


def test_time_split_rejects_overlap(spark):
    df = _val(spark, [(1, "a", [1], [1], [t(0)])])
    with pytest.raises(ValueError):
        time_split(df, ("2024-01-01", "2024-01-15"), ("2024-01-08", "2024-01-20"))


def test_metrics_edge_cases(spark):
    truth = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 40), (5, 50)], "user_id long, target long")
    preds = spark.createDataFrame(
        [(2, None), (3, [1, 30, 30]), (4, [1, 2, 3, 40])], "user_id long, predictions array<long>")
    # user 1 has no prediction, user 2 a null list, user 3 a duplicate (first
    # position counts), user 4 a target after k=3, user 5 none
    r = mrr_recall(truth, preds, k=3).first()
    assert r.n_queries == 5
    assert r.mrr == pytest.approx((1 / 2) / 5)
    assert r.recall == pytest.approx(1 / 5)


def test_metrics_duplicate_prediction_rows_raise(spark):
    truth = spark.createDataFrame([(1, 10)], "user_id long, target long")
    preds = spark.createDataFrame([(1, [10]), (1, [11])], "user_id long, predictions array<long>")
    with pytest.raises(PySparkException):
        mrr_recall(truth, preds).collect()


def test_submission_keeps_users_missing_from_skeleton(spark):
    skel = spark.createDataFrame([(1, "s1"), (2, "s2")], "user_id long, session_id string")
    recs = spark.createDataFrame([(1, [5]), (9, [7])], "user_id long, predictions array<long>")
    got = {r.user_id: (r.session_id, r.predictions) for r in R.submission(skel, recs).collect()}
    assert got == {1: ("s1", [5]), 2: ("s2", []), 9: (None, [7])}


def test_f0_pipeline_rows(spark):
    """The source's own three-user example, worked by hand (FIXTURES F0)."""
    hist = spark.createDataFrame(
        [(1, "1", [1, 2], [1, 2], [t(1), t(2)]),
         (2, "2", [1, 2], [2, 1], [t(1), t(2)]),
         (3, "3", [1, 2, 3, 4], [1, 2, 2, 1], [t(1)] * 4)], SESSION_SCHEMA)
    flat = interactions(hist, keep=["user_id", "session_id"])
    i2i = spark.createDataFrame([(1, 2, 4.0), (2, 4, 2.0), (3, 5, 3.0), (4, 2, 1.0)],
                                "anchor_vacancy_id long, recom_vacancy_id long, score double")
    r13 = {(r.user_id, r.vacancy_id, r.score) for r in C.i2i_candidates(flat, i2i).collect()}
    assert r13 == {(1, 2, 4.0), (1, 4, 2.0), (2, 2, 4.0), (2, 4, 2.0), (3, 2, 4.0), (3, 4, 2.0), (3, 5, 3.0)}
    const = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (4, 4.0)], "vacancy_id long, score double")
    r26 = C.constant_candidates(flat, const)
    assert r26.count() == 12
    joined = C.join_candidates({"als": r26, "knn_text": C.i2i_candidates(flat, i2i)})
    rows = joined.collect()
    assert len(rows) == 13
    assert [(r.als_score, r.knn_text_score) for r in rows if (r.user_id, r.vacancy_id) == (3, 5)] == [(None, 3.0)]
    outer = C.join_candidates({"als": r26, "knn_text": C.i2i_candidates(flat, i2i)}, how="outer")
    assert sorted(map(tuple, outer.collect())) == sorted(map(tuple, rows))
    kept = R.seen_filter(joined, flat)
    got = {}
    for r in kept.collect():
        got.setdefault(r.user_id, set()).add(r.vacancy_id)
    assert got == {1: {2, 3, 4}, 2: {1, 3, 4}, 3: {2, 3, 5}}


def test_join_candidates_needs_a_generator():
    with pytest.raises(ValueError):
        C.join_candidates({})


def test_constant_list_of_any_length(spark):
    users = spark.createDataFrame([(1,), (2,), (2,)], "user_id long")
    items = spark.range(2500).select(F.col("id").alias("vacancy_id"), F.lit(1.0).alias("score"))
    out = C.constant_candidates(users, items)
    assert out.count() == 5000 and out.distinct().count() == 5000


def test_truth_repeated_session_ids_null_users_and_empty_sessions(spark):
    rows = [(1, "a", [1, 2], [2, 2], [t(0), t(1)]), (1, "a", [3, 4], [1, 2], [t(10), t(11)]),
            (None, "b", [1, 2], [2, 2], [t(0), t(1)]), (None, "c", [3, 4], [1, 2], [t(10), t(11)]),
            (5, "d", [], [], []), (5, "e", [1, 2], [2, 2], [t(0), t(1)]), (5, "f", [7, 4], [1, 2], [t(10), t(11)])]
    got = sorted((r.user_id, r.session_id, r.target, r.val_session_rank) for r in next_response_truth(_val(spark, rows)).collect())
    assert got == [(1, "a", 3, 1.0), (5, "e", 7, 1.0)]


def test_recency_ranks_leave_null_users_out(spark):
    flat = spark.createDataFrame([(1, 5, 2, t(0)), (1, 6, 2, t(1)), (None, 7, 2, t(2))], "user_id long, vacancy_id long, action_type int, action_dt timestamp_ntz")
    got = {(r.user_id, r.vacancy_id): r.score for r in C.continue_search(flat, flat).collect()}
    assert set(got) == {(1, 5), (1, 6)} and got[(1, 6)] == 0.0


def test_item_frequency_of_empty_sessions(spark):
    from nextclick.operators import eda
    df = sessions(spark, [(1, "s", [], [], []), (1, "r", [4, 4, None], [1, 1, 1], [t(0), t(1), t(2)])])
    assert [tuple(r) for r in eda.item_frequency(df).collect()] == [(4, 2)]


def test_describe_against_pandas(spark):
    import pandas as pd
    from nextclick.operators import eda
    for values in ([3, 1, 1, 8, 9, 2, 2, 2], [5], [1, 2]):
        got = eda.describe(spark.createDataFrame([(v,) for v in values] + [(None,)], "x long"), "x").first()
        want = pd.Series(values).describe()
        assert got["count"] == len(values) and got["mean"] == pytest.approx(want["mean"]) and got["max"] == want["max"]
        assert [got.q25, got.q50, got.q75] == pytest.approx([want["25%"], want["50%"], want["75%"]])
        assert got["std"] == (pytest.approx(want["std"]) if len(values) > 1 else None)
    assert eda.describe(spark.createDataFrame([], "x long"), "x").first()["count"] == 0


def test_target_position_counts_what_comes_before(spark):
    from nextclick.operators.metrics import mrr_unbounded, target_position
    cands = spark.createDataFrame([(1, 10, 0.0), (1, 11, 0.5), (1, 12, 0.5), (2, 10, 1.0)], "user_id long, vacancy_id long, score double")
    truth = spark.createDataFrame([(1, 12), (1, 99), (2, 10), (3, 1)], "user_id long, next_item long")
    pos = target_position(truth, cands, "score")
    assert sorted(map(tuple, pos.collect())) == [(1, 12, 3), (2, 10, 1)]
    r = mrr_unbounded(truth, pos).first()
    assert r.n_queries == 4 and r.mrr == pytest.approx((1 / 3 + 1) / 4)


def test_reversible_rename(spark):
    from nextclick.operators.sessions import rename_back, rename_reversible
    df = spark.createDataFrame([(1, 2, 3)], "user_id_int long, user_id long, x long")
    m = {"user_id_int": "user_id"}
    fwd = rename_reversible(df, m)
    assert fwd.columns == ["user_id", "x"] and fwd.first().user_id == 1
    back = rename_back(fwd, m)
    assert back.columns == ["user_id_int", "x"]
