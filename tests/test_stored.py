"""Tables that outlive a step: daily states, bucketed lists, datasets by day, vocabularies and fitted rankers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from nextclick.operators import candidates as C
from nextclick.operators import knn
from nextclick.operators import ranking as R
from nextclick.operators import vectors as V
from nextclick.operators.dictionary import running_total
from nextclick.plans import catalog
from nextclick.schemas import Split
from nextclick.sources import fixtures as fx
from nextclick.sources.parquet import load_bucketed, read_days, read_ranges, read_table, store_bucketed, write_by_day, write_dataset
from nextclick.sources.tables import materialise


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_state_of_any_split_of_the_days_is_the_state_of_all(spark, tmp_path):
    p = catalog.f1(spark, SF001)
    train, test = materialise(p.train, "train"), materialise(p.test, "test")
    want = {tuple(r) for r in C.continue_search(train, test).collect()}
    whole = C.continue_search_state(train)
    assert {tuple(r) for r in C.continue_search_from_state(whole, test).collect()} == want
    rng = random.Random(1)
    days = [r.day for r in train.select(F.to_date("action_dt").alias("day")).distinct().collect()]
    for parts in (2, 5):
        cut = {d: rng.randrange(parts) for d in days}
        states = [C.continue_search_state(train.where(F.to_date("action_dt").isin([d for d in days if cut[d] == i]))) for i in range(parts)]
        merged = states[0]
        for s in states[1:]:
            merged = C.merge_states(merged, s)  # one after another, as the days come
        assert {tuple(r) for r in C.continue_search_from_state(merged, test).collect()} == want
    assert {tuple(r) for r in merged.collect()} == {tuple(r) for r in whole.collect()}
    seen = C.continue_search(train, test, drop_seen_responses=True)
    assert {tuple(r) for r in C.continue_search_from_state(whole, test, drop_seen_responses=True).collect()} == {tuple(r) for r in seen.collect()}
    path = f"{tmp_path}/state"
    write_dataset(C.continue_search_state(train.withColumn("day", F.to_date("action_dt")), by=["day"]), path, ["day"])
    stored = read_table(spark, path)
    assert all("/train-" not in f for f in C.merge_states(stored).inputFiles())


def test_state_of_rows_without_user_or_time(spark):
    rows = [(None, 1, 1, "2024-01-01"), (1, 2, 2, None), (1, 2, 2, "2024-01-02"), (1, None, 3, "2024-01-03"), (1, 2, None, "2024-01-09")]
    df = spark.createDataFrame(rows, "user_id long, vacancy_id long, action_type int, action_dt string").withColumn("action_dt", F.col("action_dt").cast("timestamp_ntz"))
    test = df.where("user_id = 1").limit(3)
    a = {tuple(r) for r in C.continue_search(df, test).collect()}
    assert {tuple(r) for r in C.continue_search_from_state(C.continue_search_state(df), test).collect()} == a


def test_bucketed_list_is_joined_without_a_shuffle_of_it(spark, tmp_path):
    rng = random.Random(2)
    rows = [(a, rng.randrange(100), rng.random(), 1) for a in range(300) for _ in range(5)]
    i2i = spark.createDataFrame(rows, "anchor_vacancy_id long, recom_vacancy_id long, score double, pos int")
    table = store_bucketed(i2i, str(tmp_path), "i2i", Split.MICRO, buckets=4)
    stored = load_bucketed(spark, table)
    history = spark.createDataFrame([(u, rng.randrange(320)) for u in range(80) for _ in range(4)], "user_id long, vacancy_id long")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        anchors = history.select("user_id", F.col("vacancy_id").alias("anchor_vacancy_id"))
        plan = plan_of(anchors.join(stored, "anchor_vacancy_id"))
        side = plan[plan.index("SortMergeJoin"):]
        assert "Bucketed: true" in side and side.count("Exchange") == 1
        got = C.i2i_topk_candidates(history, stored, 3)
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in C.i2i_topk_candidates(history, i2i, 3).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_days_are_pruned_by_bounds_and_by_a_table_of_ranges(spark, tmp_path):
    sessions = catalog.f1_sessions(spark, SF001)
    path = f"{tmp_path}/sessions"
    write_by_day(sessions, path)
    train = read_days(spark, path, "2024-01-05", "2024-01-07")
    plan = plan_of(train)
    filters = plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]
    assert "day" in filters and ">=" in filters and "<=" in filters and train.columns == sessions.columns
    want = sessions.where("session_dt >= '2024-01-05' and session_dt < '2024-01-07'")
    assert train.count() == want.count() > 0
    assert len(list((tmp_path / "sessions").glob("day=*"))) == sessions.select(F.to_date("session_dt")).distinct().count()
    ranges = spark.createDataFrame([("a", "2024-01-05", "2024-01-07"), ("b", "2024-01-06 12:00:00", "2024-01-06 18:00:00"), ("c", "2024-01-09", "2024-01-09")],
                                   "split string, start string, end string")
    ranges = ranges.select("split", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("start", "end")))
    got = read_ranges(spark, path, ranges.where("split != 'z'"))
    assert "dynamicpruning" in plan_of(got)
    noon = sessions.where("session_dt >= '2024-01-06 12:00:00' and session_dt < '2024-01-06 18:00:00'")
    assert {r.split: r["count"] for r in got.groupBy("split").count().collect()} == {"a": want.count(), "b": noon.count()}


def test_queries_against_an_index_with_unknown_words(spark):
    index = spark.createDataFrame([(5, "red green"), (3, "red green"), (9, "blue blue sky"), (7, "sky"), (8, "!")], "key long, text string")
    asked = spark.createDataFrame([(1, "Red unheard"), (2, "nothing known"), (3, ""), (4, None), (5, "sky blue zzz")], "key long, text string")
    counts = V.text_token_counts(index, "key", "text").drop("token")
    vocabulary = V.fit_vocabulary(counts)
    assert {r.word for r in vocabulary.collect()} == {"red", "green", "blue", "sky"}
    queries = V.known_words(V.text_token_counts(asked, "key", "text").drop("token"), vocabulary)
    rows = knn.sparse_query(queries, V.known_words(counts, vocabulary), 3, keys=asked.select("key")).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r.pos):
        got.setdefault(r.anchor_vacancy_id, []).append((r.recom_vacancy_id, round(r.score, 6)))
    half = round(1 / np.sqrt(2), 6)
    assert got[1] == [(3, half), (5, half), (7, 0.0)]
    assert got[2] == got[3] == got[4] == [(3, 0.0), (5, 0.0), (7, 0.0)]
    assert got[5] == [(9, round(3 / np.sqrt(10), 6)), (7, half), (3, 0.0)]


@pytest.mark.parametrize("sizes", [(64, 64), (1000, 1000)])
def test_sparse_topk_of_two_tables_against_numpy(spark, sizes):
    rng = np.random.default_rng(3)
    a, b = ((rng.random((n, 40)) < 0.15) * rng.random((n, 40)).round(3) for n in (150, 330))
    flat = lambda m: spark.createDataFrame([(int(i), int(j), float(m[i, j])) for i, j in zip(*np.nonzero(m), strict=True)], "key long, token long, val double")
    counted = [spark.sparkContext.accumulator(0) for _ in range(3)]
    got = {(r.anchor_vacancy_id, r.recom_vacancy_id, r.pos) for r in knn.sparse_topk(flat(a), 7, flat(b), *sizes, counted=counted).collect()}
    S = np.round(a @ b.T, knn.SCORE_DIGITS)
    want = {(i, int(j), p) for i in range(150) for p, j in enumerate(np.argsort(-S[i], kind="stable")[:7], 1) if S[i, j] > 0}
    assert got == want and 0 < counted[2].value <= ((a > 0).sum(axis=0) * (b > 0).sum(axis=0)).sum()


def test_bounds_leave_anchors_out_of_blocks_of_light_candidates():
    rng = np.random.default_rng(4)
    tokens, keys = np.tile(np.arange(6), 20), np.repeat(np.arange(20), 6)
    best = knn._SparseBest(keys, tokens, rng.random(120) + 0.1, 3, 9)
    assert best.take(keys, tokens, np.ones(120), False)[0] == 0
    before = best.scores.copy()
    assert best.take(keys + 100, tokens, np.full(120, 0.01), False) == (20, 20, 0) and (best.scores == before).all()


def test_ranker_learns_is_stored_and_scores_the_same_after_reload(spark, tmp_path):
    rng = random.Random(5)
    rows, truth = [], []
    for u in range(400):
        target = rng.randrange(30)
        truth.append((u, target))
        for v in range(30):
            good = v == target
            rows.append((u, v, rng.gauss(1.5 if good else 0, 1), rng.gauss(0, 1) if v % 3 else None))
    cands = spark.createDataFrame(rows, "user_id long, vacancy_id long, f double, g double")
    table = R.training_table(cands, spark.createDataFrame(truth, "user_id long, target long"), negatives=4)
    assert [tuple(r) for r in table.orderBy("user_id", "vacancy_id").collect()] == [tuple(r) for r in R.training_table(
        cands.repartition(7), spark.createDataFrame(truth, "user_id long, target long"), negatives=4).orderBy("user_id", "vacancy_id").collect()]
    assert {(r.label, r["count"]) for r in table.groupBy("label").count().collect()} == {(1, 400), (0, 1600)}
    path = R.fit_ranker(table.where("user_id % 2 = 0"), ["f", "g"], f"{tmp_path}/ranker", max_iter=10)
    held = cands.where("user_id % 2 = 1")
    first = {(r.user_id, r.vacancy_id): r.model_score for r in R.trained_ranker(held, path, ["f", "g"]).collect()}
    again = {(r.user_id, r.vacancy_id): r.model_score for r in R.trained_ranker(held.repartition(5), path, ["f", "g"]).collect()}
    assert first == again and len(first) == 200 * 30
    good = np.array([first[u, t] for u, t in truth if u % 2])
    rest = np.array([s for (u, v), s in first.items() if v != truth[u][1]])
    auc = (good[:, None] > rest).mean() + 0.5 * (good[:, None] == rest).mean()
    assert auc >= 0.8


def test_running_total_over_many_partitions(spark):
    df = spark.createDataFrame([(float(i), i % 5 + 1) for i in random.Random(0).sample(range(500), 500)], "v double, f long")
    got = [r.hi for r in running_total(df, "v", "f", "hi").orderBy("v").collect()]
    assert got == np.cumsum([i % 5 + 1 for i in range(500)]).tolist()
