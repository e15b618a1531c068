"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the whole driver tables.

Outputs are comparison-friendly: lists and times are rendered as strings,
doubles rounded (see ``render``), every computed column aliased; the SQL
oracle (``oracle``) renders the same way.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nextclick.operators import ann, eda, knn
from nextclick.operators import candidates as C
from nextclick.operators import ranking as R
from nextclick.operators import vectors as V
from nextclick.operators.als import user_item_matrix
from nextclick.operators.dictionary import fit_dictionary
from nextclick.operators.metrics import mrr_recall, mrr_unbounded, score_submission, target_position
from nextclick.operators.sessions import DEFAULT_CODEC, interactions, normalise_sessions, rename_back, rename_reversible
from nextclick.operators.truth import leave_last_out, time_split
from nextclick.plans import flows
from nextclick.plans.render import list_str, num, time_list_str, time_str
from nextclick.schemas import SUBMISSION_SCHEMA, Split
from nextclick.sources import fixtures as fx
from nextclick.sources.parquet import (dataset_path, load_bucketed, load_frame, read_days, read_ranges, read_table, read_test, read_train,
                                       read_vacancies, store_bucketed, store_frame, write_by_day, write_dataset, write_submission)
from nextclick.sources.tables import materialise, tables_dir

Query = Callable[[SparkSession, str], DataFrame]


# ----------------------------------------------------------------- inputs
def f1_sessions(spark, d):
    return normalise_sessions(fx.events_session_log(spark, d))


def f1(spark, d, hot: bool = False) -> flows.Prepared:
    return flows.prepare(fx.events_session_log(spark, d, hot), fx.F1_TRAIN, fx.F1_VALIDATION)


def f2(spark, d, tie_times: bool = False) -> flows.Prepared:
    return flows.prepare(fx.orders_session_log(spark, d, tie_times), fx.F2_TRAIN, fx.F2_VALIDATION)


def session_view(s: DataFrame) -> DataFrame:
    return s.select("user_id", "session_id", time_str("session_dt").alias("session_dt"),
                    F.size("vacancy_id").cast("bigint").alias("n_actions"), list_str("vacancy_id").alias("items"),
                    list_str("action_type").alias("actions"), time_list_str("action_dt").alias("times"))


def truth_view(t: DataFrame) -> DataFrame:
    return t.select("user_id", "session_id", num("val_session_rank", 1).alias("val_session_rank"),
                    "target", time_str("target_dt").alias("target_dt"),
                    time_str("session_dt").alias("session_dt"), list_str("vacancy_id").alias("items"))


# ----------------------------------------------------------------- R1, R37, R30, R2
def session_normalise_events(spark, d):
    return session_view(f1_sessions(spark, d))


def session_normalise_orders_ties(spark, d):
    return session_view(normalise_sessions(fx.orders_session_log(spark, d, tie_times=True)))


def interactions_events(spark, d):
    flat = interactions(f1_sessions(spark, d), keep=["user_id", "session_id"])
    return flat.select("user_id", "session_id", F.col("pos").cast("bigint").alias("pos"), "vacancy_id", "action_type",
                       time_str("action_dt").alias("action_dt"))


def id_codec_events(spark, d):
    s = f1_sessions(spark, d).select("user_id", "session_id", "vacancy_id")
    text = DEFAULT_CODEC.decode(s)
    back = DEFAULT_CODEC.encode(text.select(F.col("user_id").alias("user_key"), "session_id",
                                            F.col("vacancy_id").alias("item_keys"),
                                            F.col("user_id"), F.col("vacancy_id")))
    return back.select("user_key", "session_id", F.array_join("item_keys", ",").alias("item_keys"),
                       "user_id", list_str("vacancy_id").alias("items"))


def time_split_events(spark, d):
    sessions = materialise(f1_sessions(spark, d), "sessions", sort_within=["session_dt"])
    train, val = time_split(sessions, fx.F1_TRAIN, fx.F1_VALIDATION)
    pick = ["user_id", "session_id", time_str("session_dt").alias("session_dt")]
    return (train.select(*pick, F.lit("train").alias("split"))
                 .unionByName(val.select(*pick, F.lit("validation").alias("split"))))


# ----------------------------------------------------------------- R3, R3b
def truth_events(spark, d):
    return truth_view(f1(spark, d).truth)


def truth_hot_user_events(spark, d):
    """R3 where one user has a third of all sessions."""
    return truth_view(f1(spark, d, hot=True).truth)


def truth_orders(spark, d):
    return truth_view(f2(spark, d).truth)


def truth_orders_ties(spark, d):
    return truth_view(f2(spark, d, tie_times=True).truth)


def leave_last_out_events(spark, d):
    llo = leave_last_out(f1_sessions(spark, d))
    return llo.select("user_id", "session_id", "next_item", list_str("vacancy_id").alias("items"),
                      list_str("action_type").alias("actions"), F.size("action_dt").cast("bigint").alias("n_times"))


# ----------------------------------------------------------------- R25, R21, R22, R23, R27-R29
def continue_search_events(spark, d):
    p = f1(spark, d)
    return C.continue_search(p.train, p.test).select(
        "user_id", "vacancy_id", num("score").alias("score"))


def continue_search_hot_user_events(spark, d):
    """R25 where one user has a third of all sessions."""
    p = f1(spark, d, hot=True)
    return C.continue_search(p.train, p.test).select("user_id", "vacancy_id", num("score").alias("score"))


def seen_filter_counts_events(spark, d):
    """Candidate rows before and after the seen filter, observed while the job that writes them runs."""
    p = f1(spark, d)
    seen = Observation("before"), Observation("after")
    materialise(R.seen_filter(C.continue_search(p.train, p.test), p.train, observations=seen), "seen_filter")
    return spark.createDataFrame([(at, o.get["rows"]) for at, o in zip(("before", "after"), seen, strict=True)], "at string, n_rows long")


def continue_search_state_events(spark, d):
    """D14 + A6: the train rows reduced per day, stored in a folder per day, and merged at predict, which reads no train row."""
    p, base = f1(spark, d), os.path.join(_run_folder(spark), "state")
    daily = C.continue_search_state(p.train.withColumn("day", F.to_date("action_dt")), by=["day"])
    write_dataset(daily, base, partition_by=["day"])
    return C.continue_search_from_state(read_table(spark, base), p.test).select("user_id", "vacancy_id", num("score").alias("score"))


def time_split_by_day_events(spark, d):
    """Sessions stored by day; train read with fixed bounds, validation by a table of ranges."""
    path = os.path.join(_run_folder(spark), "sessions")
    write_by_day(f1_sessions(spark, d), path)
    ranges = spark.createDataFrame([("validation", *fx.F1_VALIDATION), ("none", fx.F1_TRAIN[0], fx.F1_TRAIN[0])], "split string, start string, end string")
    ranges = ranges.select("split", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("start", "end")))
    pick = ["user_id", "session_id", time_str("session_dt").alias("session_dt")]
    train = read_days(spark, path, *fx.F1_TRAIN).select(*pick, F.lit("train").alias("split"))
    return train.unionByName(read_ranges(spark, path, ranges).select(*pick, "split"))


def seen_filter_events(spark, d):
    p = f1(spark, d)
    kept = R.seen_filter(C.continue_search(p.train, p.test), p.train)
    return kept.select("user_id", "vacancy_id", num("score").alias("score"))


def pack_events(spark, d):
    packed = R.pack(flows.continue_search_recs(f1(spark, d), 100))
    return packed.select("user_id", list_str("predictions").alias("predictions"),
                         F.size("predictions").cast("bigint").alias("n_predictions"))


def submission_events(spark, d):
    sub = flows.continue_search_submission(f1(spark, d), 100)
    return sub.select("user_id", "session_id", list_str("predictions").alias("predictions"))


def _metrics_view(m: DataFrame) -> DataFrame:
    return m.select(num("mrr").alias("mrr"), num("recall").alias("recall"), "n_queries")


def mrr_recall_events(spark, d):
    p = f1(spark, d)
    return _metrics_view(flows.evaluate(p, flows.continue_search_submission(p, 100), 100))


def mrr_recall_orders(spark, d):
    p = f2(spark, d)
    return _metrics_view(flows.evaluate(p, flows.continue_search_submission(p, 100), 100))


def _run_folder(spark) -> str:
    return os.path.join(tables_dir(spark), f"run-{uuid.uuid4().hex}")


def _score_written(spark, d, row_limit: int) -> DataFrame:
    """R36 end to end: write the continue-search submission with the
    submission sink (A4/A8) under the checkpoint folder, scan it back (A1)
    with the submission schema, and score it (MRR@100, Recall@100)."""
    p = f1(spark, d)
    path = write_submission(flows.continue_search_submission(p, 100), _run_folder(spark), "continue_search", Split.MICRO)
    return _metrics_view(score_submission(p.truth, read_table(spark, path, SUBMISSION_SCHEMA), k=100, row_limit=row_limit))


def submission_scoring_events(spark, d):
    return _score_written(spark, d, -1)


def submission_scoring_limit_events(spark, d):
    """The first 30 truth rows only (the limit is the feature)."""
    return _score_written(spark, d, 30)


def dataset_round_trip_events(spark, d):
    """The prepared datasets, the vacancy table with the
    source's dotted names and the i2i list are written, read back by split,
    and give R13b's candidates; columns are renamed there and back on the way."""
    p, base = f1(spark, d), _run_folder(spark)
    write_dataset(p.train, dataset_path(base, Split.VALIDATION, "train"))
    write_dataset(p.test, dataset_path(base, Split.VALIDATION, "test"))
    write_dataset(fx.vacancies(spark, d).withColumnsRenamed({"area_id": "area.id", "region_id": "area.regionId"}), os.path.join(base, "vacancies.parquet"))
    train, test = read_train(spark, base, Split.VALIDATION), read_test(spark, base, Split.VALIDATION)
    counts = V.item_token_counts(train, read_vacancies(spark, os.path.join(base, "vacancies.parquet")), dense_tokens=False)
    store_frame(knn.sparse_i2i(counts, asked=100), base, "i2i", Split.VALIDATION)
    names = {"user_id": "user_key", "vacancy_id": "item_key"}
    history = rename_back(rename_reversible(test, names), names)
    out = C.i2i_topk_candidates(history, load_frame(spark, base, "i2i", Split.VALIDATION), 20)
    return out.select("user_id", "vacancy_id", num("score", 9).alias("score"))


def mrr_unbounded_events(spark, d):
    """Leave-last-out truth over the validation sessions; predictions
    = continue-search over train + the cut sessions, seen filter, no cut."""
    sessions = materialise(f1_sessions(spark, d), "sessions", sort_within=["session_dt"])
    train_s, val_s = time_split(sessions, fx.F1_TRAIN, fx.F1_VALIDATION)
    llo = leave_last_out(val_s).withColumn("action_dt", F.slice("action_dt", 1, F.size("vacancy_id")))
    train = interactions(train_s, keep=["user_id", "session_id"])
    test = interactions(llo, keep=["user_id", "session_id"])
    cands = materialise(C.continue_search(train, test, drop_seen_responses=True), "unbounded")
    return mrr_unbounded(llo, target_position(llo, cands, "score")).select(num("mrr").alias("mrr"), "n_queries")


# ----------------------------------------------------------------- R32-R35
def eda_sessions_per_day(spark, d):
    out = eda.sessions_per_day(f1_sessions(spark, d))
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n_sessions")


def eda_sessions_per_day_sample(spark, d):
    """The same over a tenth of the sessions."""
    out = eda.sessions_per_day(f1_sessions(spark, d), fraction=0.1)
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n_sessions")


def _summary(df: DataFrame, col: str) -> DataFrame:
    s = eda.describe(df, col)
    return s.select("count", *[num(c).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


def eda_sessions_per_user(spark, d):
    return eda.sessions_per_user(f1_sessions(spark, d))


def eda_sessions_per_user_summary(spark, d):
    return _summary(eda.sessions_per_user(f1_sessions(spark, d)), "n_sessions")


def eda_item_frequency(spark, d):
    return eda.item_frequency(fx.orders_session_log(spark, d))


def eda_item_frequency_summary(spark, d):
    return _summary(eda.item_frequency(fx.orders_session_log(spark, d)), "n_interactions")


def eda_items_per_user(spark, d):
    return eda.items_per_user(fx.orders_session_log(spark, d))


def eda_items_per_user_summary(spark, d):
    return _summary(eda.items_per_user(fx.orders_session_log(spark, d)), "n_items")


# ----------------------------------------------------------------- R26, R15/R6, H14
def popular_candidates_events(spark, d):
    p = f1(spark, d)
    top = C.popular_items(p.train, 100)
    return C.constant_candidates(p.test, top).select("user_id", "vacancy_id", num("score").alias("score"))


def item_tokens_events(spark, d):
    p = f1(spark, d)
    return V.item_token_counts(p.train, fx.vacancies(spark, d))


def item_tokens_geo_events(spark, d):
    """Tokens of user, area and region."""
    return V.item_token_counts(f1(spark, d).train, fx.vacancies(spark, d), token="geo")


def user_item_matrix_events(spark, d):
    """Summed action weights per user and item."""
    return user_item_matrix(f1(spark, d).train).select("user_id", "vacancy_id", num("weight").alias("weight"))


def dictionary_items_orders(spark, d):
    items = fx.table(spark, d, "lineitem").select(F.col("l_partkey").alias("vacancy_id"))
    return fit_dictionary(items, "vacancy_id", "idx")


# ----------------------------------------------------------------- R5, R13, R13b, R11, R12, R24
def _i2i_view(i2i: DataFrame) -> DataFrame:
    return i2i.select("anchor_vacancy_id", "recom_vacancy_id", num("score", 9).alias("score"),
                      F.col("pos").cast("bigint").alias("pos"))


def f1_i2i(spark, d, p=None):
    p = p or f1(spark, d)
    return knn.sparse_i2i(V.item_token_counts(p.train, fx.vacancies(spark, d), dense_tokens=False),
                          asked=100)


def i2i_cooccurrence_events(spark, d):
    return _i2i_view(f1_i2i(spark, d))


def i2i_cooccurrence_orders(spark, d):
    p = f2(spark, d)
    return _i2i_view(knn.sparse_i2i(V.item_token_counts(p.train, fx.vacancies(spark, d), dense_tokens=False),
                                    asked=100))


def i2i_candidates_events(spark, d):
    p = f1(spark, d)
    out = C.i2i_candidates(p.test, f1_i2i(spark, d, p))
    return out.select("user_id", "vacancy_id", num("score", 9).alias("score"))


def i2i_topk_bucketed_events(spark, d):
    """A5 -> R13b: the list stored in buckets by its anchor, and read by two jobs without a shuffle of it."""
    p = f1(spark, d)
    table = store_bucketed(f1_i2i(spark, d, p), _run_folder(spark), "i2i", Split.MICRO, buckets=8)
    return C.i2i_topk_candidates(p.test, load_bucketed(spark, table), 20).select("user_id", "vacancy_id", num("score", 9).alias("score"))


def i2i_topk_events(spark, d):
    p = f1(spark, d)
    out = C.i2i_topk_candidates(p.test, f1_i2i(spark, d, p), 20)
    return out.select("user_id", "vacancy_id", num("score", 9).alias("score"))


def round_robin_events(spark, d):
    """R11 as the source asks: 20 neighbours per item, the item itself among them."""
    p = f1(spark, d)
    counts = V.item_token_counts(p.train, fx.vacancies(spark, d), dense_tokens=False)
    rr = C.round_robin(p.test, knn.sparse_i2i(counts, asked=20, include_self=True))
    return rr.select("user_id", "vacancy_id", F.col("pos").cast("bigint").alias("pos"))


def unique_neighbours_events(spark, d):
    p = f1(spark, d)
    return C.unique_neighbours(p.test, f1_i2i(spark, d, p))


def _three_generators(spark, d, p):
    return {
        "continue_search": C.continue_search(p.train, p.test),
        "i2i": C.i2i_topk_candidates(p.test, f1_i2i(spark, d, p), 20),
        "popular": C.constant_candidates(p.test, C.popular_items(p.train, 100)),
    }


def candidate_join_events(spark, d):
    p = f1(spark, d)
    j = C.join_candidates(_three_generators(spark, d, p))
    return j.select("user_id", "vacancy_id", num("continue_search_score").alias("continue_search_score"),
                    num("i2i_score", 9).alias("i2i_score"), num("popular_score").alias("popular_score"))


def three_generator_mrr_events(spark, d):
    """R31 with three generators: merge -> seen filter -> constant ranker
    with a declared priority (continue-search recency, then i2i, then
    popularity, then item id) -> pack 100 -> submission -> metrics."""
    p = f1(spark, d)
    j = R.constant_ranker(R.seen_filter(C.join_candidates(_three_generators(spark, d, p)), p.train))
    order = [F.col("continue_search_score").asc_nulls_last(), F.col("i2i_score").desc_nulls_last(),
             F.col("popular_score").desc_nulls_last(), F.col("vacancy_id").asc()]
    sub = R.submission(p.truth, R.pack(R.rank(j, order, 100)))
    return _metrics_view(mrr_recall(p.truth, sub, 100))


def random_rank_events(spark, d):
    """Continue-search candidates ordered by a repeatable random score."""
    p = f1(spark, d)
    cands = R.random_ranker(C.continue_search(p.train, p.test, drop_seen_responses=True))
    packed = R.pack(R.rank(cands, [F.col("random_ranker").desc(), F.col("vacancy_id")], 100))
    return packed.select("user_id", list_str("predictions").alias("predictions"))


def feature_rank_events(spark, d):
    """The merged candidates ordered by a model over their three scores
    (fixed weights: the source's model is a placeholder)."""
    p = f1(spark, d)
    kept = R.seen_filter(C.join_candidates(_three_generators(spark, d, p)), p.train)
    features = ["continue_search_score", "i2i_score", "popular_score"]
    scored = R.feature_ranker(kept, R.LinearScorer([-0.5, 2.0, 0.01], 0.25), features)
    ranked = R.rank(scored.withColumn("model_score", F.round("model_score", 9)), [F.col("model_score").desc(), F.col("vacancy_id")], 100)
    return ranked.select("user_id", "vacancy_id", num("model_score", 9).alias("model_score"), F.col("pos").cast("bigint").alias("pos"))


RANKER_FEATURES = ["continue_search_score", "i2i_score", "popular_score"]


def _ranker_training(spark, d, p):
    merged = materialise(C.join_candidates(_three_generators(spark, d, p)), "ranker_candidates")
    return merged, R.training_table(merged, p.truth, negatives=10)


def ranker_training_events(spark, d):
    """R20, fit side: merged candidates with their labels, ten sampled negatives per user."""
    _, rows = _ranker_training(spark, d, f1(spark, d))
    return rows.select("user_id", "vacancy_id", F.col("label").cast("bigint").alias("label"), num("continue_search_score").alias("continue_search_score"),
                       num("i2i_score", 9).alias("i2i_score"), num("popular_score").alias("popular_score"))


def trained_rank_events(spark, d):
    """Boosted trees fitted on half of the users, stored, loaded, and used to rank the other half's unseen candidates."""
    p = f1(spark, d)
    merged, rows = _ranker_training(spark, d, p)
    half = F.pmod(F.xxhash64("user_id"), F.lit(2)) == 0
    path = R.fit_ranker(rows.where(half), RANKER_FEATURES, os.path.join(_run_folder(spark), "ranker"))
    scored = R.trained_ranker(R.seen_filter(merged.where(~half), p.train), path, RANKER_FEATURES)
    ranked = R.rank(scored.withColumn("model_score", F.round("model_score", 9)), [F.col("model_score").desc(), F.col("vacancy_id")], 100)
    return ranked.select("user_id", "vacancy_id", num("model_score", 9).alias("model_score"), F.col("pos").cast("bigint").alias("pos"))


# ----------------------------------------------------------------- R4, R7, R9, R10, R14, R17
def knn_embeddings(spark, d):
    return _i2i_view(knn.dense_i2i(fx.item_vectors(spark, d), asked=100))


def ivf_full_probe_embeddings(spark, d):
    """R9 with as many probes as cells: the exact list."""
    return _i2i_view(ann.ivf_i2i(fx.item_vectors(spark, d), nlist=8, nprobe=8, asked=100))


def svd_full_rank_i2i_events(spark, d):
    """R7 with as many components as items: the neighbours of the counts themselves, to six places."""
    vecs = V.svd_item_vectors(V.item_token_counts(f1(spark, d).train, fx.vacancies(spark, d)), k=100)
    return _i2i_view(knn.dense_i2i(vecs, asked=100, digits=6))


def label_centers(spark, d) -> np.ndarray:
    """Mean unit vector of each label of ``embeddings`` (labels are few), by label."""
    vecs = knn.unit_vectors(fx.table(spark, d, "embeddings").select("label", F.col("embedding").alias("vec")))
    means = (vecs.select("label", F.posexplode("vec").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
                 .groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v")).orderBy("label").collect())
    return np.array([[e["x"] for e in r["v"]] for r in means])


def cluster_knn_labels(spark, d):
    """R10 with a centroid per label of ``embeddings`` (50 items per centroid)."""
    return _i2i_view(ann.cluster_knn(fx.item_vectors(spark, d), top_size=50, centers=label_centers(spark, d)))


def text_knn_part_names(spark, d):
    """Names of the users' history items -> word counts -> exact
    cosine over all part names (20 asked, the item itself may be among
    them) -> distinct neighbours per user."""
    p = f2(spark, d)
    names = V.text_token_counts(fx.vacancies(spark, d), "vacancy_id", "name")
    i2i = knn.sparse_i2i(names.select("key", "token", "val"), asked=20, include_self=True)
    return C.unique_neighbours(p.test, i2i)


def text_knn_documents(spark, d):
    """R14 neighbour step on the long multilingual texts: whole documents
    -> Unicode word counts -> exact cosine, 20 asked per document."""
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    counts = V.text_token_counts(docs, "doc_id", "text").select("key", "token", "val")
    return _i2i_view(knn.sparse_i2i(counts, asked=20))


def text_knn_benchmark(spark, d):
    """R14, query side: ``benchmark`` texts, which are not in the index, against all documents; the vocabulary is the documents'
    and is stored, unknown words are dropped; 20 nearest documents per text."""
    docs, asked = fx.table(spark, d, "documents"), fx.table(spark, d, "benchmark")
    counts = materialise(V.text_token_counts(docs, "doc_id", "text").drop("token"), "text_counts")
    vocabulary = materialise(V.fit_vocabulary(counts), "vocabulary")
    queries = V.known_words(V.text_token_counts(asked, "item_id", "text").drop("token"), vocabulary)
    return _i2i_view(knn.sparse_query(queries, V.known_words(counts, vocabulary), 20, keys=asked.select(F.col("item_id").alias("key"))))


def cold_user_items_orders(spark, d):
    """R17 cold branch over the whole of F2: validation users without train
    sessions get their own items in session order, score 0."""
    p = f2(spark, d)
    test = interactions(p.validation_sessions, keep=["user_id", "session_id"])
    out = C.cold_user_items(test, p.train_sessions)
    return out.select("user_id", "session_id", "vacancy_id", F.col("pos").cast("bigint").alias("pos"),
                      num("score").alias("score"))


# ----------------------------------------------------------------- registry
SQL_CHECKED: dict[str, Query] = {
    "session_normalise_events": session_normalise_events,
    "session_normalise_orders_ties": session_normalise_orders_ties,
    "interactions_events": interactions_events,
    "id_codec_events": id_codec_events,
    "time_split_events": time_split_events,
    "truth_events": truth_events,
    "truth_orders": truth_orders,
    "truth_orders_ties": truth_orders_ties,
    "leave_last_out_events": leave_last_out_events,
    "continue_search_events": continue_search_events,
    "seen_filter_events": seen_filter_events,
    "pack_events": pack_events,
    "submission_events": submission_events,
    "mrr_recall_events": mrr_recall_events,
    "mrr_recall_orders": mrr_recall_orders,
    "mrr_unbounded_events": mrr_unbounded_events,
    "submission_scoring_events": submission_scoring_events,
    "eda_sessions_per_day": eda_sessions_per_day,
    "eda_sessions_per_user": eda_sessions_per_user,
    "eda_sessions_per_user_summary": eda_sessions_per_user_summary,
    "eda_item_frequency": eda_item_frequency,
    "eda_item_frequency_summary": eda_item_frequency_summary,
    "eda_items_per_user": eda_items_per_user,
    "eda_items_per_user_summary": eda_items_per_user_summary,
    "popular_candidates_events": popular_candidates_events,
    "item_tokens_events": item_tokens_events,
    "dictionary_items_orders": dictionary_items_orders,
    "i2i_cooccurrence_events": i2i_cooccurrence_events,
    "i2i_cooccurrence_orders": i2i_cooccurrence_orders,
    "i2i_candidates_events": i2i_candidates_events,
    "i2i_topk_events": i2i_topk_events,
    "round_robin_events": round_robin_events,
    "unique_neighbours_events": unique_neighbours_events,
    "candidate_join_events": candidate_join_events,
    "three_generator_mrr_events": three_generator_mrr_events,
    "knn_embeddings": knn_embeddings,
    "text_knn_part_names": text_knn_part_names,
    "text_knn_documents": text_knn_documents,
    "cold_user_items_orders": cold_user_items_orders,
    "truth_hot_user_events": truth_hot_user_events,
    "continue_search_hot_user_events": continue_search_hot_user_events,
    "seen_filter_counts_events": seen_filter_counts_events,
    "submission_scoring_limit_events": submission_scoring_limit_events,
    "dataset_round_trip_events": dataset_round_trip_events,
    "eda_sessions_per_day_sample": eda_sessions_per_day_sample,
    "item_tokens_geo_events": item_tokens_geo_events,
    "user_item_matrix_events": user_item_matrix_events,
    "random_rank_events": random_rank_events,
    "feature_rank_events": feature_rank_events,
    "ivf_full_probe_embeddings": ivf_full_probe_embeddings,
    "svd_full_rank_i2i_events": svd_full_rank_i2i_events,
    "cluster_knn_labels": cluster_knn_labels,
    "continue_search_state_events": continue_search_state_events,
    "time_split_by_day_events": time_split_by_day_events,
    "i2i_topk_bucketed_events": i2i_topk_bucketed_events,
    "text_knn_benchmark": text_knn_benchmark,
    "ranker_training_events": ranker_training_events,
}
