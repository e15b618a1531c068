"""End-to-end flows (R31): one lazy plan per run, built with ``transform``.

``prepare`` is the dataset job (normalise -> split -> truth); ``recommend``
runs generators -> merge -> seen filter -> ranker -> pack -> submission;
``evaluate`` scores it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nextclick.operators import candidates as C
from nextclick.operators import ranking as R
from nextclick.operators.metrics import mrr_recall
from nextclick.operators.sessions import interactions, normalise_sessions
from nextclick.operators.truth import next_response_truth, time_split
from nextclick.sources.tables import materialise


@dataclass
class Prepared:
    train_sessions: DataFrame
    validation_sessions: DataFrame
    truth: DataFrame          # history session + target, target_dt, val_session_rank
    train: DataFrame          # flat train interactions
    test: DataFrame           # flat interactions of the truth history sessions


def prepare(raw_sessions: DataFrame, train_range: tuple[str, str],
            validation_range: tuple[str, str], materialise_tables: bool = True) -> Prepared:
    """Normalise -> split -> truth. The normalised log and the truth feed
    several branches (train history, candidates, seen filter, skeleton,
    metrics), so by default each is written once to the shared checkpoint
    folder and scanned back instead of being re-derived per branch."""
    sessions = raw_sessions.transform(normalise_sessions)
    if materialise_tables:
        sessions = materialise(sessions, "sessions", sort_within=["session_dt"])
    train_s, val_s = time_split(sessions, train_range, validation_range)
    truth = next_response_truth(val_s)
    if materialise_tables:
        truth = materialise(truth, "truth")
    train = interactions(train_s, keep=["user_id", "session_id"])
    test = interactions(truth, keep=["user_id", "session_id"])
    return Prepared(train_s, val_s, truth, train, test)


def cs_order():
    return [F.col("continue_search_score").asc(), F.col("vacancy_id").asc()]


def continue_search_recs(p: Prepared, k: int | None = 100) -> DataFrame:
    """Continue-search flow: R25 -> R21 (train responses) -> R19 -> R22.
    The constant ranker leaves the generator's own score (lower is
    better) and then the item id as the order."""
    # continue_search is already one row per (user, item); the seen filter
    # over the same train history is fused into its aggregation.
    kept = (C.continue_search(p.train, p.test, drop_seen_responses=True)
             .withColumnRenamed("score", "continue_search_score"))
    ranked = R.constant_ranker(kept)
    return R.rank(ranked, [F.col("constant_ranker").desc()] + cs_order(), k)


def continue_search_submission(p: Prepared, k: int = 100) -> DataFrame:
    recs = R.pack(continue_search_recs(p, k))
    return R.submission(p.truth, recs)


def evaluate(p: Prepared, submission: DataFrame, k: int = 100) -> DataFrame:
    return mrr_recall(p.truth, submission, k)


