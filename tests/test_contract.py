"""Driver contract: entry smoke, registry shape, and the SQL oracle at sf0.001."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle_harness import compare, duck


def test_entry_smoke(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 1 and rows[0].n_queries == 8
    assert rows[0].mrr == pytest.approx(0.011364, abs=5e-7)


def test_registry_shape():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 40
    numbered = {k.partition("_")[0] for k in qs if k.startswith("op")}
    assert numbered in (set(), {f"op{n}" for n in range(1, 14)}) and ("pipeline" in qs) == bool(numbered)


def test_without_the_text_operators():
    """The package of the text operators and their pipeline may be missing; nothing else may need them."""
    code = ("import sys; sys.modules['nextclick.llm'] = None; sys.modules['corpus_pipeline'] = None; "
            "import __spark_entry__ as e; assert len(e.queries()) >= 60 and not any(k.startswith('op') for k in e.queries())")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(E.__file__))


FAST = ["session_normalise_orders_ties", "truth_orders_ties", "leave_last_out_events", "submission_events",
        "eda_sessions_per_user_summary", "popular_candidates_events", "round_robin_events",
        "candidate_join_events", "knn_embeddings", "text_knn_part_names", "cold_user_items_orders", "truth_hot_user_events", "dataset_round_trip_events",
        "dictionary_items_orders", "mrr_unbounded_events"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_sf0001(spark, name):
    con = duck(SF001)
    assert compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF001)
