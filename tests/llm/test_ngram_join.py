import random

import pytest

from conftest import SF001
from helpers import frame, near_classes
from nextclick.llm import ngram_join
from nextclick.llm.common import materialise, row_keyed
from nextclick.llm.components import connected
from oracle_harness import compare, duck


def family(seed=4):
    """One large group of near copies, one of exact copies, short and empty texts, strangers."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(120)]
    out = []
    for i in range(60):
        copy = list(base)
        for _ in range(i % 4):
            copy[rng.randrange(len(copy))] = word()
        out.append(" ".join(copy))
    out += [" ".join(base[:80] + [word() for _ in range(40)]) for _ in range(5)]
    out += [" ".join(base)] * 7 + ["a b c"] * 3 + ["", None, " \n", "a b d"] + [" ".join(word() for _ in range(60)) for _ in range(30)]
    return out


@pytest.mark.parametrize("rows", [1_024, 4])
def test_links_and_classes_against_all_pairs(spark, monkeypatch, rows):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", rows)
    texts = family()
    docs = materialise(row_keyed(frame(spark, [(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, class_id string")), "near")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join.similar_classes(docs).collect())
    links, classes = near_classes(texts)
    assert got == [(i, c, n) for i, (c, n) in enumerate(zip(classes, links, strict=True))]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").toPandas().sort_values("doc_id")
    got = ngram_join.op6_ngram_jaccard_join(spark, SF001).toPandas().sort_values("doc_id")
    links, classes = near_classes(list(docs.text))
    assert list(got.n_links) == links and list(got.class_id) == [docs.doc_id.iloc[c] for c in classes]
    kept = ngram_join.near_duplicates_stage(spark, spark.read.parquet(f"{SF001}/documents.parquet"), "")
    assert kept.columns == list(docs.columns) and sorted(r.doc_id for r in kept.collect()) == sorted({docs.doc_id.iloc[c] for c in classes})


def test_repeated_ids_and_empty_table(spark):
    docs = materialise(row_keyed(frame(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (1, "x"), (None, "y z")], "doc_id long, text string")), "ids")
    rows = ngram_join.similar_classes(docs).collect()
    assert len(rows) == 4 and sorted(r.n_links for r in rows) == [0, 0, 1, 1]
    assert ngram_join.similar_classes(docs.limit(0)).count() == 0


def test_query_against_sql(spark):
    assert compare(spark, duck(SF001), "op6", ngram_join.op6_ngram_jaccard_join, ngram_join.OP6_SQL, SF001)


def test_bands_reach_the_recall():
    b = ngram_join.bands_for(0.8, 0.9999)
    assert 1 - (1 - 0.8 ** 4) ** b >= 0.9999 > 1 - (1 - 0.8 ** 4) ** (b - 1)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(500, 500), (7, 3)]
    out = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}}
