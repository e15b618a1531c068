import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from helpers import WORD, frame
from nextclick.llm import quality


def plain_repeats(words):
    windows = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside.update(range(i, i + 5))
    return len(inside)


def test_repeated_words_against_all_windows():
    random.seed(1)
    for _ in range(200):
        words = [random.choice("abc") for _ in range(random.randint(0, 40))]
        assert quality.repeated_words(words) == plain_repeats(words)


def test_counts_of_one_text():
    got = quality.text_statistics("a b #x\n\na b #x\n \t\na\x0bb |& y")
    words = WORD.findall("a b #x\n\na b #x\n \t\na\x0bb |& y")
    assert got["n_words"] == len(words) == 9
    assert got["word_chars"] == sum(map(len, words))
    assert (got["n_symbols"], got["n_dup_lines"]) == (4, 1)


def test_empty_null_and_clashing_columns(spark):
    docs = frame(spark, [(1, None, 0.5, "x"), (1, "", 0.1, "y"), (None, " \n ", 0.2, "z"), (2, "w " * 50, 0.3, "q")],
                 "doc_id long, text string, score double, kept string")
    out = quality.judge(docs, quality.QualityModel(None, 1.0)).orderBy("score").collect()
    assert [r.kept for r in out] == ["y", "z", "q", "x"]
    assert [r.quality.kept for r in out] == [False] * 4 and out[2].quality.n_repeat_words == 50
    assert quality.judge(docs.limit(0), quality.QualityModel(None, 1.0)).count() == 0


def test_verdicts_follow_labels_and_no_labels_means_base_rule(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    stats = quality.document_statistics(docs)
    fitted = quality.fit(stats, labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0))
    good = labels.select("doc_id", F.col("quality").alias("good"))
    rows = quality.with_verdict(stats, fitted).join(good, "doc_id").where("not quality.base_failed and crc32(cast(doc_id as string)) % 2 = 1")
    share = {r.good: r.kept for r in rows.groupBy("good").agg(F.avg(F.col("quality.kept").cast("int")).alias("kept")).collect()}
    assert share[1] >= 0.97 and share[0] <= 0.1
    empty = quality.fit(stats, labels.limit(0))
    assert empty.forest is None
    assert quality.with_verdict(stats, empty).where("quality.kept = quality.base_failed").count() == 0


def test_forest_against_plain_trees():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3))
    x[:, 2] = 0.0
    forest = quality.grow_forest(x, 20, 64, 5)
    asked = np.vstack([x[:40], [[0.0, 0.0, 0.9], [9.0, 0.0, 0.0], [0.0, -9.0, 0.9]]])

    def path(tree, row):
        node = 0
        while forest.left[tree][node] >= 0:
            below = row[forest.feature[tree][node]] < forest.split[tree][node]
            node = forest.left[tree][node] if below else forest.right[tree][node]
        return forest.depth[tree][node]

    expected = [2 ** (-sum(path(t, row) for t in range(20)) / 20 / forest.scale) for row in asked]
    got = forest.score(asked)
    assert np.allclose(got, expected)
    assert got[40:].min() > np.quantile(got[:40], 0.9), "values that no row has are isolated early, also on a constant column"


def test_path_lengths_alone_tell_bad_rows(spark):
    stats = quality.document_statistics(spark.read.parquet(f"{SF01}/documents.parquet"))
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", F.col("quality").alias("good"))
    rows = stats.where(~quality.base_failed("quality")).join(labels, "doc_id").select("good", *[f"quality.{c}" for c in quality.RATES]).toPandas()
    x, good = quality.scaled(rows[quality.RATES].to_numpy(dtype=float)), rows["good"].to_numpy()
    forest = quality.grow_forest(x[good == 1][::2], 64, 256, 7)
    score = forest.score(x)
    limit = np.quantile(score[good == 1], 0.99)
    assert (score[good == 0] > limit).mean() >= 0.9


def test_stage_keeps_columns_and_filters(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    out = quality.quality_stage(spark, docs, SF01)
    assert out.columns == docs.columns and 0 < out.count() < docs.count()


def test_query_agrees_with_plain_statistics(spark):
    got = {r.doc_id: r for r in quality.op10_quality_rules(spark, SF01).collect()}
    for r in spark.read.parquet(f"{SF01}/documents.parquet").orderBy("doc_id").limit(60).collect():
        words = WORD.findall(r.text)
        g = got[r.doc_id]
        repeats = plain_repeats(words) if len(words) < 800 else g.n_repeat_words
        assert (g.n_words, g.word_chars, g.n_repeat_words) == (len(words), sum(map(len, words)), repeats)
        assert g.base_failed == (len(words) < 10 or 100 * repeats > 20 * len(words))
        assert not (g.base_failed and g.kept)
    assert len(got) == pytest.approx(1000)


def test_bounded_sample(spark):
    from nextclick.llm.common import bounded_sample
    rows = spark.range(20_000).withColumnRenamed("id", "doc_id")
    once = {r.doc_id for r in bounded_sample(rows, 500).collect()}
    assert len(once) == 500 and once == {r.doc_id for r in bounded_sample(rows.repartition(5), 500).collect()}
    assert bounded_sample(rows.limit(30), 500).count() == 30 and bounded_sample(rows.limit(0), 5).count() == 0
