import random

import pytest

from helpers import frame, near_classes, removed_repeats, written
from nextclick.llm import common, long_repeats, mixing, ngram_join, pii, quality
from nextclick.llm.common import file_keyed


@pytest.fixture
def resplit(spark, monkeypatch):
    """From the first table written on, files are dealt to partitions in another way, as on a cluster that has lost executors."""
    keys = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}

    def watch(module):
        plain = module.materialise

        def written(*a, **k):
            out = plain(*a, **k)
            for key, value in keys.items():
                spark.conf.set(key, value)
            return out

        monkeypatch.setattr(module, "materialise", written)

    yield watch
    for k, v in before.items():
        spark.conf.set(k, v)


def stored(spark, tmp_path):
    """Documents in files of very different sizes."""
    random.seed(4)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(6))
    base = [" ".join(word() for _ in range(80)) for _ in range(20)]
    texts = [base[i % 20] + f" {i} " + " ".join(word() for _ in range(2)) for i in range(60)] + [" ".join(word() for _ in range(90)) for _ in range(60)]
    at = 0
    for i, n in enumerate((1, 40, 3, 25, 11, 2, 30, 8)):
        frame(spark, list(enumerate(texts))[at: at + n], "doc_id long, text string", 1).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
        at += n
    return texts


def test_classes_when_files_are_split_anew(spark, tmp_path, resplit):
    texts = stored(spark, tmp_path)
    resplit(ngram_join)
    got = {r.doc_id: (r.n_links, r.class_id) for r in ngram_join.op6_ngram_jaccard_join(spark, str(tmp_path)).collect()}
    links, classes = near_classes(texts)
    assert got == {i: (links[i], classes[i]) for i in range(len(texts))}


def test_kept_documents_when_files_are_split_anew(spark, tmp_path, resplit):
    texts = stored(spark, tmp_path)
    resplit(ngram_join)
    kept = ngram_join.near_duplicates_stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(near_classes(texts)[1]))


def test_repeats_when_files_are_split_anew(spark, tmp_path, resplit):
    texts = stored(spark, tmp_path)
    resplit(long_repeats)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in long_repeats.op7_suffix_dedup(spark, str(tmp_path)).collect()}
    assert got == dict(enumerate(removed_repeats(texts, long_repeats.LENGTH)))


def test_a_plain_scan_is_not_written_again(spark, tmp_path, monkeypatch):
    stored(spark, tmp_path)
    names = []
    plain = common.materialise
    for module in (common, ngram_join, long_repeats, mixing):
        monkeypatch.setattr(module, "materialise", lambda df, name, *a, **k: (names.append(name), plain(df, name, *a, **k))[1])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").withColumn("source", common.F.lit("s"))
    docs.write.parquet(f"{tmp_path}/with_source.parquet")
    docs = spark.read.parquet(f"{tmp_path}/with_source.parquet")
    for stage in (ngram_join.near_duplicates_stage, mixing.mixing_stage):
        stage(spark, docs, str(tmp_path)).count()
    long_repeats.op7_suffix_dedup(spark, str(tmp_path)).count()
    assert names and not {"row_keys", "mix_rows"} & set(names)


@pytest.mark.parametrize("stage", [quality.quality_stage, ngram_join.near_duplicates_stage, pii.pii_stage, mixing.mixing_stage])
def test_stages_keep_columns_with_names_of_their_own(spark, tmp_path, stage):
    """Columns that a stage might use itself come out as they went in; nulls, empty and equal rows do not stop it."""
    extra = "row_key long, __row long, __copies int, copies int, size int, taken int, set_id string, kept boolean"
    rows = [(i, t, "en", s, len(t or ""), 77, i, 3, 4, 5, 6, "x", False) for i, (t, s) in enumerate(
        [(" ".join(f"w{i}{j}" for j in range(60)), "abc"[i % 3]) for i in range(30)] + [(None, "a"), ("", None), ("", None)])]
    docs = frame(spark, rows + [rows[0], rows[0]], f"doc_id long, text string, lang string, source string, n_chars long, {extra}")
    written(spark, tmp_path, "documents", docs)
    written(spark, tmp_path, "labels", frame(spark, [(i, i % 4 > 0, 0) for i in range(30)], "doc_id long, quality boolean, toxic int").selectExpr(
        "doc_id", "int(quality) quality", "toxic"))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = stage(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    given = {tuple(r) for r in docs.drop("text").collect()}
    out = [tuple(r) for r in got.drop("text").collect()]
    assert out and set(out) <= given and all(r[4] == 77 for r in out)
    if stage is ngram_join.near_duplicates_stage:
        assert len(out) == 31  # the empty texts are one class, and so are the equal rows


def test_keys_are_different_and_kept(spark, tmp_path):
    docs = frame(spark, [(1, "a", 2)] * 30, "row_key long, _metadata string, __file int", 4)
    docs.write.parquet(f"{tmp_path}/d.parquet")
    keyed = file_keyed(spark.read.parquet(f"{tmp_path}/d.parquet").select("_metadata"), "n")
    assert keyed.select("n").distinct().count() == 30 and keyed.columns == ["_metadata", "n"]
    scan = file_keyed(spark.read.parquet(f"{tmp_path}/d.parquet"), "n")
    assert scan.select("n").distinct().count() == 30 and scan.columns == ["row_key", "_metadata", "__file", "n"]
