"""Parquet sources and sinks (A1-A6, A8) and the row-count observation."""

import os
import tempfile
import time

from pyspark.sql import Observation
from pyspark.sql import functions as F

from nextclick.operators import ranking as R
from nextclick.schemas import SESSION_SCHEMA, SUBMISSION_SCHEMA, Split
from nextclick.sources import parquet as P
from nextclick.sources.tables import materialise


def test_split_paths_and_round_trip(spark):
    base = tempfile.mkdtemp(prefix="nc-io-")
    df = spark.createDataFrame([(1, "s", [1], [1], [None])], SESSION_SCHEMA)
    for split in Split:
        P.write_dataset(df, P.dataset_path(base, split, "train"))
        assert P.read_train(spark, base, split, SESSION_SCHEMA).count() == 1
    assert P.dataset_path(base, Split.TEST, "test").endswith(os.path.join("submit", "test.parquet"))
    assert P.dataset_path(base, Split.MICRO, "train").endswith(os.path.join("micro", "train.parquet"))


def test_vacancies_dotted_columns_renamed(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="nc-vac-"), "v.parquet")
    spark.createDataFrame([(1, "a", "b", "n")], "vacancy_id long, `area.id` string, `area.regionId` string, name string") \
        .write.parquet(path)
    v = P.read_vacancies(spark, path)
    assert set(v.columns) == {"vacancy_id", "area_id", "region_id", "name"}


def test_submission_and_frame_sinks(spark):
    base = tempfile.mkdtemp(prefix="nc-sub-")
    sub = spark.createDataFrame([(1, "s", [3, 4]), (2, None, [])], SUBMISSION_SCHEMA)
    path = P.write_submission(sub.withColumn("extra", sub.user_id), base, "exp", Split.VALIDATION)
    back = P.read_table(spark, path, SUBMISSION_SCHEMA)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, sub.collect()))
    P.store_frame(sub, base, "i2i", Split.VALIDATION)
    assert P.load_frame(spark, base, "i2i", Split.VALIDATION).count() == 2


def test_seen_filter_observes_counts(spark):
    cands = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "user_id long, vacancy_id long")
    hist = spark.createDataFrame([(1, 2, 1), (2, 2, 3)], "user_id long, vacancy_id long, action_type int")
    before, after = Observation("before"), Observation("after")
    out = R.seen_filter(cands, hist, observations=(before, after)).collect()
    assert len(out) == 2
    assert before.get["rows"] == 3 and after.get["rows"] == 2


def test_tables_are_dropped_on_request(tmp_path, spark):
    from nextclick.sources import tables
    df = tables.materialise(spark.range(3), "t")
    assert df.count() == 3
    folder = tables.tables_dir(spark).removeprefix("file:")
    assert any(n.startswith("t-") for n in os.listdir(folder))
    before = set(os.listdir(folder))
    assert before
    tables.drop_tables(spark)
    assert not os.path.exists(folder)
    assert tables.materialise(spark.range(2), "t").count() == 2


def test_materialise_leaves_no_shuffle_files(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for folder in local for _, _, names in os.walk(folder) for f in names if f.startswith("shuffle_")}
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    had, before = spark.conf.get(name, None), files()
    out = materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "grouped")
    for _ in range(50):  # executors are told, not waited for
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert out.count() == 7 and spark.conf.get(name, None) == had
