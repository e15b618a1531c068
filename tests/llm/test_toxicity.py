import numpy as np

from conftest import SF01
from helpers import frame
from nextclick.llm import toxicity


def test_noisy_or_finds_the_sentence():
    rng = np.random.default_rng(0)
    bags, labels = [], []
    for _ in range(400):
        bag = [[int(f) for f in rng.integers(2, 40, 6)] for _ in range(rng.integers(1, 12))]
        toxic = rng.random() < 0.4
        if toxic:
            bag[int(rng.integers(len(bag)))].append(int(rng.integers(0, 2)))
        bags.append(bag)
        labels.append(int(toxic))
    weights, bias = toxicity.fit_noisy_or(bags, np.array(labels), 40)
    assert weights[:2].min() > weights[2:].max() + 2 and bias < -2


def test_held_out_ranking_and_whole_table(spark):
    out = toxicity.op2_toxicity(spark, SF01).toPandas()
    assert len(out) == 1000 and out.score.between(0, 1).all() and (out.predicted == (out.score >= 0.7)).all()
    labels = spark.read.parquet(f"{SF01}/labels.parquet").toPandas()
    test = out[out.held_out].merge(labels, on="doc_id")
    rank = test.score.rank()
    pos = test.toxic == 1
    auc = (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
    assert auc >= 0.9


def test_offending_sentences_and_edges(spark, tmp_path):
    docs = [(i, f"Fine words here {i}. " + ("You utter idiot." if i % 3 == 0 else "All is calm.") + " The end.", "l") for i in range(300)]
    docs += [(None, None, "l"), (1000, "", "l"), (1001, "What. You idiot! Bye", "l"), (1001, "What. You idiot! Bye", "l")]
    frame(spark, docs, "doc_id long, text string, score string").write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, [(i, int(i % 3 == 0)) for i in range(300)] + [(5, None), (None, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = toxicity.op2_toxicity(spark, str(tmp_path)).collect()
    assert len(rows) == 304
    found = [r for r in rows if r.doc_id == 1001]
    assert all(r.predicted == 1 and r.offending == "5:15" for r in found) and found[0].score == found[1].score
    assert all(r.predicted == 0 for r in rows if r.doc_id in (None, 1000))


def test_without_labels(spark):
    docs = frame(spark, [(1, "a"), (2, None)], "doc_id long, text string")
    model = toxicity.fit(docs, frame(spark, [(1, 1)], "doc_id long, toxic int"))
    assert [r.s.score for r in docs.select(toxicity.score(docs.text, model).alias("s")).collect()] == [0.0, 0.0]


def test_weights_stand_for_repeated_rows():
    """A text that counts k times is fitted as k equal texts."""
    rng = np.random.default_rng(3)
    bags = [[[int(f) for f in rng.integers(0, 10, 3)] for _ in range(3)] for _ in range(60)]
    labels = np.array([int(any(0 in s for s in b)) for b in bags])
    counts = np.where(labels > 0, 1, 4)
    many = [i for i, n in enumerate(counts) for _ in range(n)]
    a, b = toxicity.fit_noisy_or(bags, labels, 10, counts=counts), toxicity.fit_noisy_or([bags[i] for i in many], labels[many], 10)
    assert np.allclose(a[0], b[0], atol=1e-3) and np.isclose(a[1], b[1], atol=1e-3)


def test_a_smaller_sample_keeps_the_share_of_toxic_texts(spark):
    """Words say little here, so the mean score is the share of toxic rows the model was fitted to: 10 % of all, whatever is drawn."""
    rng = np.random.default_rng(1)
    docs = frame(spark, [(i, " ".join(f"w{k}" for k in rng.integers(0, 30, 4))) for i in range(2_000)], "doc_id long, text string")
    labels = frame(spark, [(i, int(i % 10 == 0)) for i in range(2_000)], "doc_id long, toxic int")
    for most in (6_000, 150):
        model = toxicity.fit(docs, labels, max_per_label=most)
        assert np.mean([model.locate(r.text)[0] for r in docs.collect()]) < 0.2


def test_equal_rows_weigh_what_they_are(spark):
    """One toxic text in 40 rows against as many different clean ones: its own score nears 1, as 40 rows do, not as one does."""
    docs = [(i, "w1 w2 w3") for i in range(40)] + [(100 + i, f"w{i % 7} v{i} v{i + 1}") for i in range(40)] + [(200, "w1 w2 w3")]
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)] + [(200, 0)]
    docs = frame(spark, docs, "doc_id long, text string")
    model = toxicity.fit(docs, frame(spark, labels, "doc_id long, toxic int"), min_texts=1)
    assert model.locate("w1 w2 w3")[0] > 0.9
