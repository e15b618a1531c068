"""Toxicity by multiple-instance learning.

A text is a bag of sentences. A sentence has a probability (logistic in the words it has); the text's score is their
noisy-or, 1 - prod(1 - p). Only texts are labelled, so the sentence weights are fitted through the noisy-or, and then say which sentences offend.

The model is fitted on a bounded sample of the labelled rows (``max_per_label`` of each label, those with the smallest id
hashes), in which each row weighs as many labelled rows as it stands for, so the share of toxic rows that the model is fitted to is that
of all labelled rows; all texts are scored whole, in one pass without a shuffle.

Defined cases: a null or empty text is one empty sentence and gets that sentence's probability; labels that are null
are ignored, of several for a document the highest counts; rows with a null id are scored, not fitted on; equal rows get equal
scores; without labels of both kinds every score is 0.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nextclick.llm.common import bounded_sample, materialise, narrow_batches, null_to_empty, read

_SENTENCE = re.compile(r"[^.!?\n]+")
_TOKEN = re.compile(r"\w+")
#: Log-odds from which a sentence is named.
OFFENDING = 0.0


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans between sentence ends; at least one."""
    return [m.span() for m in _SENTENCE.finditer(text)] or [(0, len(text))]


def tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def features(token: str) -> list[str]:
    """The word itself and its beginnings: inflected and compound forms share weights."""
    return [f"={token}", *(f"^{token[:k]}" for k in (4, 5, 6, 7, 8) if len(token) > k)]


@dataclass
class ToxicityModel:
    vocabulary: dict[str, int]
    weights: list[float]
    bias: float
    #: Features of the words met so far in a task.
    met: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def features_of(self, words: list[str]) -> set[int]:
        out: set[int] = set()
        for w in words:
            ids = self.met.get(w)
            if ids is None:
                ids = tuple(self.vocabulary[f] for f in features(w) if f in self.vocabulary)
                if len(self.met) < 300_000:
                    self.met[w] = ids
            if ids:
                out.update(ids)
        return out

    def locate(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Score of a text and its offending sentences (start, end, probability)."""
        if not self.vocabulary:
            return 0.0, []
        total, found, weight = 0.0, [], self.weights.__getitem__
        for start, end in sentences(text):
            z = self.bias + sum(map(weight, self.features_of(tokens(text[start:end]))))
            total += z if z > 30 else math.log1p(math.exp(z))
            if z >= OFFENDING:
                found.append((start, end, 1 / (1 + math.exp(-min(z, 40)))))
        return -math.expm1(-total), found


def fit_noisy_or(bags: list[list[list[int]]], labels: np.ndarray, n_features: int, rounds: int = 400, l2: float = 2e-5,
                 rate: float = 0.05, counts: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of the bag labels under the noisy-or, by Adam on the full sample.
    ``bags``: per text, per sentence, the features it has. ``counts``: rows that each text stands for (one each)."""
    each = np.ones(len(bags)) if counts is None else np.asarray(counts, dtype=float)
    each = each * (len(bags) / each.sum())
    owner = np.array([i for i, bag in enumerate(bags) for _ in bag], dtype=np.int64)
    lists = [s for bag in bags for s in bag]
    row = np.repeat(np.arange(len(lists)), [len(s) for s in lists])
    col = np.array([f for s in lists for f in s], dtype=np.int64)
    theta = np.zeros(n_features + 1)
    theta[-1] = -4.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        z = theta[-1] + np.bincount(row, theta[col], minlength=len(lists))
        exposure = np.maximum(np.bincount(owner, np.logaddexp(0.0, z), minlength=len(bags)), 1e-9)
        pull = (np.where(labels > 0, -1.0 / np.expm1(np.minimum(exposure, 50.0)), 1.0) * each)[owner] * _sigmoid(z)
        slope = np.append(np.bincount(col, pull[row], minlength=n_features), pull.sum()) / len(bags)
        slope[:-1] += l2 * theta[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope ** 2
        theta -= rate * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def fit(docs: DataFrame, labels: DataFrame, max_per_label: int = 6_000, max_features: int = 4_000, min_texts: int = 2) -> ToxicityModel:
    """``docs``: doc_id, text. ``labels``: doc_id, toxic 0/1. Features are chosen by their likelihood ratio between the labels."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    there = {r["toxic"]: r["count"] for r in known.where("toxic in (0, 1)").groupBy("toxic").count().collect()}
    drawn = bounded_sample(known.where("toxic = 0"), max_per_label).unionByName(bounded_sample(known.where("toxic = 1"), max_per_label))
    # At most 2 * max_per_label pairs of numbers are broadcast.
    # Equal texts of a label are fitted once, with the number of rows they are.
    met = docs.join(F.broadcast(drawn), "doc_id").select(null_to_empty().alias("text"), "toxic")
    sample = materialise(met.groupBy("text", "toxic").agg(F.count("*").alias("rows")), "toxic_sample")

    counts = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.sum("rows").alias("n")).collect()}
    if not (counts.get(0) and counts.get(1)):
        return ToxicityModel({}, [], 0.0)
    # Rows of its label that a drawn one stands for; where a label is drawn whole, one.
    stands = {t: max(there[t] / max_per_label, 1.0) for t in counts}
    each = sample.select("toxic", "rows", F.explode(F.arrow_udf(_distinct_features, "array<string>")("text")).alias("token"))
    rows_of = lambda t: F.sum(F.when(F.col("toxic") == t, F.col("rows")).otherwise(0))
    seen = each.groupBy("token").agg(rows_of(1).alias("a"), rows_of(0).alias("b"), F.count("*").alias("texts")).where(F.col("texts") >= min_texts)
    pos, neg = counts[1] * stands[1], counts[0] * stands[0]
    seen = seen.select("token", (F.col("a") * stands[1]).alias("a"), (F.col("b") * stands[0]).alias("b"))
    share = (F.col("a") + F.col("b")) / (pos + neg)
    gain = sum(F.when(F.col(c) > 0, F.col(c) * F.ln(F.col(c) / (n * share))).otherwise(0.0) +
               F.when(n - F.col(c) > 0, (n - F.col(c)) * F.ln((n - F.col(c)) / (n * (1 - share)))).otherwise(0.0)
               for c, n in (("a", pos), ("b", neg)))
    chosen = seen.where(F.col("a") + F.col("b") < pos + neg).orderBy(F.desc(F.round(gain, 6)), "token").limit(max_features).collect()
    vocabulary = {r["token"]: i for i, r in enumerate(chosen)}
    if not vocabulary:
        return ToxicityModel({}, [], 0.0)

    model = ToxicityModel(vocabulary, [], 0.0)

    def bags(texts: pa.Array) -> pa.Array:
        return pa.array([[sorted(model.features_of(tokens(t[a:b]))) for a, b in sentences(t)] for t in texts.to_pylist()],
                        pa.list_(pa.list_(pa.int32())))

    rows = sample.select("toxic", "rows", F.arrow_udf(bags, "array<array<int>>")("text").alias("bag"), F.sha2("text", 256).alias("at")).orderBy("at").drop("at").collect()
    weights, bias = fit_noisy_or([r["bag"] for r in rows], np.array([r["toxic"] for r in rows]), len(vocabulary),
                                 counts=np.array([r["rows"] * stands[r["toxic"]] for r in rows]))
    return ToxicityModel(vocabulary, weights.tolist(), bias)


def _distinct_features(texts: pa.Array) -> pa.Array:
    return pa.array([list({f for w in set(tokens(t)) for f in features(w)}) for t in texts.to_pylist()], pa.list_(pa.string()))


def score(text: Column, model: ToxicityModel) -> Column:
    """struct<score, offending>: offending sentences as spans of code points, end exclusive, with their probability."""
    kind = pa.struct([("score", pa.float64()), ("offending", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])))])

    def run(texts: pa.Array) -> pa.Array:
        found = [model.locate(t or "") for t in texts.to_pylist()]
        return pa.array([{"score": s, "offending": [{"start": a, "end": b, "p": p} for a, b, p in where]} for s, where in found], kind)

    return F.arrow_udf(run, "score double, offending array<struct<start:bigint,end:bigint,p:double>>")(text)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow_batches(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", null_to_empty().alias("text"))
    model = fit(docs, read(spark, sf_dir, "labels").where(~held_out()))
    scored = docs.select("doc_id", held_out().alias("held_out"), score(F.col("text"), model).alias("s"))
    return scored.select("doc_id", "held_out", F.col("s.score").alias("score"), (F.col("s.score") >= 0.7).cast("int").alias("predicted"),
                         F.array_join(F.transform("s.offending", lambda o: F.concat_ws(":", o["start"].cast("string"), o["end"].cast("string"))), ",").alias("offending"))
