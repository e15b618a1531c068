"""Quality rules scored by an isolation forest.

``rule_statistics`` turns a text into rule counts; ``fit`` grows an isolation
forest over the rates derived from them and calibrates its threshold on
labelled rows; ``judge`` adds the verdict to any table with a text column.

The verdict is the path length's alone. Rates are scaled by their logarithm, and a
split is drawn from a range wider than that of the rows it divides: a value that none
of them has falls into an empty leaf near the root, also where all of them agree.

Defined cases: a null or empty text has no words and fails the base rule; a text of any length is
read whole;
repeated rows are judged alike; labels that are null are ignored and, where a
document has several, the best one counts; without labelled good rows (or an
empty table) no forest is grown and the base rule alone decides. Columns other
than the id and the text are passed through by ``judge`` untouched.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nextclick.llm.common import WORD, bounded_sample, materialise, narrow_batches, null_to_empty, read

WINDOW = 5
_WORD = re.compile(WORD)
_SYMBOLS = re.compile(r"[#*$%&|<>]")

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATES = ["symbol_rate", "dup_line_rate", "repeat_rate", "upper_rate", "digit_rate", "lone_symbol_rate",
         "stutter_rate", "word_length", "mark_rate"]
_TYPE = pa.struct([(c, pa.int64()) for c in COUNTS] + [(c, pa.float64()) for c in RATES])
_DDL = ", ".join([f"{c} bigint" for c in COUNTS] + [f"{c} double" for c in RATES])


def repeated_words(words: list[str], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found twice or more in the text."""
    windows = list(zip(*(words[i:] for i in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered, upto = 0, 0
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered += i + width - max(i, upto)
            upto = i + width
    return covered


def repeated_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    return len(lines) - len(set(lines))


def text_statistics(text: str) -> dict[str, float]:
    """Counts and rates of one text; all of it, however long."""
    words = _WORD.findall(text)
    n, chars = len(words), sum(map(len, words))
    symbols = len(_SYMBOLS.findall(text))
    dup_lines, repeats = repeated_lines(text), repeated_words(words)
    per_word, per_char = max(n, 1), max(chars, 1)
    return {
        "n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeats,
        "symbol_rate": symbols / per_char,
        "dup_line_rate": dup_lines / (text.count("\n") + 1),
        "repeat_rate": repeats / per_word,
        "upper_rate": sum(map(str.isupper, words)) / per_word,
        "digit_rate": sum(map(str.isdigit, words)) / per_word,
        "lone_symbol_rate": sum(len(w) == 1 and not w.isalnum() for w in words) / per_word,
        "stutter_rate": sum(map(str.__eq__, words, words[1:])) / per_word,
        "word_length": chars / per_word,
        "mark_rate": (text.count("!") + text.count("?")) / per_char,
    }


def _statistics(texts: pa.Array) -> pa.Array:
    return pa.array([text_statistics(t or "") for t in texts.to_pylist()], _TYPE)


def rule_statistics(text: Column) -> Column:
    """One struct of COUNTS and RATES per text."""
    return F.arrow_udf(_statistics, _DDL)(text)


def base_failed(stats: str) -> Column:
    n, repeats = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < 10) | (100 * repeats > 20 * n)


@dataclass
class IsolationForest:
    """Random binary trees as flat arrays (one row per tree); ``left`` is -1 at a leaf, ``depth`` the path length
    there with the usual correction for the rows that were not split further."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    scale: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected path length): near 1 is anomalous."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for t in range(len(self.feature)):
            node = np.zeros(len(x), dtype=np.int64)
            while True:
                inner = self.left[t][node] >= 0
                if not inner.any():
                    break
                below = x[rows, self.feature[t][node]] < self.split[t][node]
                node = np.where(inner, np.where(below, self.left[t][node], self.right[t][node]), node)
            total += self.depth[t][node]
        return 2.0 ** (-total / len(self.feature) / self.scale)


def _expected_path(n: int) -> float:
    return 0.0 if n < 2 else 2.0 * (np.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def scaled(x: np.ndarray) -> np.ndarray:
    """Logarithms of the rates, in per cent beyond one; the length of words in steps of some 28 %."""
    out = np.log1p(100.0 * x)
    at = RATES.index("word_length")
    out[:, at] = 4.0 * np.log(np.maximum(x[:, at], 0.1))
    return out


def grow_forest(x: np.ndarray, trees: int, subsample: int, seed: int, wider: float = 1.0) -> IsolationForest:
    """Trees over ``subsample`` rows each. A split lies anywhere in the range of the node's rows, widened on both sides
    by ``wider`` times the range of all rows (1 at least, for rates on which all agree)."""
    rng = np.random.default_rng(seed)
    size = min(subsample, len(x))
    limit = int(np.ceil(np.log2(max(size, 2))))
    margin = wider * np.maximum(x.max(axis=0) - x.min(axis=0), 1.0)
    grown = []
    for _ in range(trees):
        nodes: list[list[float]] = []

        def build(rows: np.ndarray, level: int, nodes=nodes) -> int:
            at = len(nodes)
            nodes.append([0, 0.0, -1, -1, level + _expected_path(len(rows))])
            if level >= limit or len(rows) < 2:
                return at
            f = int(rng.integers(x.shape[1]))
            cut = rng.uniform(rows[:, f].min() - margin[f], rows[:, f].max() + margin[f])
            below = rows[:, f] < cut
            nodes[at] = [f, cut, build(rows[below], level + 1), build(rows[~below], level + 1), 0.0]
            return at

        build(x[rng.choice(len(x), size, replace=False)], 0)
        grown.append(nodes)
    width = max(map(len, grown))
    table = np.zeros((trees, width, 5))
    table[:, :, 2:4] = -1
    for t, nodes in enumerate(grown):
        table[t, : len(nodes)] = nodes
    return IsolationForest(table[:, :, 0].astype(np.int64), table[:, :, 1], table[:, :, 2].astype(np.int64),
                           table[:, :, 3].astype(np.int64), table[:, :, 4], max(_expected_path(size), 1e-9))


@dataclass
class QualityModel:
    forest: IsolationForest | None
    threshold: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.zeros(len(x)) if self.forest is None else self.forest.score(scaled(x))


def scored(stats: Column, model: QualityModel) -> Column:
    """Anomaly score from a struct of rates."""

    def run(batch: pa.Array) -> pa.Array:
        x = np.column_stack([batch.field(c).to_numpy(zero_copy_only=False) for c in RATES]).astype(float)
        return pa.array(model.score(x) if len(x) else np.zeros(0), pa.float64())

    return F.arrow_udf(run, "double")(stats)


def fit(stats: DataFrame, labels: DataFrame, trees: int = 64, subsample: int = 256, max_fit_rows: int = 20_000,
        keep_good: float = 0.998, seed: int = 7) -> QualityModel:
    """Grow the forest from at most ``max_fit_rows`` rows labelled good (those with the smallest id hashes; every
    tree draws ``subsample`` of them) and calibrate the threshold on all labelled rows: the smallest score that keeps
    a share of ``keep_good`` of the good rows, moved up to the middle of the gap before the next bad row.

    ``stats``: doc_id and the struct ``quality``. ``labels``: doc_id, quality 0/1.
    """
    best = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("good"))
    rows = stats.where(~base_failed("quality")).join(best, "doc_id")
    rates = [F.col(f"quality.{c}").alias(c) for c in RATES]
    good = bounded_sample(rows.where("good = 1"), max_fit_rows).select(*rates).collect()
    if not good:
        return QualityModel(None, 1.0)
    x = scaled(np.array(sorted(map(tuple, good)), dtype=float))
    model = QualityModel(grow_forest(x, trees, subsample, seed), 1.0)
    bins = (rows.select("good", F.round(scored(F.col("quality"), model), 3).alias("at"))
            .groupBy("at").agg(F.sum("good").alias("good"), F.sum(1 - F.col("good")).alias("bad")).orderBy("at").collect())
    n_good = sum(b["good"] for b in bins)
    kept, last = 0, bins[-1]["at"]
    for i, b in enumerate(bins):
        kept += b["good"]
        if kept >= keep_good * n_good:
            last = b["at"]
            for later in bins[i + 1:]:
                if later["bad"]:
                    last = (last + later["at"]) / 2
                    break
                last = later["at"]
            break
    model.threshold = float(last) + 0.0005
    return model


def judge(docs: DataFrame, model: QualityModel, text: str = "text", out: str = "quality") -> DataFrame:
    """Add the struct ``out``: counts, rates, ``score``, ``base_failed`` and ``kept``. One pass, no shuffle."""
    narrow_batches(docs.sparkSession)
    stats = docs.withColumn(out, rule_statistics(null_to_empty(text)))
    return with_verdict(stats, model, out)


def with_verdict(stats: DataFrame, model: QualityModel, out: str = "quality") -> DataFrame:
    score = scored(F.col(out), model) if model.forest else F.lit(0.0)
    return (stats.withColumn(out, F.col(out).withField("score", score).withField("base_failed", base_failed(out)))
            .withColumn(out, F.col(out).withField("kept", ~F.col(f"{out}.base_failed") & (F.col(f"{out}.score") <= model.threshold))))


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and statistics of every document, written once: fitting and judging read it without the texts."""
    narrow_batches(docs.sparkSession)
    return materialise(docs.select("doc_id", rule_statistics(null_to_empty()).alias("quality")), "quality_stats")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = document_statistics(read(spark, sf_dir, "documents"))
    model = fit(stats, read(spark, sf_dir, "labels"))
    return with_verdict(stats, model).select(
        "doc_id", *[F.col(f"quality.{c}").alias(c) for c in COUNTS], F.col("quality.base_failed").alias("base_failed"),
        F.col("quality.kept").alias("kept"), F.col("quality.score").alias("score"))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, with their columns as they came."""
    columns = docs.columns
    stats = document_statistics(docs)
    model = fit(stats, read(spark, sf_dir, "labels"))
    return judge(docs, model, out="__quality").where("__quality.kept").select(*columns)
