"""Training-corpus pipeline: quality rules, near-duplicate removal, redaction of personal data, mixing, tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nextclick.llm import bpe, mixing, ngram_join, pii, quality
from nextclick.llm.common import materialise, read

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality.quality_stage),
    ("ngram_jaccard_join", ngram_join.near_duplicates_stage),
    ("pii", pii.pii_stage),
    ("cube_mix", mixing.mixing_stage),
    ("byte_level_bpe", bpe.bpe_stage),
]

#: The stages fit models and hash shingles, which SQL cannot express; tests hold the pipeline against its parts.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each one's result is written and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
