"""Registered queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nextclick.llm import bpe, chat, fingerprints, long_repeats, mixing, ngram_join, ngram_lm, pii, quality, runs, toxicity, trie, web_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_main_text": web_text.op1_html_main_text,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_edit_fingerprints": fingerprints.op3_edit_fingerprints,
    "op4_byte_level_bpe": bpe.op4_byte_level_bpe,
    "op5_chat_format": chat.op5_chat_format,
    "op6_ngram_jaccard_join": ngram_join.op6_ngram_jaccard_join,
    "op7_suffix_dedup": long_repeats.op7_suffix_dedup,
    "op8_cube_mix": mixing.op8_cube_mix,
    "op9_pii": pii.op9_pii,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_prefix_trie": trie.op11_prefix_trie,
    "op12_kneser_ney": ngram_lm.op12_kneser_ney,
    "op13_periodic_runs": runs.op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    "op5_chat_format": chat.OP5_SQL,
    "op6_ngram_jaccard_join": ngram_join.OP6_SQL,
    "op7_suffix_dedup": long_repeats.OP7_SQL,
    "op11_prefix_trie": trie.OP11_SQL,
}
