import base64
import hashlib

import tiktoken
from public_tokenizers import PATTERN, path

import corpus_pipeline
from conftest import SF001
from helpers import near_classes
from nextclick.llm import bpe
from nextclick.llm.common import materialise


def test_each_stage_takes_effect(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, seen = docs.columns, {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "pii", "cube_mix", "byte_level_bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, SF001), f"test_{name}")
        assert docs.columns == columns
        seen[name] = docs.toPandas().sort_values("doc_id").reset_index(drop=True)
    before, after = seen["quality_rules"], seen["ngram_jaccard_join"]
    _, classes = near_classes(list(before.text))
    assert list(after.doc_id) == sorted({before.doc_id[c] for c in classes})
    assert len(seen["pii"]) == len(after) and not seen["pii"].text.str.contains("@mail").any()
    mixed = seen["cube_mix"]
    assert set(mixed.doc_id) <= set(after.doc_id) and mixed.doc_id.value_counts().max() <= 3

    with open(path(bpe.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = sorted((int(d), len(ids := plain.encode_ordinary(t)), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                      for d, t in zip(mixed.doc_id, mixed.text, strict=True))
    got = corpus_pipeline.run(spark, SF001).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in got) == expected
