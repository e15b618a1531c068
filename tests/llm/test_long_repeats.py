import random

import numpy as np
import pytest

from conftest import SF001
from helpers import frame, removed_repeats
from nextclick.llm import long_repeats
from nextclick.llm.common import materialise, row_keyed
from oracle_harness import compare, duck


def texts():
    rng = random.Random(5)
    words = ["ab", "cde", "f", "xyz ", " q", "é", "aaaa", "ba"]
    draw = lambda n: "".join(rng.choice(words) for _ in range(n))
    shared = [draw(30) for _ in range(12)]
    out = [None, "", "a" * 500, "ab" * 100]
    for _ in range(120):
        out.append("".join(rng.choice([rng.choice(shared), rng.choice(shared)[3:40], draw(25)]) for _ in range(rng.randint(1, 5))))
    return out + out[4:8]


@pytest.mark.parametrize("length, prefix, hot, batches", [(40, 8, 50_000, 4), (64, 16, 50_000, 1), (40, 8, 3, 3)])
def test_against_all_windows(spark, length, prefix, hot, batches):
    docs = materialise(row_keyed(frame(spark, [(i, t, "x") for i, t in enumerate(texts())], "doc_id long, text string, at string")), "repeats")
    rows = long_repeats.remove_repeats(docs, batches, length, prefix, hot).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert got == dict(enumerate(removed_repeats(texts(), length)))
    assert long_repeats.remove_repeats(docs.limit(0), 2).count() == 0


def test_query_against_sql_and_all_windows(spark):
    assert compare(spark, duck(SF001), "op7", long_repeats.op7_suffix_dedup, long_repeats.OP7_SQL, SF001)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").toPandas()
    got = long_repeats.op7_suffix_dedup(spark, SF001).toPandas().set_index("doc_id").loc[docs.doc_id]
    expected = removed_repeats(list(docs.text), long_repeats.LENGTH)
    assert [tuple(r) for r in got[["n_bytes", "n_removed", "n_spans", "kept_sha256"]].itertuples(index=False)] == expected


def test_every_window_has_an_anchor(monkeypatch):
    monkeypatch.setattr(long_repeats, "STEP", 100)
    data = np.random.default_rng(1).integers(97, 101, 1500, dtype=np.uint8)
    at, h = long_repeats.anchors(data, 40, 8)
    monkeypatch.undo()
    whole = long_repeats.anchors(data, 40, 8)
    assert at.tolist() == whole[0].tolist() and h.tolist() == whole[1].tolist()
    for p in range(len(data) - 39):
        assert ((at >= p) & (at <= p + 32)).any()


def test_levels_merge_geometrically(spark):
    family = long_repeats.SuffixFamily()
    sizes = []
    for b in range(5):
        again = family.add(spark.createDataFrame([(10 * b + i,) for i in range(4)] + [(1,)], "prefix long"))
        sizes.append(sorted(family.levels))
        assert [r.prefix for r in again.collect()] == [1]
    assert sizes == [[0], [1], [0, 1], [2], [0, 2]]
