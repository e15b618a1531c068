import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import SF001
from helpers import frame, written
from nextclick.llm import ngram_lm
from nextclick.llm.common import read


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low:
        if c in " \t\n\v\f\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    return words + [word] * bool(word) + ["\n"]


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def plain_discounts(counts):
    n = [sum(c == k for c in counts) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0
    out = [0.0]
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0
        out.append(d if n[k - 1] and 0 < d < k else k / 2)
    return out


class Plain:
    """Interpolated modified Kneser-Ney, from its definition."""

    def __init__(self, texts):
        said = [tokens(t) for t in texts]
        self.words = Counter(w for s in said for w in s)
        self.pairs = Counter(p for s in said for p in zip(["\n\n", *s], s))
        self.left = Counter()
        for (v, _), c in self.pairs.items():
            self.left[v] += c
        self.before = Counter(w for _, w in self.pairs)
        self.pair_d = plain_discounts(self.pairs.values())
        self.word_d = plain_discounts(self.before.values())

    def lower(self, w):
        uniform = 1 / (len(self.words) + 1)
        if not self.pairs:
            return uniform
        spare = sum(self.word_d[min(c, 3)] for c in self.before.values()) / len(self.pairs)
        c = self.before[w]
        return (c - self.word_d[min(c, 3)]) / len(self.pairs) + spare * uniform

    def p(self, v, w):
        if not self.left[v]:
            return self.lower(w)
        c = self.pairs[v, w]
        rest = sum(self.pair_d[min(n, 3)] for (a, _), n in self.pairs.items() if a == v)
        return (c - self.pair_d[min(c, 3)] + rest * self.lower(w)) / self.left[v]

    def row(self, doc_id, text):
        said, n, v = tokens(text), sum(self.words.values()), len(self.words)
        return (doc_id, is_held_out(doc_id), len(said), sum(self.words[w] > 0 for w in said), n,
                sum(math.log10((self.words[w] + 1) / (n + v + 1)) for w in said), sum(math.log10(self.p(a, w)) for a, w in zip(["\n\n", *said], said)))


def check(got, rows):
    model = Plain([t for d, t in rows if not is_held_out(d)])
    want = sorted((model.row(d, t) for d, t in rows), key=str)
    got = sorted((tuple(r) for r in got), key=str)
    assert [g[:5] for g in sorted(got, key=lambda r: (str(r[0]), r[2:4]))] == [w[:5] for w in sorted(want, key=lambda r: (str(r[0]), r[2:4]))]
    for k in (5, 6):
        assert np.allclose(sorted(g[k] for g in got), sorted(w[k] for w in want), rtol=1e-9)
    by = {(w[0], w[2]): w for w in want}
    assert all(math.isclose(g[6], by[g[0], g[2]][6], rel_tol=1e-9) for g in got if sum(r[0] == g[0] for r in rows) == 1)
    return model


def some_rows(n=80, seed=3):
    rng = random.Random(seed)
    words = ["the"] * 30 + [f"w{i}" for i in range(40)] + ["É", "é", "The", "x y"]
    rows = [(i, rng.choice([" ", "\n", "\t "]).join(rng.choice(words) for _ in range(rng.randrange(30)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (None, "the w1"), (5, rows[5][1]), (n + 2, "unseen words only"), (n + 3, "w1 " * 4000)]


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 20, 1 / 1024), (600, 900, 0.05), (3000, 400, 1 / 50)])
def test_against_the_definition(spark, sizes):
    rows = some_rows()
    docs = frame(spark, rows, "doc_id long, text string")
    block, shard, heavy = sizes
    check(ngram_lm.kneser_ney_scores(docs, ~ngram_lm.held_out(), block, shard, heavy).collect(), rows)


def test_probabilities_sum_to_one():
    model = Plain([t for _, t in some_rows()])
    for v in ("the", "\n\n", "w3", "never"):
        assert math.isclose(sum(model.p(v, w) for w in [*model.words, "<unknown>"]), 1)


def test_frequent_words_hold_half_the_share(spark):
    rows = [(i, "the " * 40 + f"a{i} b{i} c{i % 3}") for i in range(200)]
    words, size = ngram_lm.frequent_words(frame(spark, rows, "doc_id long, text string").select("text"), 0.01)
    hashes = {ngram_lm.xxhash.xxh3_64_intdigest(w) for w in (b"the", b"c0", b"c1", b"c2")}
    assert ngram_lm.xxhash.xxh3_64_intdigest(b"the") in words.tolist() and set(words.tolist()) <= hashes
    assert size == sum(len(t) for _, t in rows)


def test_packed_arrays():
    values = np.array([0, 1, 255, 256, (1 << 48) - 1], np.uint64)
    assert (ngram_lm.unpack(ngram_lm.pack(values, 6), 6) == values).all() and (ngram_lm.unpack(ngram_lm.pack(values)) == values).all()
    assert len(ngram_lm.unpack(ngram_lm.pack(values[:0]))) == 0


def test_query_on_the_table(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SF001, "documents").collect()]
    got = ngram_lm.op12_kneser_ney(spark, SF001).collect()
    assert len(got) == len(docs)
    model = Plain([t for d, t in docs if not is_held_out(d)])
    texts = dict(docs)
    for r in sorted(got, key=lambda r: r.n_tokens)[:60]:
        want = model.row(r.doc_id, texts[r.doc_id])
        assert tuple(r)[:5] == want[:5] and np.allclose(tuple(r)[5:], want[5:], rtol=1e-9)
    fresh = [r for r in got if r.held_out]
    assert fresh and sum(r.score for r in fresh) > sum(r.base_score for r in fresh)


def test_no_training_texts_clashing_columns_and_empty_table(spark, tmp_path):
    only = [i for i in range(200) if is_held_out(i)][:3]
    docs = frame(spark, [(i, "a b", "x", 0.5) for i in only], "doc_id long, text string, block string, score double")
    for r in ngram_lm.op12_kneser_ney(spark, written(spark, tmp_path, "documents", docs)).collect():
        assert tuple(r) == (r.doc_id, True, 3, 0, 0, 0.0, 0.0)
    empty = ngram_lm.op12_kneser_ney(spark, written(spark, tmp_path / "e", "documents", docs.limit(0)))
    assert empty.count() == 0
