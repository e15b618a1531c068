import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import WORD, frame, sha, written
from nextclick.llm import runs
from nextclick.llm.common import read


def brute_runs(words):
    """All (start, length, period): for each period the longest stretches of equal words that far apart, smallest period only."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(all(words[k] == words[k + d] for k in range(i, i + length - d)) for d in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_lyndon(ranks):
    out = []
    for i in range(len(ranks)):
        j = i + 1
        while j < len(ranks) and ranks[j:] > ranks[i:]:
            j += 1
        out.append(j - i)
    return out


def changed(doc_id, words):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text, plant=True):
    words = WORD.findall(text or "")
    words = changed(doc_id, words) if plant else words
    found = brute_runs(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return (len(found), *best, 1000 * best[1] // best[2] if found else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


words_of_few = st.lists(st.integers(0, 2), max_size=40)


@settings(max_examples=300, deadline=None)
@given(words_of_few)
def test_phase_one_gives_lyndon_arrays(words):
    kinds = sorted(set(words))
    ranks = [kinds.index(w) for w in words]
    assert runs.lyndon_array(ranks) == brute_lyndon(ranks)


@settings(max_examples=200, deadline=None)
@given(st.lists(words_of_few, max_size=4), st.booleans())
def test_runs_against_brute_force(texts, cut):
    numbers = [np.array(t, np.int64) + 10 * i for i, t in enumerate(texts)]
    assert runs.find_runs(numbers, cut) == [brute_runs(t) for t in texts]


def test_runs_of_longer_texts_with_and_without_cutting():
    rng = random.Random(1)
    texts = []
    for i in range(60):
        t = [rng.randrange(30) for _ in range(rng.randrange(200))]
        for _ in range(rng.randrange(4)):
            unit = [rng.randrange(5) for _ in range(rng.randrange(1, 9))]
            at = rng.randrange(len(t) + 1)
            t[at:at] = (unit * 9)[: rng.randrange(3 * len(unit), 8 * len(unit) + 1)]
        texts.append(np.array(t, np.int64) + 100 * i)
    want = [brute_runs(t.tolist()) for t in texts]
    assert sum(map(len, want)) > 40
    assert runs.find_runs(texts) == runs.find_runs(texts, cut=False) == want


@pytest.mark.parametrize("unit, times", [("a", 100_000), ("a b", 50_000), ("the cat sat on a mat ", 20_000)])
def test_very_long_text(unit, times):
    n = len(unit.split()) * times
    (row,) = runs._results([None], [f"x {(unit + ' ') * times} y"], False, True)
    assert row[:4] == (1, 1, n, len(unit.split()))
    assert row[6] == hashlib.sha256(f"x {' '.join(unit.split())} y".encode()).hexdigest()


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(7)
    texts = [None, "", " \n", "a a a a a a", "a b", "é é é é é é x"] + [
        " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(90))) for _ in range(150)]
    rows = [(i, t, i, "x") for i, t in enumerate(texts)] + [(None, "b b b b b b b", 0, None), (3, "a a a a a a", 3, "x")]
    docs = frame(spark, rows, "doc_id long, text string, n_runs int, words string")
    got = runs.op13_periodic_runs(spark, written(spark, tmp_path, "documents", docs)).collect()
    assert len(got) == len(rows)
    want = {d: (d, *expected(d, t)) for d, t, *_ in rows}
    for r in got:
        assert tuple(r) == want[r.doc_id]
    assert sum(r.n_runs > 0 for r in got) > 10
    plain = {r.doc_id: tuple(r) for r in runs.periodic_runs(docs).collect()}
    assert plain == {d: (d, *expected(d, t, plant=False)) for d, t, *_ in rows}


def test_query_on_the_table(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    short = {r.doc_id: r.text for r in docs.collect() if len(r.text or "") < 2_000}
    got = {r.doc_id: tuple(r) for r in runs.op13_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == docs.count() and len(short) > 50
    assert all(got[d] == (d, *expected(d, t)) for d, t in short.items())


def test_empty_table(spark, tmp_path):
    docs = frame(spark, [], "doc_id long, text string")
    out = runs.op13_periodic_runs(spark, written(spark, tmp_path, "documents", docs))
    assert out.count() == 0 and out.columns[:2] == ["doc_id", "n_runs"]
