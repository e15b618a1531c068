import hashlib
import random

import numpy as np

from helpers import frame, written
from nextclick.llm import fingerprints as fp


def plain_walk(text):
    """Time of arrival at each character, one step at a time."""
    waits, mask, t, out = fp.waits(), (1 << fp._TIMES) - 1, 0, []
    for x in fp._points(text):
        out.append(t)
        kind = int((int(x) * 2_654_435_761 % 2**32) >> 26) << fp._TIMES
        t += int(waits[kind | (t & mask)])
    return out + [t]


def test_walk_one_step_at_a_time():
    random.seed(2)
    texts = sorted(("".join(random.choice("abcé 😀\n") for _ in range(n)) for n in (900, 340, 340, 17, 1)), key=len, reverse=True)
    for text, times in zip(texts, fp._walk([fp._points(t) for t in texts]), strict=True):
        assert times.tolist() == plain_walk(text)


def test_waits_are_random_bits():
    assert 1.9 < fp.waits().mean() < 2.1 and fp.waits().min() == 1


def test_likeness_follows_edits():
    random.seed(3)
    text = " ".join("".join(random.choice("abcdefghij") for _ in range(6)) for _ in range(600))
    last = 1.0
    for edits in (0, 60, 2000):
        changed = list(text)
        for _ in range(edits):
            changed[random.randrange(len(changed))] = random.choice(["", "x", "yz"])
        now = fp.likeness(*fp.embed([text, "".join(changed)]))
        assert now < last or edits == 0 and now == 1.0
        last = now
    other = " ".join("".join(random.choice("abcdefghij") for _ in range(6)) for _ in range(600))
    assert fp.likeness(*fp.embed([text, other])) < 0.1 and fp.embed([text]) == fp.embed([other, text, ""])[1:2]


def test_successors_and_edits(spark, tmp_path):
    random.seed(5)
    ids = random.sample(range(1000), 60) + [None]
    texts = {i: "".join(random.choice("abc é") for _ in range(random.choice([0, 1, 2, 5, 400]))) for i in ids}
    docs = frame(spark, [(i, t or None, "z") for i, t in texts.items()], "doc_id long, text string, fingerprint string", 5)
    got = {r.doc_id: r for r in fp.op3_edit_fingerprints(spark, written(spark, tmp_path, "documents", docs)).collect()}
    order = sorted((i for i in ids if i is not None), reverse=True) + [None]
    assert len(got) == len(ids)
    for k, i in enumerate(order):
        follow = texts[order[(k + 1) % len(order)]]
        n = len(texts[i]) // 3
        edited = texts[i][: len(texts[i]) - n] + follow[:n]
        assert got[i].n_chars == len(texts[i]) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, changed, other = fp.embed([texts[i], edited, follow])
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (own, changed)
        assert np.isclose(got[i].near_edited, fp.likeness(own, changed)) and np.isclose(got[i].near_next, fp.likeness(own, other))


def test_one_row_repeated_ids_and_none(spark):
    one = frame(spark, [(5, "abcdef")], "doc_id long, text string")
    row = fp.compare_with_edits(one).collect()
    assert len(row) == 1 and row[0].near_next == 1.0 and row[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert fp.compare_with_edits(frame(spark, [(1, "a")] * 4 + [(2, "b")] * 3, "doc_id long, text string")).count() == 7
    assert fp.compare_with_edits(one.limit(0)).count() == 0


def test_near_classes(spark):
    random.seed(7)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(300)]
    docs = [(i, " ".join([*base[:140 + i], "q" * len(base[140 + i]), *base[141 + i:]])) for i in range(12)] + [(100, " ".join(base)), (101, " ".join(base))]
    docs += [(200 + i, " ".join(word() for _ in range(300))) for i in range(5)] + [(300, ""), (301, None)]
    out = {r.doc_id: r.class_id for r in fp.near_classes(frame(spark, docs, "doc_id long, text string"), block=4).collect()}
    assert {out[i] for i in [*range(12), 100, 101]} == {0} and all(out[200 + i] == 200 + i for i in range(5))
    assert out[300] == out[301] == 300
