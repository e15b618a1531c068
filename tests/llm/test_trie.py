import random
import zlib

import pytest

from conftest import SF001
from helpers import frame, sha, written
from nextclick.llm import trie
from oracle_harness import compare, duck

DDL = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for path, members in nodes.items():
        below = {p: m for p, m in nodes.items() if p[: len(path)] == path}
        children = {p for p in below if len(p) == len(path) + 1}
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below)
        saved = sum((len(m) - 1) * len(p[-1][1]) for p, m in below.items() if p)
        ends = ",".join(map(str, sorted(c for c in members if len(full[c]) == len(path))))
        out.add((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(children), leaves, saved, sha(ends)))
    assert len(out) == len(nodes)
    return out


def made(seed, n, hot=False):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(400), n):
        for t in range(rng.randrange(1, 9)):
            text = "hello" if hot and t == 0 else rng.choice(["", "a", "bb", "é\n", None])
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]) if not hot else "user", text))
    return rows


@pytest.mark.parametrize("bounds", [{}, {"shard_rows": 5, "held": 3}, {"shard_rows": 1, "tops": 10**9, "held": 1}])
def test_against_brute_force(spark, bounds):
    for rows in (made(1, 60), made(2, 120, hot=True) + [(None, 1, "user", "x")] * 3 + [(777, 1, "user", "same")] * 4):
        turns = trie.with_shared_heads(frame(spark, rows, DDL))
        got = trie.prefix_trie(turns, **bounds).collect()
        assert {tuple(r) for r in got} == brute(rows)
        assert len(got) == len({tuple(r) for r in got})


def test_conversation_over_many_partitions(spark):
    """One conversation holds most rows: its turns are numbered and hashed over several partitions."""
    rows = [(5, t, "user", f"w{t % 7}") for t in range(160)] + [(6, t, "user", f"w{t % 7}") for t in range(90)] + made(3, 20)
    rows = [r for r in rows if r[0] not in (5, 6) or (r[3] or "").startswith("w")]
    got = trie.prefix_trie(trie.with_shared_heads(frame(spark, rows, DDL)), shard_rows=50, held=20).collect()
    assert {tuple(r) for r in got} == brute(rows)


def test_query_against_sql(spark):
    assert compare(spark, duck(SF001), "op11_prefix_trie", trie.op11_prefix_trie, trie.OP11_SQL, SF001)


def test_clashing_columns_long_texts_and_empty_table(spark, tmp_path):
    rows = [(1, 1, "user", "x" * 300_000), (2, 1, "user", "x" * 300_000), (1, 2, "user", "y")]
    table = frame(spark, [(*r, 1, 2, 3) for r in rows], DDL + ", depth int, k1 int, n_convs int")
    assert {tuple(r) for r in trie.op11_prefix_trie(spark, written(spark, tmp_path, "conversations", table)).collect()} == brute(rows)
    empty = frame(spark, [], DDL)
    assert trie.op11_prefix_trie(spark, written(spark, tmp_path / "e", "conversations", empty)).count() == 0


def test_queue_spills_and_merges():
    rng = random.Random(4)
    queue = trie.SpillingQueue(held=3, runs=2)
    items = [((rng.randrange(20),), rng.randrange(9)) for _ in range(300)]
    for item in items:
        queue.push(item)
    got = {(k,): sorted(x[1] for x in queue.pop_at((k,))) for k in range(20)}
    assert got == {(k,): sorted(v for (q,), v in items if q == k) for k in range(20)}
    assert queue.spills > 2
