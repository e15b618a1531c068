"""Exact removal of long repeats with a family of anchored suffix levels.

A byte goes if it lies in a string of ``length`` bytes that starts anywhere else too. Suffixes are taken at *anchors*: of every
window of ``length`` bytes, the places where the hash of the next ``PREFIX`` bytes is least. Anchors depend on the window's bytes
only, so two equal windows have theirs at the same offset, and one suffix in about 170 is enough for all windows.

A window that passes an anchor covers more than half of what lies on one of its sides: from the anchor ``length - half`` bytes to the right,
or ``half + 1`` bytes to the left of it and its prefix (``half`` is half of ``length - PREFIX``). The hashes of these two stretches are the
anchor's *keys*, one per side; only a key that occurs again can belong to a repeated window, however often the short prefix occurs.

Documents come in batches. A batch's keys in order are merge-scanned against every level of the family for keys that occur again, then
join the family, where levels of equal size merge, so that b batches lie in at most log2(b) + 1 levels. Anchors with a repeated
key are then compared over the bytes that a window on the key's side can reach, which gives the exact reach of their repeats to the
left and the right. Windows are compared by 64-bit rolling hashes within a key, contexts by 128-bit digests.

Copies go on once: of equal texts all bytes go, and one of them stands for all as a partner; of equal contexts only one
is compared. A group with very many different contexts is compared through distributed window hashes instead of in one task. All
decisions are made on the input.

Defined cases: a null or empty text has no bytes; texts shorter than ``length`` lose nothing; a text of any length is read whole, in
steps; equal rows are copies of each other; ids may be null or repeated; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nextclick.llm.common import file_keyed, fresh, materialise, narrow_batches, null_to_empty, read

LENGTH, PREFIX = 400, 64
#: Bytes of a text that are looked at together when anchors are chosen.
STEP = 1 << 20
#: Contexts compared together, and contexts of one prefix beyond which they are compared through window hashes.
TOGETHER, HOT_GROUP = 4_096, 50_000

_rng = np.random.default_rng(400)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64)
_FOLD = _rng.integers(0, 2**62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _spread(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each window of ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        values = pick(values[:-have], values[have:])
        have *= 2
    return values if have == width else pick(values[: len(values) - (width - have)], values[width - have:])


def _prefix_hashes(data: np.ndarray, prefix: int) -> np.ndarray:
    """Hash of each ``prefix`` (a power of two) bytes."""
    h, have, k = _BYTE[data], 1, 0
    while have < prefix:
        h = h[:-have] * _FOLD[k] + h[have:]
        have, k = 2 * have, k + 1
    h ^= h >> np.uint64(29)
    h *= _BASE
    return h ^ (h >> np.uint64(32))


def anchors(data: np.ndarray, length: int = LENGTH, prefix: int = PREFIX) -> tuple[np.ndarray, np.ndarray]:
    """Positions and prefix hashes of the anchors of all windows of a text."""
    width = length - prefix + 1
    at, hashes = [], []
    for start in range(0, max(len(data) - length + 1, 0), STEP):
        h = _prefix_hashes(data[start: start + STEP + length - 1], prefix)
        least = _spread(h, width, np.minimum)
        edge = np.zeros(width - 1, dtype=np.uint64)
        chosen = np.flatnonzero(h == _spread(np.concatenate([edge, least, edge]), width, np.maximum))
        at.append(chosen + start)
        hashes.append(h[chosen])
    if not at:
        return np.array([], np.int64), np.array([], np.uint64)
    where, first = np.unique(np.concatenate(at), return_index=True)
    return where, np.concatenate(hashes)[first]


def _half(length: int, prefix: int) -> int:
    """Windows that start at most so far before their anchor belong to its right key, the others to its left key."""
    return (length - prefix) // 2


def anchor_keys(raw: bytes, length: int = LENGTH, prefix: int = PREFIX) -> tuple[list[int], list[int]]:
    """Positions and keys of a text's anchors, a position twice if it has both keys. Keys of the left are negative."""
    half = _half(length, prefix)
    right, left = length - half, half + 1
    digest = xxhash.xxh3_64_intdigest
    where, keys = [], []
    for at in anchors(np.frombuffer(raw, np.uint8), length, prefix)[0].tolist():
        if at + right <= len(raw):
            where.append(at)
            keys.append(digest(raw[at: at + right]) >> 1)
        if at >= left:
            where.append(at)
            keys.append((digest(raw[at - left: at + prefix]) >> 1) - 2**63)
    return where, keys


def suffixes(keyed: DataFrame, length: int, prefix: int) -> DataFrame:
    """row_key, doc_id, n_bytes, digest (sha256) and the anchors (position, key) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, places, hashes = [], [], [], []
            for text in batch.column("text").to_pylist():
                raw = text.encode()
                at, keys = anchor_keys(raw, length, prefix)
                sizes.append(len(raw))
                digests.append(hashlib.sha256(raw).hexdigest())
                places.append(at)
                hashes.append(keys)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(places, pa.list_(pa.int64())), pa.array(hashes, pa.list_(pa.int64()))],
                names=["row_key", "doc_id", "n_bytes", "digest", "at", "key"])

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"row_key bigint, doc_id {kind}, n_bytes bigint, digest string, at array<bigint>, key array<bigint>")


class SuffixFamily:
    """Levels of keys (column ``key``) in order; level i holds 2**i batches. ``add`` returns the keys of a batch that occur again, in it or in the family."""

    def __init__(self, key: str = "prefix") -> None:
        self.key = key
        self.levels: dict[int, DataFrame] = {}

    def add(self, batch: DataFrame, last: bool = False) -> DataFrame:
        key = self.key
        array = materialise(batch.groupBy(key).agg(F.count("*").alias("n")).sortWithinPartitions(key), "suffix_array")
        again = array.where("n > 1").select(key)
        for level in self.levels.values():
            again = again.union(level.select(key).join(array.select(key), key))
        again = materialise(again.distinct(), "suffix_matches")
        if not last:
            size, merged = 0, array.select(key)
            while size in self.levels:
                merged = materialise(merged.union(self.levels.pop(size)).distinct().sortWithinPartitions(key), "suffix_level")
                size += 1
            self.levels[size] = merged
        return again


def _cut(raw: bytes, at: int, key: int, length: int, prefix: int) -> tuple[bytes, int]:
    """Bytes that windows of the key's side can reach, and how many of them are before the anchor."""
    half = _half(length, prefix)
    before, after = (half, length) if key >= 0 else (length - prefix, length - half - 1)
    left = min(at, before)
    return raw[at - left: at + after], left


_MARK = [("row_key", "bigint", pa.int64()), ("at", "bigint", pa.int64()), ("key", "bigint", pa.int64()), ("context_id", "binary", pa.binary()),
         ("n", "bigint", pa.int64()), ("left", "int", pa.int32()), ("right", "int", pa.int32()), ("context", "binary", pa.binary())]
_CONTEXT = ["key", "context_id", "n", "left", "right", "context"]


def contexts(hit: DataFrame, length: int, prefix: int) -> DataFrame:
    """The candidate anchors with the digest of their context. The first of equal ones in a batch has the context itself and
    their number; the others have nulls there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[list] = []
            first: dict[tuple[int, bytes], list] = {}
            for row, text, at, keys in zip(*(batch.column(c).to_pylist() for c in ("row_key", "text", "at", "key")), strict=True):
                raw = text.encode()
                for where, key in zip(at, keys, strict=True):
                    context, left = _cut(raw, where, key, length, prefix)
                    name = xxhash.xxh3_128_digest(context + left.to_bytes(4, "little"))
                    have = first.get((key, name))
                    if have is None:
                        first[key, name] = mark = [row, where, key, name, 1, left, len(context) - left, context]
                    else:
                        have[4] += 1
                        mark = [row, where, key, name, None, None, None, None]
                    rows.append(mark)
            columns = list(zip(*rows, strict=True)) or [()] * len(_MARK)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, _, t) in zip(columns, _MARK, strict=True)], names=[m[0] for m in _MARK])

    return hit.select("row_key", "text", "at", "key").mapInArrow(run, ", ".join(f"{m[0]} {m[1]}" for m in _MARK))


def window_hashes(table: np.ndarray, length: int) -> Iterator[np.ndarray]:
    """``table``: one row per byte place, one column per context. Hashes of the windows that start at place 0, 1, ..."""
    top = np.uint64(pow(int(_BASE), length - 1, 2**64))
    h = np.zeros(table.shape[1], dtype=np.uint64)
    for row in table[:length]:
        h = h * _BASE + _BYTE[row]
    yield h
    for out, come in zip(table, table[length:], strict=False):
        h = (h - _BYTE[out] * top) * _BASE + _BYTE[come]
        yield h


def reaches(rows: list[tuple], length: int) -> tuple[np.ndarray, np.ndarray]:
    """For contexts (group, n, left, right, bytes): how far repeats that pass the anchor reach to the left and the right (-1: none)."""
    group = np.array([r[0] for r in rows], dtype=np.uint64)
    n, left, right = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
    before = int(left.max())
    table = np.zeros((max(before + int(right.max()), length), len(rows)), dtype=np.uint8)
    for j, (_, _, a, b, context) in enumerate(rows):
        table[before - a: before + b, j] = np.frombuffer(context, np.uint8)
    mixed = group * _FOLD[0]
    to_left, to_right = np.full(len(rows), -1), np.full(len(rows), -1)
    for start, h in enumerate(window_hashes(table, length)):
        offset = before - start
        valid = np.flatnonzero((left >= offset) & (right >= length - offset))
        if not len(valid):
            continue
        key = h[valid] ^ mixed[valid]
        order = np.argsort(key)
        ranked = key[order]
        equal = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(valid), dtype=bool)
        twice[order[1:]] |= equal
        twice[order[:-1]] |= equal
        there = valid[twice | (n[valid] > 1)]
        to_left[there] = np.maximum(to_left[there], offset)
        to_right[there] = np.maximum(to_right[there], length - offset)
    return to_left, to_right


_REACH = "key bigint, context_id binary, to_left int, to_right int"


def _reach_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, [pa.int64(), pa.binary(), pa.int32(), pa.int32()], strict=True)],
                                      names=["key", "context_id", "to_left", "to_right"])


def compare(found: DataFrame, length: int) -> DataFrame:
    """Reach of each context among those of its key. Whole groups are compared together, some thousand contexts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool: list[list] = []
        group: list[list] = []

        def finish() -> Iterator[pa.RecordBatch]:
            if pool:
                left, right = reaches([(p[6], p[2], p[3], p[4], p[5]) for p in pool], length)
                yield _reach_batch([(p[0], p[1], int(a), int(b)) for p, a, b in zip(pool, left, right, strict=True) if a >= 0])
                pool.clear()

        number = 0
        alone: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if group and group[-1][0] == row[0]:
                    if group[-1][1] == row[1]:
                        group[-1][2] += row[2]
                        continue
                else:
                    _close(group, pool, alone, number, length)
                    number += 1
                    group = []
                    if len(pool) >= TOGETHER:
                        yield from finish()
                group.append(list(row))
            yield _reach_batch(alone)
            alone = []
        _close(group, pool, alone, number, length)
        yield from finish()
        yield _reach_batch(alone)

    return found.repartition("key").sortWithinPartitions("key", "context_id").mapInArrow(run, _REACH)


def _close(group: list[list], pool: list[list], alone: list[tuple], number: int, length: int) -> None:
    """A group of one context is decided by its count; others wait to be compared."""
    if len(group) == 1:
        p = group[0]
        if p[2] > 1 and p[3] + p[4] >= length:
            alone.append((p[0], p[1], p[3], p[4]))
    else:
        pool.extend([*p, number] for p in group)


def compare_spread(found: DataFrame, length: int, prefix: int) -> DataFrame:
    """The same for groups of any size: windows meet by their hash, in sums that need no group in one place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = length - prefix
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                name, context_id, n, left, right, context = row
                table = np.zeros((before + length, 1), dtype=np.uint8)
                table[before - left: before + right, 0] = np.frombuffer(context, np.uint8)
                hashes = np.array([int(h[0]) for h in window_hashes(table, length)], dtype=np.uint64).view(np.int64)
                offsets = before - np.arange(len(hashes))
                ok = (left >= offsets) & (right >= length - offsets)
                k = int(ok.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * k, pa.int64()), pa.array([context_id] * k, pa.binary()), pa.array([n] * k, pa.int64()),
                     pa.array(offsets[ok].astype(np.int32)), pa.array(hashes[ok])], names=["key", "context_id", "n", "offset", "window"])

    windows = found.mapInArrow(run, "key bigint, context_id binary, n bigint, offset int, window bigint")
    twice = windows.groupBy("key", "offset", "window").agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    return windows.join(twice, ["key", "offset", "window"]).groupBy("key", "context_id").agg(
        F.max("offset").alias("to_left"), (F.lit(length) - F.min("offset")).cast("int").alias("to_right"))


def _apply(hit: DataFrame) -> DataFrame:
    """row_key, n_removed, n_spans, kept_sha256 from texts and their repeats (start, end)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, digests = [], [], []
            for text, repeats in zip(batch.column("text").to_pylist(), batch.column("repeats").to_pylist(), strict=True):
                raw = text.encode()
                kept, upto, n = hashlib.sha256(), 0, 0
                count = 0
                for r in sorted(repeats, key=lambda r: (r["start"], -r["end"])):
                    if r["start"] > upto or count == 0:
                        kept.update(raw[upto: r["start"]])
                        count += 1
                        n += r["end"] - r["start"]
                        upto = r["end"]
                    elif r["end"] > upto:
                        n += r["end"] - upto
                        upto = r["end"]
                kept.update(raw[upto:])
                removed.append(n)
                spans.append(count)
                digests.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
                                             names=["row_key", "n_removed", "n_spans", "kept_sha256"])

    return hit.mapInArrow(run, "row_key bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def repeats(keyed: DataFrame, batches: int = 4, length: int = LENGTH, prefix: int = PREFIX, hot_group: int = HOT_GROUP) -> tuple[DataFrame, DataFrame]:
    """(suffix table, repeats as row_key, start, end). Of equal texts only the first has repeats there."""
    narrow_batches(keyed.sparkSession, 256)
    keyed = keyed.select("row_key", "doc_id", null_to_empty().alias("text"))
    table = materialise(suffixes(keyed, length, prefix), "suffixes")
    first = table.where(F.col("n_bytes") >= length).groupBy("digest").agg(F.min("row_key").alias("row_key")).select("row_key")
    marks = materialise(table.join(first, "row_key").select("row_key", F.explode(F.arrays_zip("at", "key")).alias("m"))
                        .select("row_key", "m.at", "m.key", F.pmod(F.xxhash64("row_key"), F.lit(batches)).alias("batch")), "suffix_marks")

    family = SuffixFamily("key")
    again = None
    for b in range(batches):
        found = family.add(marks.where(F.col("batch") == b), last=b == batches - 1)
        again = found if again is None else again.union(found)
    wanted = (marks.join(again.distinct(), "key").groupBy("row_key").agg(F.collect_list(F.struct("at", "key")).alias("m"))
              .select("row_key", F.col("m.at").alias("at"), F.col("m.key").alias("key")))
    hit = keyed.select("row_key", "text").join(wanted, "row_key")
    named = materialise(contexts(hit, length, prefix), "suffix_contexts")

    found = named.where("n is not null").select(*_CONTEXT)
    crowded = found.groupBy("key", "context_id").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count("*").alias("members"))
    crowded = materialise(crowded.where(F.col("members") > hot_group).select("key"), "suffix_crowded")
    if crowded.isEmpty():
        reach = compare(found, length)
    else:
        reach = compare(found.join(crowded, "key", "left_anti"), length).unionByName(
            compare_spread(found.join(crowded, "key", "left_semi").select(*found.columns), length, prefix))
    reach = materialise(reach, "suffix_reaches")
    spans = named.select("row_key", "at", "key", "context_id").join(reach, ["key", "context_id"]).select(
        "row_key", (F.col("at") - F.col("to_left")).alias("start"), (F.col("at") + F.col("to_right")).alias("end"))
    return table, spans


def remove_repeats(keyed: DataFrame, batches: int = 4, length: int = LENGTH, prefix: int = PREFIX, hot_group: int = HOT_GROUP) -> DataFrame:
    """row_key, doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of row_key, doc_id, text."""
    table, spans = repeats(keyed, batches, length, prefix, hot_group)
    by_text = spans.groupBy("row_key").agg(F.collect_list(F.struct("start", "end")).alias("repeats"))
    changed = materialise(_apply(keyed.select("row_key", null_to_empty().alias("text")).join(by_text, "row_key")), "suffix_removed")
    light = table.select("row_key", "doc_id", "n_bytes", "digest")
    copied = light.where(F.col("n_bytes") >= length).groupBy("digest").agg(F.count("*").alias("copies")).where("copies > 1")
    out = light.join(changed, "row_key", "left").join(copied, "digest", "left")
    whole = F.col("copies").isNotNull()
    return out.select(
        "row_key", "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    row = fresh(docs, "__row")
    return remove_repeats(file_keyed(docs, row).select(F.col(row).alias("row_key"), "doc_id", "text")).drop("row_key")


#: Every window of every text, as hex, counted by its hash (texts are taken in parts: cutting from the end of a long one is slow).
OP7_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
parts AS (SELECT doc_id, base, substr(h, 2 * base + 1, 2 * 899) AS x FROM (
        SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 399, 0), 500)) AS base FROM d)),
w AS (SELECT doc_id, base + i AS p, hash(substr(x, 2 * i + 1, 800)) AS k FROM (
        SELECT doc_id, base, x, unnest(range(0, length(x) // 2 - 399)) AS i FROM parts)),
hits AS (SELECT doc_id, p FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
marked AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 400 THEN 0 ELSE 1 END AS starts FROM hits),
runs AS (SELECT doc_id, p, sum(starts) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
spans AS (SELECT doc_id, run, min(p) AS s, max(p) + 400 AS e FROM runs GROUP BY doc_id, run),
cut AS (SELECT doc_id, s, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS after FROM spans),
gone AS (SELECT c.doc_id, sum(e - s) AS n_removed, count(*) AS n_spans, max(e) AS last,
           string_agg(substr(h, 2 * after + 1, 2 * (s - after)), '' ORDER BY s) AS kept
         FROM cut c JOIN d USING (doc_id) GROUP BY c.doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)
"""
