"""Prefix trie of conversations by time-forward processing.

Conversations that begin with the same turns share the nodes of these turns. A node is known by a digest of its turns (two residues of
61 bits of a polynomial in the hashes of role and text) and its depth.

1. ``chained`` numbers the turns of each conversation and gives every turn the digests of its prefix and of the one before. Rows are
   sorted by ranges, so a conversation of any length is spread over tasks; what a partition's last conversation has come to is one small
   record per partition, by which the rows that go on in later partitions are mended.
2. Nodes are partial aggregates over the rows: members, smallest member, characters, and the rows beneath, an upper bound of the size of
   the subtree.
3. Shards: a node is heavy if more than ``bound`` rows lie beneath it, and a light node belongs to the shard of its topmost light
   ancestor, so a very common first turn is split into the shards beneath it. ``bound`` is ``shard_rows``, or 1 / ``tops`` of all rows if
   that is more: there are at most ``tops`` heavy nodes of one depth.
4. In each shard the nodes are sorted in reverse level order by Spark, and ``time_forward`` passes the totals of each node to its parent
   through a priority queue that spills sorted runs to scratch files of the task. What shard roots pass on is summed per heavy parent,
   and the same pass over the heavy nodes gives the rest.
5. The ends of a node, conversations that say exactly its turns, are sorted by Spark and hashed as a stream.

Results by case: a null role or text is an empty one, a null turn comes first; rows equal in turn, role and text stay apart as turns of
their own (equal ones follow each other); of equal turns role and then text decide the order; rows with a null conv_id belong to no
conversation and are left out; a conversation of no rebuilt turn is a member and an end of the root; an empty table gives no rows, not
even a root; further columns are ignored. Texts of any length count whole, and conversations of any length.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nextclick.llm.common import materialise, read

PRIME, BASES = (1 << 61) - 1, (1_000_003_231_877, 77_003_111_909_453)
NODE = ["depth", "k1", "k2"]


# ----------------------------------------------------------------- digests of prefixes
def _arrays(columns: list[list], like: pa.RecordBatch, extra: list[str], names: list[str]) -> pa.RecordBatch:
    made = [like.column(n) for n in extra] + [pa.array(c, pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays(made, names=[*extra, *names])


def chained(rows: DataFrame, order: list[Column], extra: list[str], name: str) -> DataFrame:
    """conv_id, ``extra``, depth (1, 2, ... in the order within the conversation), k1, k2 (digest of the turns so far), p1, p2 (of those
    before). ``rows``: conv_id, t1, t2 and what ``order`` (which begins with conv_id) and ``extra`` need."""
    local = ["part", "seq", "depth", "k1", "k2", "p1", "p2"]
    kept = ["conv_id", *extra]
    ddl = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept)

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        conv, depth, k1, k2 = None, 0, 0, 0
        for batch in batches:
            out: list[list] = [[] for _ in local]
            for c, t1, t2 in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "t1", "t2")), strict=True):
                if c != conv or not seq:
                    conv, depth, k1, k2 = c, 0, 0, 0
                depth, p1, p2 = depth + 1, k1, k2
                k1, k2 = (k1 * BASES[0] + t1) % PRIME, (k2 * BASES[1] + t2) % PRIME
                for column, v in zip(out, (part, seq, depth, k1, k2, p1, p2), strict=True):
                    column.append(v)
                seq += 1
            yield _arrays(out, batch, kept, local)

    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*dict.fromkeys([*kept, "t1", "t2"]))
    table = materialise(parts.mapInArrow(begin, ddl + "".join(f", {c} bigint" for c in local)), name)
    last = F.max_by(F.struct("conv_id", "depth", "k1", "k2"), "seq").alias("last")
    edges = table.groupBy("part").agg(F.min_by("conv_id", "seq").alias("first"), last).orderBy("part").collect()  # one row per partition
    carried: dict[int, tuple[int, int, int, int]] = {}
    ahead: tuple[int, int, int, int] | None = None
    for e in edges:
        conv, depth, k1, k2 = e["last"]
        goes_on = ahead is not None and ahead[0] == e["first"]
        if goes_on:
            carried[e["part"]] = ahead
        if goes_on and conv == e["first"]:
            depth, k1, k2 = _after(ahead, depth, k1, k2)
        ahead = (conv, depth, k1, k2)
    if not carried:
        return table.drop("part", "seq")

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(x).to_pylist() for x in ("conv_id", *local)), strict=True))
            fixed = []
            for conv, part, _, depth, k1, k2, p1, p2 in rows:
                before = carried.get(part)
                if before and before[0] == conv:
                    _, p1, p2 = _after(before, depth - 1, p1, p2)
                    depth, k1, k2 = _after(before, depth, k1, k2)
                fixed.append((depth, k1, k2, p1, p2))
            yield _arrays([list(c) for c in zip(*fixed, strict=True)] or [[]] * 5, batch, kept, local[2:])

    return table.mapInArrow(mend, ddl + "".join(f", {c} bigint" for c in local[2:]))


def _after(before: tuple[int, int, int, int], depth: int, k1: int, k2: int) -> tuple[int, int, int]:
    """Depth and digests of the turns of ``before`` and ``depth`` more, whose own digests are given."""
    _, d, b1, b2 = before
    return d + depth, (b1 * pow(BASES[0], depth, PRIME) + k1) % PRIME, (b2 * pow(BASES[1], depth, PRIME) + k2) % PRIME


def hashed_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, t1, t2, n_chars of the rows that belong to a conversation."""
    said = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    digest = lambda seed: F.xxhash64(F.lit(seed), "role", F.length("role"), "text")
    return said.select("*", digest(1).alias("t1"), digest(2).alias("t2"), F.length("text").cast("bigint").alias("n_chars"))


# ----------------------------------------------------------------- totals
class SpillingQueue:
    """A priority queue that keeps at most ``held`` items; more are written to scratch files of this task as sorted runs, which are
    read back in order. At most ``runs`` files are open: more are merged into one."""

    def __init__(self, held: int = 100_000, runs: int = 32):
        self.held, self.most_runs = held, runs
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # (next item, number, further items)
        self.spills = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.held:
            self._write(sorted(self.heap))
            self.heap = []
            if len(self.runs) > self.most_runs:
                rest = [self._chained(head, items) for head, _, items in self.runs]
                self.runs = []
                self._write(heapq.merge(*rest))

    @staticmethod
    def _chained(head: tuple, items: Iterator[tuple]) -> Iterator[tuple]:
        yield head
        yield from items

    def _write(self, items) -> None:
        file, items = tempfile.TemporaryFile(), iter(items)
        while chunk := list(islice(items, 4096)):
            pickle.dump(chunk, file)
        file.seek(0)

        def again() -> Iterator[tuple]:
            with file:
                while True:
                    try:
                        yield from pickle.load(file)
                    except EOFError:
                        return

        self.spills += 1
        self._open(again(), self.spills)

    def _open(self, items: Iterator[tuple], number: int) -> None:
        head = next(items, None)
        if head is not None:
            heapq.heappush(self.runs, (head, number, items))

    def pop_at(self, key: tuple) -> Iterator[tuple]:
        """Take out the items whose first field is ``key``; none is smaller."""
        while self.heap and self.heap[0][0] == key:
            yield heapq.heappop(self.heap)
        while self.runs and self.runs[0][0][0] == key:
            item, number, items = heapq.heappop(self.runs)
            yield item
            self._open(items, number)


TOTALS = [*NODE, "p1", "p2", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def time_forward(nodes: DataFrame, held: int = 100_000) -> DataFrame:
    """Totals of the nodes of each partition, which come in reverse level order: depth descending, then k1, k2. ``is_root`` marks those
    whose parent is not there; ``n_children``, ``n_leaves`` and ``saved_tokens`` hold what came from beneath the partition's nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(held)
        for batch in batches:
            out: list[list] = [[] for _ in range(3)]
            fields = [batch.column(c).to_pylist() for c in (*NODE, "p1", "p2", "n_convs", "n_chars", "is_root", *TOTALS[-3:])]
            for depth, k1, k2, p1, p2, n_convs, n_chars, is_root, children, leaves, saved in zip(*fields, strict=True):
                for _, more, ends, sums in queue.pop_at((-depth, k1, k2)):
                    children, leaves, saved = children + more, leaves + ends, saved + sums
                leaves = leaves if children else 1
                saved += (n_convs - 1) * n_chars
                if not is_root:
                    queue.push(((1 - depth, p1, p2), 1, leaves, saved))
                for column, v in zip(out, (children, leaves, saved), strict=True):
                    column.append(v)
            yield _arrays(out, batch, [*TOTALS[:-3], "is_root"], TOTALS[-3:])

    ddl = ", ".join([f"{c} bigint" for c in TOTALS[:-3]] + ["is_root boolean"] + [f"{c} bigint" for c in TOTALS[-3:]])
    return nodes.sortWithinPartitions(F.desc("depth"), "k1", "k2").mapInArrow(run, ddl)


def ends_digests(ends: DataFrame) -> DataFrame:
    """ends_sha256 of each node that has ends (depth, k1, k2, conv_id): a stream through one task per node, nothing is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None
        for batch in batches:
            done = []
            for *node, conv in zip(*(batch.column(c).to_pylist() for c in (*NODE, "conv_id")), strict=True):
                if node != at:
                    if at:
                        done.append((*at, digest.hexdigest()))
                    at, digest = node, hashlib.sha256(str(conv).encode())
                else:
                    digest.update(f",{conv}".encode())
            yield _digest_rows(done)
        if at:
            yield _digest_rows([(*at, digest.hexdigest())])

    sorted_ends = ends.select(*NODE, "conv_id").repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    return sorted_ends.mapInArrow(run, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    types = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=[*NODE, "ends_sha256"])


def prefix_trie(turns: DataFrame, shard_rows: int = 200_000, tops: int = 4096, held: int = 100_000) -> DataFrame:
    """Nodes of the trie of conversations given as turns in order: conv_id, depth (1, 2, ...), len (turns of the conversation), t1, t2,
    n_chars; a conversation without turns is one row of depth null, len 0. Returns conv_id (the smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    said = turns.where(F.col("depth").isNotNull())
    path = chained(said, [F.col("conv_id"), F.col("depth")], ["len", "n_chars"], "trie_paths")
    none = F.lit(0).cast("bigint")
    roots = turns.groupBy("conv_id").agg(F.max("len").alias("len")).select(
        "conv_id", "len", none.alias("n_chars"), none.alias("depth"), none.alias("k1"), none.alias("k2"), none.alias("p1"), none.alias("p2"))
    rows = materialise(path.unionByName(roots), "trie_rows")
    nodes = materialise(rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("n_chars").alias("n_chars"),
        F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.sum(F.col("len") - F.col("depth") + 1).alias("beneath")), "trie_nodes")
    bound = max(shard_rows, rows.count() // tops)
    heavy = nodes.where(F.col("beneath") > bound)

    # the shard of each conversation: its first light node
    marked = rows.join(heavy.select(*NODE, F.lit(True).alias("heavy")), NODE, "left").withColumn("light", F.col("heavy").isNull())
    shards = marked.where("light").groupBy("conv_id").agg(F.min_by(F.struct("k1", "k2", "depth"), "depth").alias("top"))
    light = (nodes.where(F.col("beneath") <= bound).join(shards, "conv_id")
                  .withColumn("is_root", F.col("depth") == F.col("top.depth")))
    nothing = [none.alias(c) for c in TOTALS[-3:]]
    pieces = max(1, -(-nodes.count() // shard_rows))
    held_parts = max(pieces, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    done = materialise(time_forward(light.select("*", *nothing).repartition(held_parts, "top"), held), "trie_light")

    # across shard roots
    passed = (done.where(F.col("is_root") & (F.col("depth") > 0)).groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
                  .agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    above = (heavy.join(passed, NODE, "left").fillna(0, TOTALS[-3:]).withColumn("is_root", F.col("depth") == 0).repartition(1))
    trie = done.unionByName(time_forward(above, held)).drop("is_root")

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    ends = ends_digests(rows.where(F.col("depth") == F.col("len")))
    return (trie.join(parents, ["depth", "p1", "p2"], "left").join(ends, NODE, "left")
                .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256")))


def with_shared_heads(turns: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """The conversations of the contract, as ``prefix_trie`` takes them: the first h turns of conversation c - c % ``every``, then c's own
    turns after its first h, with h = crc32(decimal c) % ``most``."""
    own = chained(hashed_turns(turns), [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")],
                  ["t1", "t2", "n_chars"], "trie_turns").drop("k1", "k2", "p1", "p2")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    base = F.col("conv_id") - F.col("conv_id") % every
    sizes = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    bases = sizes.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = materialise(sizes.withColumns({"base": base, "h": h}).join(bases, "base", "left").withColumn("taken", taken)
                             .withColumn("len", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie_convs")
    turn = ["t1", "t2", "n_chars"]
    heads = own.where((F.col("conv_id") % every == 0) & (F.col("depth") < most)).withColumnRenamed("conv_id", "base")
    shared = convs.join(heads, "base").where(F.col("depth") <= F.col("h")).select("conv_id", "len", "depth", *turn)
    rest = (own.where(F.col("depth") > h).join(convs.select("conv_id", "h", "taken", "len"), "conv_id")
               .withColumn("depth", F.col("depth") - F.col("h") + F.col("taken")).select("conv_id", "len", "depth", *turn))
    silent = convs.where(F.col("len") == 0).select("conv_id", "len", *(F.lit(None).cast("bigint").alias(c) for c in ("depth", *turn)))
    return shared.unionByName(rest).unionByName(silent)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(materialise(with_shared_heads(read(spark, sf_dir, "conversations")), "trie_rebuilt"))


OP11_SQL = """
WITH RECURSIVE bits AS (
  SELECT range AS i, 0 AS k, range::BIGINT AS c FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM bits WHERE k < 8),
crc_table AS (SELECT i, c FROM bits WHERE k = 8),
own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
steps AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s, 0 AS p, 4294967295::BIGINT AS crc FROM own
  UNION ALL SELECT conv_id, s, p + 1, xor(t.c, crc >> 8) FROM steps JOIN crc_table t ON t.i = xor(crc & 255, ascii(substr(s, p + 1, 1))::BIGINT)
  WHERE p < length(s)),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(crc, 4294967295) % 6 AS h,
    least(xor(crc, 4294967295) % 6, (SELECT count(*) FROM own b WHERE b.conv_id = steps.conv_id - steps.conv_id % 100)) AS taken
  FROM steps WHERE p = length(s)),
turns AS (
  SELECT c.conv_id, b.pos AS depth, b.role, b.text FROM convs c JOIN own b ON b.conv_id = c.base AND b.pos <= c.h
  UNION ALL SELECT o.conv_id, o.pos - c.h + c.taken, o.role, o.text FROM own o JOIN convs c ON c.conv_id = o.conv_id AND o.pos > c.h),
paths AS (
  SELECT conv_id, depth, length(text) AS n_chars,
    md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS path FROM turns
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
parted AS (
  SELECT *, lag(path) OVER (PARTITION BY conv_id ORDER BY depth) AS parent, lead(path) OVER (PARTITION BY conv_id ORDER BY depth) AS child FROM paths),
nodes AS (
  SELECT depth, path, any_value(parent) AS parent, any_value(n_chars) AS n_chars, min(conv_id) AS conv_id, count(*) AS n_convs,
    count(DISTINCT child) AS n_children,
    sha256(coalesce(string_agg(CASE WHEN child IS NULL THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM parted GROUP BY depth, path),
beneath AS (
  SELECT r.depth, r.path, sum((n.n_convs - 1) * n.n_chars) AS saved_tokens, count(*) FILTER (n.n_children = 0) AS n_leaves
  FROM nodes n JOIN paths r ON r.conv_id = n.conv_id AND r.depth <= n.depth GROUP BY 1, 2)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN beneath b USING (depth, path) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.parent
"""
