"""N-gram Jaccard self-join by MinHash banding.

1. Every text becomes the set of its word n-grams (64-bit hashes), a digest of
   the set, and one hash per MinHash band. Band and row counts follow from the recall wanted at the threshold.
2. Texts with the same set are one class from the start; only its smallest row goes on (partial aggregation, so a
   large group of copies never meets in a task).
3. Bands are shuffled on their 64-bit hashes. Buckets of one are dropped; so are buckets whose members all share an earlier
   band, since every pair is looked at in its first common band only.
4. Members of the other buckets get their full n-gram sets and are compared in blocks: a bucket of many members is
   dealt out as pairs of blocks, each block pair one task's work, and only sums of links and a spanning star leave it.
5. Components of the stars are the classes.

No pair is ever a row, and no bucket is cut. Defined cases: a null or empty text (no word) has the empty set and is
in one class with the others; a text of fewer words than n has one gram, all its words; equal rows and repeated or null
ids are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nextclick.llm.common import WORD, file_keyed, fresh, materialise, narrow_batches, null_to_empty, read
from nextclick.llm.components import connected

_WORD = re.compile(WORD)
#: Word hashes remembered per worker.
REMEMBERED = 400_000
#: A block holds at most so many rows and, unless a single text has more, n-grams.
BLOCK_ROWS, BLOCK_GRAMS = 1_024, 2_000_000
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def bands_for(threshold: float, recall: float, rows: int = 4) -> int:
    """Bands of ``rows`` rows so that a pair at the threshold shares one with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


class Shingler:
    """n-gram sets and band hashes; one per task."""

    def __init__(self, n: int, bands: int, rows: int, seed: int):
        rng = np.random.default_rng(seed)
        self.n, self.bands, self.rows = n, bands, rows
        self.mul = rng.integers(1, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.add = rng.integers(0, 2**63, bands * rows, dtype=np.uint64)
        self.known: dict[str, int] = {}

    def word_hash(self, word: str) -> int:
        h = self.known.get(word)
        if h is None:
            h = xxhash.xxh3_64_intdigest(word)
            if len(self.known) < REMEMBERED:
                self.known[word] = h
        return h

    def grams(self, text: str) -> np.ndarray:
        """Sorted distinct 64-bit hashes of the word n-grams."""
        words = np.array(list(map(self.word_hash, _WORD.findall(text))), dtype=np.uint64)
        if not len(words):
            return words
        n = min(self.n, len(words))
        mixed = np.full(len(words) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            mixed = (mixed ^ words[i: len(words) - n + 1 + i]) * _PRIME
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)

    def band_hashes(self, grams: np.ndarray) -> list[int]:
        """One 64-bit hash per band of the MinHash signature."""
        if not len(grams):
            return [0] * self.bands
        low = np.full(self.bands * self.rows, np.iinfo(np.uint64).max, dtype=np.uint64)
        for i in range(0, len(grams), 2_048):
            low = np.minimum(low, (grams[i: i + 2_048, None] * self.mul + self.add).min(axis=0))
        folded = np.zeros(self.bands, dtype=np.uint64)
        for column in low.reshape(self.bands, self.rows).T:
            folded = (folded ^ column) * _PRIME
            folded ^= folded >> np.uint64(31)
        folded ^= folded >> np.uint64(32)
        return folded.view(np.int64).tolist()


def sketches(keyed: DataFrame, shingler: Shingler) -> DataFrame:
    """row_key, doc_id, set_id (128 bits), n_grams and bands of each text; the sets themselves are not kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingler.grams(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_key"), batch.column("doc_id"), pa.array([xxhash.xxh3_128_digest(g.tobytes()) for g in sets], pa.binary()),
                 pa.array(list(map(len, sets)), pa.int64()), pa.array(list(map(shingler.band_hashes, sets)), pa.list_(pa.int64()))],
                names=["row_key", "doc_id", "set_id", "n_grams", "bands"])

    kind = keyed.schema["doc_id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"row_key bigint, doc_id {kind}, set_id binary, n_grams bigint, bands array<bigint>")


def gram_sets(keyed: DataFrame, shingler: Shingler, extra: dict[str, str]) -> DataFrame:
    """The n-gram sets as packed arrays beside the columns ``extra`` (name: type)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([shingler.grams(t).tobytes() for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in extra), sets], names=[*extra, "grams"])

    return keyed.mapInArrow(run, ", ".join(f"{c} {t}" for c, t in extra.items()) + ", grams binary")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, through the grams that more than one set has."""
    m = len(sets)
    if m == 2:
        return np.array([[len(sets[0]), c := len(np.intersect1d(sets[0], sets[1], assume_unique=True))], [c, len(sets[1])]], dtype=float)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    everything = np.concatenate(sets)
    order = np.argsort(everything, kind="stable")
    owner, everything = owner[order], everything[order]
    starts = np.flatnonzero(np.concatenate([[True], everything[1:] != everything[:-1]])) if len(everything) else np.array([], int)
    counts = np.diff(np.append(starts, len(everything)))
    which = np.repeat(np.where(counts > 1, np.cumsum(counts > 1) - 1, -1), counts)
    owner, which = owner[which >= 0], which[which >= 0]
    shared = int(which.max()) + 1 if len(which) else 0
    out = np.zeros((m, m), dtype=np.float32)
    step = max(1, 16_000_000 // m)
    for at in range(0, shared, step):
        lo, hi = np.searchsorted(which, [at, at + step])
        x = np.zeros((m, min(step, shared - at)), dtype=np.float32)
        x[owner[lo:hi], which[lo:hi] - at] = 1
        out += x @ x.T
    return out.astype(float)


def compare_block(rows: list[dict], threshold: float) -> list[tuple[bytes, int, bytes]]:
    """Members of one block pair of one bucket: for each one with links its set id, the rows it is linked to by pairs that meet in this
    band first, and the smallest set id of its local component."""
    band, sides = rows[0]["band"], np.array([r["side"] for r in rows])
    bands = np.array([r["bands"] for r in rows], dtype=np.int32)
    sets = [np.frombuffer(r["grams"], np.uint64) for r in rows]
    size = np.array([len(s) for s in sets], dtype=float)
    shared = overlaps(sets)
    linked = shared >= threshold * (size[:, None] + size[None, :] - shared) - 1e-9
    for i in range(band):
        linked &= bands[:, i][:, None] != bands[:, i][None, :]
    if rows[0]["left"] != rows[0]["right"]:
        linked &= sides[:, None] != sides[None, :]
    np.fill_diagonal(linked, False)
    copies = np.array([r["copies"] for r in rows], dtype=np.int64)
    links = linked.astype(np.int64) @ copies
    ids = [r["set_id"] for r in rows]
    order = sorted(range(len(ids)), key=ids.__getitem__)
    parent: dict[int, int] = {}
    for root in order:
        if root in parent:
            continue
        parent[root], todo = root, [root]
        while todo:
            for j in np.flatnonzero(linked[todo.pop()]).tolist():
                if j not in parent:
                    parent[j] = root
                    todo.append(j)
    return [(ids[i], int(links[i]), ids[parent[i]]) for i in range(len(ids)) if links[i]]


def verified(work: DataFrame, threshold: float) -> DataFrame:
    """set_id, links, root from the members of the blocks; a task holds one block pair at a time."""
    key = ["band", "hash", "left", "right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        at = None

        def flush() -> pa.RecordBatch:
            found = compare_block(held, threshold) if len(held) > 1 else []
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.int64()),
                                               pa.array(columns[2], pa.binary())], names=["set_id", "links", "root"])

        for batch in batches:
            for row in batch.to_pylist():
                here = tuple(row[k] for k in key)
                if here != at:
                    if len(held) > 1:
                        yield flush()
                    held, at = [], here
                held.append(row)
        if len(held) > 1:
            yield flush()

    dealt = work.repartition(*key).sortWithinPartitions(*key, "set_id")
    return dealt.mapInArrow(run, "set_id binary, links bigint, root binary")


def similar_classes(keyed: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999, rows: int = 4, seed: int = 5) -> DataFrame:
    """row_key, doc_id and text in; row_key, doc_id, class_id (smallest id of the class), keeper (row_key of the class's row with the smallest id and
    key), n_links (other rows with a similarity of at least ``threshold``) out."""
    narrow_batches(keyed.sparkSession)
    shingler = Shingler(n, bands_for(threshold, recall, rows), rows, seed)
    keyed = keyed.select("row_key", "doc_id", null_to_empty().alias("text"))
    light = materialise(sketches(keyed, shingler), "ngram_sketches")
    first = F.min(F.struct(F.col("doc_id"), F.col("row_key"))).alias("first")
    reps = materialise(light.groupBy("set_id").agg(first, F.count("*").alias("copies"), F.any_value("bands").alias("bands"),
                                                   F.any_value("n_grams").alias("n_grams")), "ngram_sets")

    # Buckets with pairs that meet there first.
    each = reps.where("n_grams > 0").select("set_id", "n_grams", F.posexplode("bands").alias("band", "hash"))
    buckets = (each.groupBy("band", "hash").agg(F.count("*").alias("members"), F.sum("n_grams").alias("grams")).where("members > 1"))
    # Whether two members meet in an earlier band is told by half of each hash: a similar pair is missed for it once in 2 ** 32 / bands pairs.
    marks = F.transform("bands", lambda b: F.pmod(b, F.lit(1 << 32)) - F.lit(1 << 31)).cast("array<int>").alias("bands")
    members = materialise(each.drop("n_grams").join(buckets, ["band", "hash"]).join(reps.select("set_id", marks, "copies", "first"), "set_id"), "ngram_members")
    same_before = [F.when(F.col("band") > i, F.min(F.col("bands")[i]) == F.max(F.col("bands")[i])).otherwise(False) for i in range(shingler.bands)]
    fresh = members.groupBy("band", "hash").agg(*[c.alias(f"s{i}") for i, c in enumerate(same_before)])
    fresh = fresh.where(~_any([F.col(f"s{i}") for i in range(shingler.bands)])).select("band", "hash")
    working = materialise(members.join(fresh, ["band", "hash"]), "ngram_working")

    # Their full sets, dealt to pairs of blocks.
    wanted = working.select("set_id", F.col("first.row_key").alias("row_key")).distinct()
    sets = gram_sets(keyed.join(wanted, "row_key").select("set_id", "text"), shingler, {"set_id": "binary"})
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_ROWS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    dealt = (working.withColumn("blocks", blocks).withColumn("side", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", "hash", F.least("side", "other").alias("left"), F.greatest("side", "other").alias("right"), "side", "set_id", "bands", "copies"))
    found = materialise(verified(dealt.join(sets, "set_id"), threshold), "ngram_links")

    labels = connected(found.where("set_id <> root").select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("set_id").agg(F.sum("links").alias("links"))
    named = (reps.select("set_id", "first", "copies").join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").join(links, "set_id", "left")
             .withColumn("component", F.coalesce("component", "set_id")))
    heads = named.groupBy("component").agg(F.min("first").alias("head"))
    named = named.join(heads, "component").select(
        "set_id", F.col("head.doc_id").alias("class_id"), F.col("head.row_key").alias("keeper"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return light.select("row_key", "doc_id", "set_id").join(materialise(named, "ngram_classes"), "set_id").drop("set_id")


def _any(columns: list[Column]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | c
    return out


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: its class and the number of documents it is linked to."""
    docs = read(spark, sf_dir, "documents")
    row = fresh(docs, "__row")
    keyed = file_keyed(docs, row).select(F.col(row).alias("row_key"), "doc_id", "text")
    return similar_classes(keyed).select("doc_id", "class_id", "n_links")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class stays: the one with the smallest id. ``docs`` is read three times."""
    row = fresh(docs, "__row")
    keyed = file_keyed(docs, row)
    kept = similar_classes(keyed.select(F.col(row).alias("row_key"), "doc_id", "text")).where("row_key = keeper").select(F.col("row_key").alias(row))
    return keyed.join(kept, row, "left_semi").select(*docs.columns)


#: All pairs that share a gram, and classes by walking the links.
OP6_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
reached AS (
  SELECT doc_id, doc_id AS other FROM sizes
  UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other),
classes AS (SELECT doc_id, min(other) AS class_id FROM reached GROUP BY doc_id)
SELECT doc_id, class_id, coalesce(n, 0) AS n_links
FROM classes LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = doc_id
"""
