"""Document fingerprints by a randomised edit embedding.

Shared random bits r(time, character) drive a walk over every text: at each time step the walk writes the
character it stands on and moves on if the bit for this time and character is 1. Two texts walk in step over what they
share and fall back into step soon after an edit, so few edits mean a small Hamming distance between what is written.

A fingerprint keeps what is written at sampled times only: ``SAMPLES`` times spread over the span of a length class
(a power of two), for the text's own class and the next one, so that texts on either side of a class bound can be
compared. The symbol kept is a byte of the characters from the place on. ``likeness`` is the share of equal
symbols. ``near_classes`` bands the samples, and verifies likeness inside the buckets in blocks.

Defined cases: a null or empty text has a fingerprint of its own kind (likeness 1 to another empty text, 0 to others);
equal texts have equal fingerprints; documents with the same id follow each other in text order, a null id comes
after all others; a single document is its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nextclick.llm.common import materialise, narrow_batches, null_to_empty, read, row_keyed
from nextclick.llm.components import connected

SAMPLES = 128
GRAM = 4
LEAST_CLASS = 4
_TIMES = 16  # log2 of the period of the random bits
_KINDS = 64  # characters are hashed to so many kinds
_CELLS = 4_000_000
_SEED = 20_25


@lru_cache(maxsize=1)
def waits() -> np.ndarray:
    """wait[kind << _TIMES | time]: steps that a walk standing on this kind of character at this time needs to move on."""
    period = 1 << _TIMES
    bits = np.random.default_rng(_SEED).integers(0, 2, (_KINDS, 2 * period), dtype=np.uint8)
    bits[:, period:] = bits[:, :period]
    place = np.where(bits, np.arange(2 * period), 4 * period)
    following = np.minimum.accumulate(place[:, ::-1], axis=1)[:, ::-1][:, :period]
    return (following - np.arange(period) + 1).astype(np.int32).ravel()


@lru_cache(maxsize=64)
def sample_times(length_class: int) -> np.ndarray:
    """Sorted times at which a class is sampled, one in each of SAMPLES equal parts of its span (a walk takes two steps a character)."""
    span = 1 << (length_class + 2)
    at = np.random.default_rng([_SEED, length_class]).random(SAMPLES)
    return ((np.arange(SAMPLES) + at) * span / SAMPLES).astype(np.int64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _walk(texts: list[np.ndarray]) -> list[np.ndarray]:
    """Time at which the walk comes to each character, and after the last the time it ends. All texts step together."""
    width = len(texts)
    longest = len(texts[0])  # they come longest first
    kinds = np.zeros((longest, width), dtype=np.int32)
    for j, x in enumerate(texts):
        kinds[: len(x), j] = ((x * np.uint32(2_654_435_761)) >> np.uint32(26)).astype(np.int32) << _TIMES
    times = np.zeros((longest + 1, width), dtype=np.int64 if longest > 1 << 28 else np.int32)
    lengths = np.array([len(x) for x in texts])
    going = np.searchsorted(-lengths, -np.arange(longest), side="left")  # texts longer than i
    table, mask = waits(), (1 << _TIMES) - 1
    for i in range(longest):
        n = going[i]
        now = times[i, :n]
        np.add(now, table[kinds[i, :n] | (now & mask)], out=times[i + 1, :n])
    return [times[: len(x) + 1, j] for j, x in enumerate(texts)]


def _symbols(points: np.ndarray, times: np.ndarray, length_class: int) -> bytes:
    """What is written at the sampled times; 0 after the end."""
    at = np.searchsorted(times, sample_times(length_class), side="right") - 1
    inside = at < len(points)
    grams = np.zeros(len(points) + GRAM, dtype=np.uint64)
    grams[: len(points)] = points
    symbol = np.zeros(SAMPLES, dtype=np.uint64)
    for i in range(GRAM):
        symbol = (symbol ^ grams[np.where(inside, at, 0) + i]) * np.uint64(0x9E3779B97F4A7C15)
        symbol ^= symbol >> np.uint64(32)
    return np.where(inside, symbol % np.uint64(255) + np.uint64(1), 0).astype(np.uint8).tobytes()


def embed(texts: list[str]) -> list[str]:
    """Fingerprints: the length class, then the hex symbols of this class and of the next."""
    points = [_points(t) for t in texts]
    out = ["0:"] * len(texts)
    order = sorted((i for i in range(len(texts)) if len(points[i])), key=lambda i: -len(points[i]))
    while order:
        width = len(points[order[0]]) + 1
        fit = max(1, _CELLS // width)
        group, order = order[:fit], order[fit:]
        for i, times in zip(group, _walk([points[i] for i in group]), strict=True):
            own = max(LEAST_CLASS, len(points[i]).bit_length() - 1)
            out[i] = f"{own}:{_symbols(points[i], times, own).hex()}{_symbols(points[i], times, own + 1).hex()}"
    return out


def parts(fingerprint: str) -> dict[int, np.ndarray]:
    """Symbols by length class."""
    own, _, symbols = fingerprint.partition(":")
    if not symbols:
        return {}
    both = np.frombuffer(bytes.fromhex(symbols), dtype=np.uint8)
    return {int(own): both[:SAMPLES], int(own) + 1: both[SAMPLES:]}


def likeness(a: str, b: str) -> float:
    """Share of equal symbols among the times at which either text still goes on, over the classes both have."""
    if a == b:
        return 1.0
    x, y = parts(a), parts(b)
    same = going = 0
    for c in x.keys() & y.keys():
        live = (x[c] > 0) | (y[c] > 0)
        same += int(((x[c] == y[c]) & live).sum())
        going += int(live.sum())
    return same / going if going else 0.0


def _like(symbols: list[dict[int, np.ndarray]], one: int, others: list[int], threshold: float) -> list[int]:
    """Those of ``others`` that are as like as the threshold to ``one``."""
    same, going = np.zeros(len(others)), np.zeros(len(others))
    for c, mine in symbols[one].items():
        have = [k for k, j in enumerate(others) if c in symbols[j]]
        if have:
            table = np.array([symbols[others[k]][c] for k in have])
            live = (table > 0) | (mine > 0)
            same[have] += ((table == mine) & live).sum(axis=1)
            going[have] += live.sum(axis=1)
    return [others[k] for k in np.flatnonzero((going > 0) & (same >= threshold * going))]


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_LEAST = -(2 ** 63)


def successors(docs: DataFrame, parts_: int | None = None) -> DataFrame:
    """Rows dealt to buckets of consecutive ids, each bucket sorted so that the next document follows every one of its own.

    The bounds are quantiles of the ids, one per bucket, and are ids themselves: the first document of a bucket (in descending
    order) is its bound, and goes to the bucket before it too, ``borrowed``. The texts are shuffled once.
    """
    spark = docs.sparkSession
    n = parts_ or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LEAST))
    steps = F.array(*[F.lit((i + 1) / n) for i in range(n)])
    found = docs.agg(F.percentile_approx(place, steps, F.lit(20 * n)).alias("q"), F.max(place).alias("top")).first()
    bounds = np.array(sorted({*(found["q"] or []), *([found["top"]] if found["top"] is not None else [])}), dtype=np.int64)

    def buckets(ids: pa.Array) -> pa.Array:
        x = ids.to_numpy(zero_copy_only=False)
        return pa.array(np.searchsorted(bounds, x).astype(np.int32))

    def is_bound(ids: pa.Array) -> pa.Array:
        return pa.array(np.isin(ids.to_numpy(zero_copy_only=False), bounds))

    count = max(len(bounds), 1)
    keyed = docs.select("doc_id", null_to_empty().alias("text"), place.alias("place"))
    keyed = keyed.select("*", F.arrow_udf(buckets, "int")("place").alias("home"), F.arrow_udf(is_bound, "boolean")("place").alias("first"))
    entry = lambda b, borrowed: F.struct(b.cast("int").alias("bucket"), F.lit(borrowed).alias("borrowed"))
    copies = F.when(F.col("first"), F.array(entry(F.col("home"), False), entry(F.pmod(F.col("home") + 1, F.lit(count)), True))).otherwise(
        F.array(entry(F.col("home"), False)))
    dealt = keyed.select("doc_id", "text", "place", F.explode(copies).alias("e")).select("doc_id", "text", "place", "e.*")
    return (dealt.repartitionById(count, F.col("bucket"))
            .sortWithinPartitions("bucket", "borrowed", F.desc("place"), "text").select("doc_id", "text", "bucket", "borrowed"))


_OUT = [("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64())]


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, the digest of the edited text, both fingerprints, and the likeness to the edited text's and the next document's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = list(zip(range(len(texts)), texts, batch.column("bucket").to_pylist(), batch.column("borrowed").to_pylist(), strict=True))
            pairs, after = [], []
            for i, text, bucket, borrowed in rows:
                if held is not None and held[2] == bucket and not held[3]:
                    pairs.append((held[0], held[1], edited(held[1], text)))
                    after.append(i)
                held = (batch.column("doc_id").slice(i, 1), text, bucket, borrowed)
            prints = embed([p[1] for p in pairs] + [p[2] for p in pairs] + [texts[i] for i in after[-1:]])
            own, changed = prints[: len(pairs)], prints[len(pairs): 2 * len(pairs)]
            # The next document of a pair is the document of the following pair, but at the end of a bucket or of the batch.
            extra = [k for k in range(len(pairs) - 1) if texts[after[k]] != pairs[k + 1][1]]
            known = dict(zip(extra, embed([texts[after[k]] for k in extra]), strict=True))
            follow = [prints[-1] if k == len(pairs) - 1 else known.get(k) or own[k + 1] for k in range(len(pairs))]
            columns = [pa.array([len(p[1]) for p in pairs], pa.int64()),
                       pa.array([hashlib.sha256(p[2].encode()).hexdigest() for p in pairs], pa.string()),
                       pa.array(own, pa.string()), pa.array(changed, pa.string()),
                       pa.array([likeness(a, b) for a, b in zip(own, changed, strict=True)], pa.float64()),
                       pa.array([likeness(a, b) for a, b in zip(own, follow, strict=True)], pa.float64())]
            ids = pa.concat_arrays([p[0] for p in pairs]) if pairs else batch.column("doc_id").slice(0, 0)
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", *(n for n, _ in _OUT)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return successors(docs).mapInArrow(run, f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                            "near_edited double, near_next double")


def fingerprint(text: Column) -> Column:
    return F.arrow_udf(lambda texts: pa.array(embed([t or "" for t in texts.to_pylist()]), pa.string()), "string")(text)


def bands(prints: Column, rows: int = 8) -> Column:
    """Bit-sampled bands: for each length class of a fingerprint, hashes of ``rows`` neighbouring samples. Bands after the text's end are left out."""
    def run(batch: pa.Array) -> pa.Array:
        out = []
        for f in batch.to_pylist():
            found = [] if parts(f) else ["empty"]
            for c, symbols in parts(f).items():
                for i in range(0, SAMPLES, rows):
                    if symbols[i]:
                        found.append(f"{c}:{i}:{hashlib.blake2b(symbols[i: i + rows].tobytes(), digest_size=8).hexdigest()}")
            out.append(found)
        return pa.array(out, pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")(prints)


def near_classes(docs: DataFrame, threshold: float = 0.6, block: int = 1_024) -> DataFrame:
    """doc_id and class_id (smallest id of the class) of every row of doc_id, text: classes of texts tied by pairs that share a band and reach
    the likeness ``threshold``. Equal fingerprints go on once; a bucket of many members is compared as pairs of blocks, stars leave it."""
    narrow_batches(docs.sparkSession)
    light = materialise(row_keyed(docs.select("doc_id", fingerprint(null_to_empty()).alias("print"))), "prints")
    reps = materialise(light.groupBy("print").agg(F.min("doc_id").alias("head")), "prints_distinct")
    each = reps.select("print", F.explode(bands(F.col("print"))).alias("band"))
    buckets = each.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    side = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
    dealt = (each.join(buckets, "band").withColumn("blocks", F.ceil(F.col("members") / block).cast("int")).withColumn("side", side)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", F.least("side", "other").alias("left"), F.greatest("side", "other").alias("right"), "print"))
    key = ["band", "left", "right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        at = None

        def stars() -> list[tuple[str, str]]:
            out, left = [], set(range(len(held)))
            symbols = [parts(f) for f in held]
            while left:
                root = left.pop()
                todo = [root]
                while todo:
                    now = todo.pop()
                    near = _like(symbols, now, sorted(left), threshold)
                    left.difference_update(near)
                    todo += near
                    out += [(held[root], held[j]) for j in near]
            return out

        found: list[tuple[str, str]] = []
        for batch in batches:
            for row in batch.to_pylist():
                here = tuple(row[k] for k in key)
                if here != at:
                    found += stars()
                    held, at = [], here
                held.append(row["print"])
            a, b = list(zip(*found, strict=True)) or [(), ()]
            found = []
            yield pa.RecordBatch.from_arrays([pa.array(list(a), pa.string()), pa.array(list(b), pa.string())], names=["a", "b"])
        a, b = list(zip(*stars(), strict=True)) or [(), ()]
        yield pa.RecordBatch.from_arrays([pa.array(list(a), pa.string()), pa.array(list(b), pa.string())], names=["a", "b"])

    edges = materialise(dealt.repartition(*key).sortWithinPartitions(*key, "print").mapInArrow(run, "a string, b string"), "prints_edges")
    named = (reps.join(connected(edges).withColumnRenamed("node", "print"), "print", "left")
             .withColumn("component", F.coalesce("component", "print")))
    heads = named.groupBy("component").agg(F.min("head").alias("class_id"))
    return light.join(named.join(heads, "component").select("print", "class_id"), "print").select("doc_id", "class_id")


def op3_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    narrow_batches(spark, 1_024)
    return compare_with_edits(read(spark, sf_dir, "documents"))
