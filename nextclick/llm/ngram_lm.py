"""Interpolated modified Kneser-Ney bigram model of the corpus, and the log probability of every text under it.

Words are known by 64-bit hashes (as the predicted half of a pair by the upper 48 bits). The model is too large for one machine at
scale, so neither the driver nor a worker ever holds it: it lies in shards, and texts ask it in blocks.

1. ``frequent_words``: words that may make up ``HEAVY`` of all tokens, at most 2 / HEAVY of them (a word with that share has half of it
   in some unit of 250,000 tokens, and half of all its tokens in such units). Pairs that begin with them are dealt to all shards.
2. Texts are dealt into blocks of about ``block_bytes`` by a hash of the row, and each block sends its different words and pairs, with
   their counts in training texts, to the shards that own them: one row of packed arrays per block and shard.
3. A shard merges them into sorted hash arrays, written to a scratch file of the task and memory-mapped for the lookups. Words followed
   and preceded are counted there: of a pair's first word at once (for frequent words over all shards), of its second word by sending
   the sorted arrays of second words to the shards that own them.
4. The shards answer each block in the order in which it asked, with counts alone; counts of counts, one small record per shard, are
   summed. The block turns them into probabilities and sums their logarithms per text.

The two shuffles of texts and of questions are planned once and reused by the later steps of the same job.

p(w | v) = (c(vw) - D(c(vw))) / c(v) + g(v) p(w), with D for counts of 1, 2 and more from the counts of counts, g(v) what the discounts
leave, and p(w) the share of the different words before w, discounted in the same way and interpolated with 1 / (V + 1), so that unknown
words keep some probability. After a word not in the training texts p(w) holds alone.

Results by case: a null text is an empty one, of one token, its end; a row with a null doc_id is a training row; equal rows count and are
scored as often as they are there (rows equal in doc_id and text share a block); an empty table gives no rows, and without training
texts every token has probability 1 (one kind of token, the unknown); further columns are ignored. Texts of any length are read whole; a
block holds at least one text.
"""

from __future__ import annotations

import os
import tempfile
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nextclick.llm.common import narrow_batches, null_to_empty, read

#: A word of this share of all tokens has its pairs dealt to all shards.
HEAVY = 1 / 1024
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Begin and end of a text: no word has white space in it.
BEGIN, END = b"\n\n", b"\n"


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(LOWER).split()  # of bytes: at ASCII white space only


def held_out(modulus: int = 7, remainder: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder, F.lit(False))


# ----------------------------------------------------------------- packed arrays
def pack(values: np.ndarray, width: int = 8) -> bytes:
    """The lower ``width`` bytes of the numbers, all first bytes first: the upper ones of small numbers compress to nothing."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack(data: bytes, width: int = 8) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8")


def mix(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One hash of two."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def upper(words: np.ndarray) -> np.ndarray:
    return words >> np.uint64(16)


class HashArray:
    """Sorted hashes and a number for each, in files that are memory-mapped."""

    def __init__(self, folder: str, keys: np.ndarray, values: np.ndarray):
        for name, data in (("keys", keys), ("values", values)):
            np.save(os.path.join(folder, f"{name}.npy"), data)
        self.keys, self.values = (np.load(os.path.join(folder, f"{name}.npy"), mmap_mode="r") for name in ("keys", "values"))

    def lookup(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(wanted), np.int64)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[at], 0)


# ----------------------------------------------------------------- blocks of texts
def frequent_words(docs: DataFrame, share: float = HEAVY, unit: int = 250_000) -> tuple[np.ndarray, int]:
    """Hashes of the words that may have ``share`` of all tokens (at most 2 / share of them), and the bytes of all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        here: Counter[bytes] = Counter()
        size = waiting = tokens = 0

        def take() -> None:
            found.update({w: n for w, n in here.items() if n >= share / 2 * waiting})
            here.clear()

        for batch in batches:
            for text in batch.column("text").to_pylist():
                said = words_of(text)
                here.update(said)
                size, waiting, tokens = size + len(text.encode()), waiting + len(said), tokens + len(said)
                if waiting >= unit:
                    take()
                    waiting = 0
        take()
        words = np.array([xxhash.xxh3_64_intdigest(w) for w in found], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([*words.tolist(), None]), pa.array([*found.values(), tokens], pa.int64()),
                                          pa.array([0] * len(words) + [size], pa.int64())], names=["word", "n", "size"])

    counts = docs.mapInArrow(run, "word bigint, n bigint, size bigint").groupBy("word").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    total = F.max(F.when(F.col("word").isNull(), F.col("n"))).alias("tokens")
    size = F.max(F.when(F.col("word").isNull(), F.col("size"))).alias("size")
    most = F.sort_array(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("n", "word"))), False)
    row = counts.agg(total, size, F.slice(most, 1, int(2 / share)).alias("words")).first()
    words = [w["word"] for w in row["words"] if w["n"] >= share / 2 * row["tokens"]]
    return np.sort(np.array(words, np.int64).view(np.uint64)), row["size"] or 0


class Block:
    """The different words and pairs of some texts, ordered as every step finds them again: words by shard and hash, pairs by their words."""

    def __init__(self, texts: list[str], training: np.ndarray, shards: int, heavy: np.ndarray):
        fresh = count()
        ids: defaultdict[bytes, int] = defaultdict(fresh.__next__)
        ids[END], ids[BEGIN]  # noqa: B018
        said = [np.fromiter(map(ids.__getitem__, w), np.int32, len(w)) for w in map(words_of, texts)]
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, ids), np.uint64, len(ids))
        del ids
        owners = (upper(hashes) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((hashes, owners))
        new = np.r_[True, np.diff(hashes[order].view(np.int64)) != 0]  # equal hashes: one word
        rank = np.empty(len(order), np.int32)
        rank[order] = np.cumsum(new) - 1
        self.words, self.owner = hashes[order][new], owners[order][new]
        self.end, self.begin = int(rank[0]), int(rank[1])

        lengths = np.array([len(s) + 1 for s in said], np.int64)
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
        self.next = np.full(int(lengths.sum()), self.end, np.int32)
        first = np.r_[0, np.cumsum(lengths)[:-1]][: len(texts)]
        inner = np.ones(len(self.next), bool)
        inner[first + lengths - 1] = False
        self.next[inner] = rank[np.concatenate([*said, np.zeros(0, np.int32)])]
        del said, inner
        before = np.r_[0, self.next[:-1]][: len(self.next)].astype(np.int64)
        before[first] = self.begin
        n = len(self.words)
        pairs, pair = np.unique(before * n + self.next, return_inverse=True)
        del before
        self.pair = pair.astype(np.int32)
        del pair
        self.left, self.right = (pairs // n).astype(np.int32), (pairs % n).astype(np.int32)
        learnt = training[self.text]
        self.word_counts = np.bincount(self.next[learnt], minlength=n)
        self.pair_counts = np.bincount(self.pair[learnt], minlength=len(pairs))

        where = np.minimum(np.searchsorted(heavy, self.words), max(len(heavy) - 1, 0))
        is_heavy = heavy[where] == self.words if len(heavy) else np.zeros(n, bool)
        self.heavy = np.where(is_heavy, where, -1)                    # number of each word among the frequent ones
        spread = self.heavy[self.left] >= 0
        second = upper(self.words)[self.right]
        dealt = (mix(self.words[self.left], second) % np.uint64(shards)).astype(np.int64)
        self.pair_owner = np.where(spread, dealt, self.owner[self.left])
        self.parts = []                                               # (shard, words, pairs of owned words, pairs of frequent words)
        by_word, by_owned, by_spread = (self._split(o, where, shards) for o, where in (
            (self.owner, np.arange(n)), (self.pair_owner[~spread], np.flatnonzero(~spread)), (self.pair_owner[spread], np.flatnonzero(spread))))
        for shard in range(shards):
            if len(by_word[shard]) or len(by_owned[shard]) or len(by_spread[shard]):
                self.parts.append((shard, by_word[shard], by_owned[shard], by_spread[shard]))

    @staticmethod
    def _split(owner: np.ndarray, where: np.ndarray, shards: int) -> list[np.ndarray]:
        order = np.argsort(owner, kind="stable")
        return np.split(where[order], np.searchsorted(owner[order], np.arange(1, shards)))

    def question(self, words: np.ndarray, owned: np.ndarray, spread: np.ndarray) -> dict[str, bytes]:
        """What a shard is asked: its words with their counts, then pairs by their second words, with counts."""
        second = upper(self.words)
        follow = np.bincount(self.left[owned], minlength=len(self.words))[words]
        return {"words": pack(self.words[words]), "word_counts": pack(self.word_counts[words]), "follow": pack(follow),
                "seconds": pack(second[self.right[owned]], 6), "pair_counts": pack(self.pair_counts[owned]),
                "firsts": pack(self.heavy[self.left[spread]], 4), "spread_seconds": pack(second[self.right[spread]], 6),
                "spread_counts": pack(self.pair_counts[spread])}


QUESTION = ["words", "word_counts", "follow", "seconds", "pair_counts", "firsts", "spread_seconds", "spread_counts"]
ANSWER = ["word_counts", "before", "after1", "after2", "after3", "pair_counts", "spread_counts"]


# ----------------------------------------------------------------- shards
class Shard:
    """What all blocks have asked of one shard, merged."""

    def __init__(self, rows: pd.DataFrame, heavy: np.ndarray, folder: str):
        self.heavy = heavy
        asked = [self._pairs(r) for r in rows.to_dict("records")]
        words = np.concatenate([a[0] for a in asked])
        self.words, at = np.unique(words, return_inverse=True)
        self.word_counts = np.bincount(at, np.concatenate([a[1] for a in asked]), len(self.words)).astype(np.int64)
        first, second = (np.concatenate([a[k] for a in asked]) for k in (2, 3))
        keys, found, at = np.unique(mix(first, second), return_index=True, return_inverse=True)
        totals = np.bincount(at, np.concatenate([a[4] for a in asked]), len(keys)).astype(np.int64)
        self.pairs = HashArray(folder, keys, totals)
        learnt = totals > 0
        kind = np.minimum(totals[learnt], 3)
        first, self.seconds = first[found][learnt], second[found][learnt]
        self.kinds = np.bincount(np.minimum(totals[learnt], 5), minlength=6)[1:5]
        self.types = int(learnt.sum())
        self.after = self._by(self.words, first, kind)
        self.heavy_after = self._by(heavy, first, kind)

    @staticmethod
    def _by(words: np.ndarray, first: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Pairs of count 1, 2 and more that begin with each of the sorted words."""
        if not len(words):
            return np.zeros((3, 0), np.int64)
        at = np.minimum(np.searchsorted(words, first), len(words) - 1)
        there = words[at] == first
        return np.stack([np.bincount(at[there & (kind == k)], minlength=len(words)) for k in (1, 2, 3)])

    def _pairs(self, row: dict) -> tuple[np.ndarray, ...]:
        words, follow = unpack(row["words"]), unpack(row["follow"]).astype(np.int64)
        first = np.r_[np.repeat(words, follow), self.heavy[unpack(row["firsts"], 4).astype(np.int64)]].astype(np.uint64)
        second = np.r_[unpack(row["seconds"], 6), unpack(row["spread_seconds"], 6)]
        counts = np.r_[unpack(row["pair_counts"]), unpack(row["spread_counts"])].astype(np.int64)
        return words, unpack(row["word_counts"]).astype(np.int64), first, second, counts

    def answer(self, row: dict, before: HashArray) -> dict[str, bytes]:
        words, _, first, second, _ = self._pairs(row)
        at = np.searchsorted(self.words, words)
        counts = self.pairs.lookup(mix(first, second))
        owned = len(row["pair_counts"]) // 8
        return {"word_counts": pack(self.word_counts[at]), "before": pack(before.lookup(upper(words))),
                **{f"after{k + 1}": pack(self.after[k][at]) for k in range(3)}, "pair_counts": pack(counts[:owned]), "spread_counts": pack(counts[owned:])}


#: Records (id, a, b, c, d) summed over all shards: counts of counts of pairs, of the words before words, totals; else a frequent word.
PAIR_KINDS, BEFORE_KINDS, SUMS = -1, -2, -3


def _record_rows(records: list[tuple]) -> bytes:
    return np.array(records, "<i8").tobytes()


def discounts(kinds: np.ndarray) -> np.ndarray:
    """Discounts of the counts 0, 1, 2 and more from how many things were counted once, ..., four times."""
    n = kinds.astype(float)
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    out = [0.0]
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.0
        out.append(d if 0 < d < k else k / 2)  # too few things counted: half of the count
    return np.array(out)


class Model:
    """The numbers that all blocks need."""

    def __init__(self, records: np.ndarray, heavy_words: int):
        self.heavy_after = np.zeros((3, heavy_words), np.int64)
        by = defaultdict(lambda: np.zeros(4, np.int64))
        for number, *values in records.tolist():
            if number >= 0:
                self.heavy_after[:, number] += values[:3]
            else:
                by[number] += values
        self.pair_discounts, self.word_discounts = discounts(by[PAIR_KINDS]), discounts(by[BEFORE_KINDS])
        self.tokens, self.kinds, self.types, left = by[SUMS].tolist()
        more = by[BEFORE_KINDS]
        self.spare = 0.0
        if self.types:
            d = self.word_discounts
            self.spare = (d[1] * more[0] + d[2] * more[1] + d[3] * left) / self.types

    def probabilities(self, pair_counts, left_count, after, before) -> np.ndarray:
        uniform = 1 / (self.kinds + 1)
        lower = np.full(len(before), uniform)
        if self.types:
            lower = (before - self.word_discounts[np.minimum(before, 3)]) / self.types + self.spare * uniform
        known = left_count > 0
        count = np.maximum(left_count, 1)
        d = self.pair_discounts
        rest = (d[1] * after[0] + d[2] * after[1] + d[3] * after[2]) / count
        return np.where(known, (pair_counts - d[np.minimum(pair_counts, 3)]) / count + rest * lower, lower)


def score_block(block: Block, answers: dict[int, dict], model: Model) -> pd.DataFrame:
    n = len(block.words)
    words = np.zeros((5, n), np.int64)
    pairs = np.zeros(len(block.left), np.int64)
    for shard, own, owned, spread in block.parts:
        got = answers[shard]
        for k, name in enumerate(ANSWER[:5]):
            words[k, own] = unpack(got[name])
        pairs[owned], pairs[spread] = unpack(got["pair_counts"]), unpack(got["spread_counts"])
    counts, before, after = words[0], words[1], words[2:]
    frequent = block.heavy >= 0
    after[:, frequent] = model.heavy_after[:, block.heavy[frequent]]
    said = counts.copy()
    said[block.begin] = counts[block.end]  # as many begins as ends
    logs = np.log10(model.probabilities(pairs, said[block.left], after[:, block.left], before[block.right]))
    base = np.log10((counts + 1) / (model.tokens + model.kinds + 1))
    texts = int(block.text[-1]) + 1 if len(block.text) else 0
    total = lambda values: np.bincount(block.text, values, texts)
    return pd.DataFrame({"n_tokens": np.bincount(block.text, minlength=texts), "n_known": total(counts[block.next] > 0).astype("int64"),
                         "train_tokens": model.tokens, "base_score": total(base[block.next]), "score": total(logs[block.pair])})


# ----------------------------------------------------------------- the job
def kneser_ney_scores(docs: DataFrame, training: Column, block_bytes: int = 8 << 20, shard_bytes: int = 8 << 20,
                      heavy_share: float = HEAVY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``doc_id, text``; ``training`` says which rows
    the model learns from."""
    spark = docs.sparkSession
    narrow_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", null_to_empty().alias("text"), (~training).alias("held_out"))
    heavy, size = frequent_words(docs.select("text"), heavy_share)
    blocks, shards = -(-size // block_bytes) or 1, -(-size // shard_bytes) or 1
    texts = (docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")).repartition(blocks, "block"))

    def made(rows: pd.DataFrame) -> Block:
        return Block(rows["text"].tolist(), ~rows["held_out"].to_numpy(bool), shards, heavy)

    def ask(rows: pd.DataFrame) -> pd.DataFrame:
        block, number = made(rows), int(rows["block"].iloc[0])
        return pd.DataFrame([{"block": number, "shard": s, **block.question(*part)} for s, *part in block.parts])

    ddl = "block int, shard int, " + ", ".join(f"{c} binary" for c in QUESTION)
    questions = texts.groupBy("block").applyInPandas(ask, ddl).repartition(shards, "shard")

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        with tempfile.TemporaryDirectory() as folder:
            shard = Shard(rows, heavy, folder)
        number = int(rows["shard"].iloc[0])
        records = [(PAIR_KINDS, *shard.kinds), (SUMS, shard.word_counts.sum(), (shard.word_counts > 0).sum(), shard.types, 0),
                   *((i, *n, 0) for i, n in enumerate(shard.heavy_after.T.tolist()) if any(n))]
        seconds, times = np.unique(shard.seconds, return_counts=True)
        owner = (seconds % np.uint64(shards)).astype(np.int64)
        out = [{"shard": number, "seconds": None, "times": None, "records": _record_rows(records)}]
        for s, at in enumerate(Block._split(owner, np.arange(len(owner)), shards)):
            if len(at):
                out.append({"shard": s, "seconds": pack(seconds[at], 6), "times": pack(times[at]), "records": None})
        return pd.DataFrame(out)

    merged = questions.groupBy("shard").applyInPandas(merge, "shard int, seconds binary, times binary, records binary").repartition(shards, "shard")

    def precede(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Words that come second in a pair of the training texts, and after how many different words."""
        there = rows[rows["seconds"].notna()]
        words = np.concatenate([np.zeros(0, np.uint64), *(unpack(x, 6) for x in there["seconds"])])
        words, at = np.unique(words, return_inverse=True)
        return words, np.bincount(at, np.concatenate([np.zeros(0), *(unpack(x) for x in there["times"])]), len(words)).astype(np.int64)

    def summed(rows: pd.DataFrame) -> pd.DataFrame:
        _, before = precede(rows)
        kinds = np.bincount(np.minimum(before, 5), minlength=6)[1:]
        records = [np.frombuffer(x, "<i8").reshape(-1, 5) for x in rows["records"].dropna()]
        own = [(BEFORE_KINDS, *kinds[:4]), (SUMS, 0, 0, 0, kinds[2:].sum())]
        return pd.DataFrame(np.concatenate([*records, np.array(own)]), columns=list("iabcd"))

    parts = merged.groupBy("shard").applyInPandas(summed, "i bigint, a bigint, b bigint, c bigint, d bigint")
    sums = parts.groupBy("i").agg(*(F.sum(c).alias(c) for c in "abcd"))  # one row per frequent word and three more
    record = sums.agg(F.collect_list(F.array(*(F.col(c) for c in "iabcd"))).alias("model"))

    def answer(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame(columns=["block", "shard", *ANSWER])
        with tempfile.TemporaryDirectory() as folder, tempfile.TemporaryDirectory() as other:
            shard, before = Shard(asked, heavy, folder), HashArray(other, *precede(rows))
            return pd.DataFrame([{"block": r["block"], "shard": r["shard"], **shard.answer(r, before)} for r in asked.to_dict("records")])

    answers = questions.groupBy("shard").cogroup(merged.groupBy("shard")).applyInPandas(
        answer, "block int, shard int, " + ", ".join(f"{c} binary" for c in ANSWER))
    model = spark.range(blocks).select(F.col("id").cast("int").alias("block"), F.lit(-1).alias("shard"),
                                       *(F.lit(None).cast("binary").alias(c) for c in ANSWER), record.scalar().alias("model"))
    answers = answers.withColumn("model", F.lit(None).cast("array<array<bigint>>")).unionByName(model).repartition(blocks, "block")

    def score(rows: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        records = np.array([list(r) for r in got.loc[got["shard"] < 0, "model"].iloc[0]], np.int64)
        out = score_block(made(rows), {r["shard"]: r for r in got[got["shard"] >= 0].to_dict("records")}, Model(records, len(heavy)))
        out.insert(0, "held_out", rows["held_out"].to_numpy())
        out.insert(0, "doc_id", rows["doc_id"].to_numpy())
        return out

    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        score, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def op12_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney_scores(read(spark, sf_dir, "documents"), ~held_out())
