"""Byte-level BPE over overlapping chunks.

``encode`` cuts every text into overlapping chunks (rows of their own, so one
long document is spread over tasks), pre-tokenises and merges each chunk, and
stitches neighbouring chunks at the first pre-token boundary that both found:
the pattern looks only forward, so from a common boundary on both go the same
way. Where two chunks have no common boundary in their overlap (a run of one
character class longer than it), the whole document is encoded in one piece
instead, in the same stitching step. ``decode`` concatenates the raw bytes of the ids.

Defined cases: a null or empty text has no ids (the digests are those of the
empty string); equal rows are encoded apart; the id may be null or repeated,
rows are never joined on it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from public_tokenizers import PATTERN
from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nextclick.llm.common import narrow_batches, null_to_empty, read, row_keyed

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Code points of a chunk without its overlaps, and of the overlap on either side of a cut.
CHUNK, OVERLAP = 32_768, 1_024
#: Pre-tokens remembered per worker; the memory of the cache, not a limit on texts.
REMEMBERED = 300_000


class Coder:
    """Ranks of one vocabulary file: pre-tokens of a text, their ids, and the bytes of ids."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.merges = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pretoken = regex.compile(pattern)
        self.bytes_of = {i: token for token, i in ranks.items()}
        self.known: dict[str, list[int]] = {}

    def ids(self, piece: str) -> list[int]:
        got = self.known.get(piece)
        if got is None:
            got = self.merges._encode_single_piece(piece)
            if len(self.known) < REMEMBERED and len(piece) < 64:
                self.known[piece] = got
        return got

    def pieces(self, text: str) -> tuple[np.ndarray, list[list[int]]]:
        """Pre-token ends, and the ids of each."""
        found = self.pretoken.findall(text)
        ids = self.ids
        return np.cumsum(list(map(len, found)), dtype=np.int64), [ids(p) for p in found]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=4)
def coder(ranks_path: str, pattern: str) -> Coder:
    """One per worker and vocabulary."""
    return Coder(ranks_path, pattern)


#: A contraction of the pattern is at most three code points long: nearer than this to a chunk's end a boundary may be false.
LOOKAHEAD = 4


def common_boundary(left_ends: np.ndarray, right_ends: np.ndarray, right_start: int, trusted: int) -> int | None:
    """First position from ``right_start`` on, before ``trusted``, that is a pre-token boundary for both neighbours."""
    both = np.intersect1d(left_ends, np.append(right_ends, right_start))
    both = both[(both >= right_start) & (both < trusted)]
    return int(both[0]) if len(both) else None


def _digests(ids: list[int], decoded: bytes) -> tuple[int, str, str]:
    return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded).hexdigest())


_STATE = [("chunk", pa.int32()), ("chunks", pa.int32()), ("starts", pa.int64()), ("ends_at", pa.int64()),
          ("ends", pa.binary()), ("ids", pa.binary()), ("per", pa.binary()), ("text", pa.string()),
          ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
_STATE_DDL = ("chunk int, chunks int, starts bigint, ends_at bigint, ends binary, ids binary, per binary, text string, "
              "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode_chunks(chunks: DataFrame, keys: list[str], ranks_path: str, pattern: str, keep_ids: bool) -> DataFrame:
    """Ids of each chunk. A document of one chunk is finished here; of the others the pre-token ends, the ids and their
    number per pre-token go on, as packed arrays, and the text for the case that its chunks do not meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coding = coder(ranks_path, pattern)
        for batch in batches:
            rows = []
            for number, count, start, text in zip(*(batch.column(c).to_pylist() for c in ("chunk", "chunks", "starts", "text")), strict=True):
                where, tokens = coding.pieces(text)
                flat = list(chain.from_iterable(tokens))
                packed = np.array(flat, dtype=np.int32).tobytes() if count > 1 or keep_ids else None
                if count == 1:
                    rows.append((number, count, start, start + len(text), None, packed, None, None, *_digests(flat, coding.decode(flat))))
                else:
                    per = np.array(list(map(len, tokens)), dtype=np.int32).tobytes()
                    rows.append((number, count, start, start + len(text), (where + start).tobytes(), packed, per, text, None, None, None))
            yield _batch(rows, _STATE, {k: batch.column(k) for k in keys})

    return chunks.mapInArrow(run, f"{_ddl(chunks, keys)}, {_STATE_DDL}")


def _ddl(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)


def _batch(rows: list[tuple], fields: list[tuple[str, pa.DataType]], keys: dict[str, pa.Array]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    made = [pa.array(list(c), t) for c, (_, t) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays([*keys.values(), *made], names=[*keys, *(n for n, _ in fields)])


def join_chunks(parts: list[dict], coding: Coder) -> list[int]:
    """Ids of one document from its chunks, in order."""
    ends = [np.frombuffer(p["ends"], np.int64) for p in parts]
    cuts = [0]
    for left, right, a, b in zip(parts, parts[1:], ends, ends[1:], strict=False):
        cut = common_boundary(a[:-1], b, right["starts"], left["ends_at"] - LOOKAHEAD)
        if cut is None or cut < cuts[-1]:
            text = "".join(p["text"][: q["starts"] - p["starts"]] for p, q in zip(parts, parts[1:], strict=False)) + parts[-1]["text"]
            return list(chain.from_iterable(coding.pieces(text)[1]))
        cuts.append(cut)
    cuts.append(int(ends[-1][-1]))
    out = []
    for part, where, begin, stop in zip(parts, ends, cuts, cuts[1:], strict=False):
        first, last = np.searchsorted(where, [begin, stop], side="right")
        offsets = np.concatenate([[0], np.cumsum(np.frombuffer(part["per"], np.int32))])
        out.extend(np.frombuffer(part["ids"], np.int32)[offsets[first]: offsets[last]].tolist())
    return out


def stitch_documents(coded: DataFrame, keys: list[str], ranks_path: str, pattern: str, keep_ids: bool) -> DataFrame:
    """One row per document. Chunks meet by row key, sorted, so a task holds one document's chunks at a time."""
    fields = _STATE[-3:] + [("ids", pa.list_(pa.int32()))] * keep_ids
    ddl = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coding = coder(ranks_path, pattern)
        held: list[dict] = []
        for batch in batches:
            rows, at = [], []
            for i, row in enumerate(batch.to_pylist()):
                if row["chunks"] > 1:
                    held.append(row)
                    if len(held) < row["chunks"]:
                        continue
                    ids = join_chunks(held, coding)
                    done = _digests(ids, coding.decode(ids))
                    held = []
                else:
                    ids = np.frombuffer(row["ids"], np.int32).tolist() if keep_ids else None
                    done = (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"])
                rows.append((*done, ids) if keep_ids else done)
                at.append(i)
            take = pa.array(at, pa.int64())
            yield _batch(rows, fields, {k: batch.column(k).take(take) for k in keys})

    parts = coded.repartition("row_key").sortWithinPartitions("row_key", "chunk")
    return parts.mapInArrow(run, f"{_ddl(coded, keys)}, {ddl}")


def overlapping_chunks(docs: DataFrame, keys: list[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Keys, chunk, chunks, starts, text: chunk k has the code points from k * chunk - overlap (0 for the first)
    up to (k + 1) * chunk + overlap."""
    count = F.greatest(F.lit(1), F.ceil(F.length("text") / chunk)).cast("int")
    each = docs.select(*keys, "text", count.alias("chunks")).select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    starts = F.greatest(F.lit(0), F.col("chunk") * chunk - overlap)
    cut = F.col("text").substr(starts + 1, (F.col("chunk") + 1) * chunk + overlap - starts)
    return each.select(*keys, "chunk", "chunks", starts.cast("bigint").alias("starts"),
                       F.when(F.col("chunks") == 1, F.col("text")).otherwise(cut).alias("text"))


def encode(docs: DataFrame, ids: list[str], ranks_path: str | None = None, pattern: str = PATTERN, chunk: int = CHUNK,
           overlap: int = OVERLAP, keep_ids: bool = False) -> DataFrame:
    """The columns ``ids`` of each row, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 and,
    with ``keep_ids``, the ids of its ``text``. ``ranks_path`` is read on the executors, where the vocabulary is installed."""
    ranks_path = ranks_path or tokenizer_path(RANKS)
    narrow_batches(docs.sparkSession, 256)
    keys = ["row_key", *ids]
    keyed = row_keyed(docs.select(*ids, null_to_empty().alias("text")))
    coded = encode_chunks(overlapping_chunks(keyed, keys, chunk, overlap), keys, ranks_path, pattern, keep_ids)
    return stitch_documents(coded, keys, ranks_path, pattern, keep_ids).drop("row_key")


def decode(ids_column: str = "ids", ranks_path: str | None = None, pattern: str = PATTERN):
    """Column of the bytes that an array of ids stands for."""
    ranks_path = ranks_path or tokenizer_path(RANKS)

    def run(batch: pa.Array) -> pa.Array:
        coding = coder(ranks_path, pattern)
        return pa.array([None if ids is None else coding.decode(ids) for ids in batch.to_pylist()], pa.binary())

    return F.arrow_udf(run, "binary")(ids_column)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage of the pipeline: doc_id and the digests of its ids."""
    return encode(docs, ["doc_id"])


def op4_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read(spark, sf_dir, "documents"), ["doc_id"])
