"""Periodic runs of words by Baier grouping.

A run is a stretch of consecutive words with a smallest period q (words q apart are identical) that no neighbouring word extends; those
of at least max(``min_length``, ``min_periods`` * q) words are found.

1. ``repeating_stretches`` cuts a text where no run can be: each three consecutive words of a run of four periods (of six words, for
   period 1) occur three times or more in it, so a run lies inside a stretch whose every three words do. The counts are taken again
   inside the stretches until nothing more is cut. No run is lost or shortened by it; ``cut=False`` leaves it out.
2. ``lyndon_array`` is phase one of Baier's suffix sorter. Suffixes are grouped by their first word; groups are taken from the highest
   to the lowest; each member ends the growth of its own block and is appended to the block on its left, whose suffix moves into a new
   group right behind its old one, further behind the more copies it took. The word a suffix's group stands for when its turn comes
   is its longest Lyndon prefix. Phase two, the sorting itself, is not needed.
3. Every run has a Lyndon root under the order of words or under the reverse order, and such a root is the longest Lyndon word at its
   first place. With four periods the next place of the same length follows it directly, which leaves few candidates; longest common
   extensions (LCE) to both sides, found by a binary search on hashes of prefixes, turn them into runs, and each run is compared word by
   word before it is returned.

All of it works inside a map over batches of documents: nothing is shuffled, and a text is held by one task only.

Results by case: a null text is an empty one, without words and runs; a document with a null doc_id keeps its words as they are; equal
rows give equal rows; an empty table gives no rows; further columns are ignored. A text of any length is searched whole: memory follows
its words (some 150 bytes each at most), time n log n.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from nextclick.llm.common import narrow_batches, null_to_empty, read

MIN_LENGTH, MIN_PERIODS = 6, 4
#: Prime below 2^31 (products of two residues fit 64 bits) and the two bases of the prefix hashes.
PRIME, BASES = (1 << 31) - 1, (911_382_323, 1_972_663_367)


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """Start and period of the words that the contract makes periodic in this document, if any."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    a = g % n
    return (a, 1 + (n - a) // (3 + g % 8)) if h % 10 == 0 else None


def _names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One small number per different pair."""
    return np.unique(left.astype(np.int64) * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def repeating_stretches(words: np.ndarray, piece: np.ndarray, rounds: int = 8) -> list[tuple[int, int]]:
    """(begin, end) of the stretches of at least MIN_LENGTH words of one text, every three words of which occur three times or more in
    the stretch (as far as ``rounds`` of cutting go). ``piece`` numbers the texts; equal words of different texts differ in ``words``."""
    if len(words) < MIN_LENGTH:
        return []
    three = _names(_names(words[:-2], words[1:-1]), words[2:])
    at = np.arange(len(words))
    for done in range(rounds):
        name = _names(three[at[:-2]], piece[:-2]) if done else three
        whole = piece[:-2] == piece[2:]
        often = whole & (np.bincount(name[whole], minlength=len(name))[name] >= 3)
        first = np.flatnonzero(often & np.r_[True, ~often[:-1]])
        last = np.flatnonzero(often & np.r_[~often[1:], True]) + 3
        long = last - first >= MIN_LENGTH
        first, size = first[long], (last - first)[long]
        settled = (size - 2).sum() == whole.sum()
        take = np.repeat(first - np.r_[0, np.cumsum(size)[:-1]][: len(size)], size) + np.arange(size.sum())
        at, piece = at[take], np.repeat(np.arange(len(first)), size)
        if settled or not len(at):
            break
    begins = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]][: len(at)])
    ends = np.r_[begins[1:], len(at)][: len(begins)]
    return [(int(at[b]), int(at[e - 1]) + 1) for b, e in zip(begins, ends, strict=True)]


def lyndon_array(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place, for words given by their ranks 0, 1, ... (each in use)."""
    n, kinds = len(ranks), max(ranks, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(kinds)]
    for i, r in enumerate(ranks):
        members[r].append(i)
    group = list(ranks)                    # group of each place whose block still grows
    length = [1] * kinds                   # words that the members of a group have in common: their blocks
    below, above = list(range(-1, kinds - 1)), [*range(1, kinds), -1][:kinds]
    left = list(range(-1, n))              # begin of the block before the one that begins here
    out = [0] * n
    top = kinds - 1
    while top >= 0:
        u = length[top]
        grown: dict[tuple[int, int], list[int]] = {}
        last, copies = -1, 0
        for i in members[top]:             # ascending
            if group[i] != top:
                continue                   # it has moved on
            out[i] = u
            j = left[i]
            left[i + u] = j
            if j == last:
                copies += 1
            else:
                if last >= 0:
                    grown.setdefault((group[last], copies), []).append(last)
                last, copies = j, 1
        if last >= 0:
            grown.setdefault((group[last], copies), []).append(last)
        members[top] = []
        for old, copies in sorted(grown, reverse=True):  # of one old group the fewest copies come last: directly behind it
            places = grown[old, copies]
            new, high = len(members), above[old]
            members.append(places)
            length.append(length[old] + copies * u)
            below.append(old)
            above.append(high)
            above[old] = new
            if high >= 0:
                below[high] = new
            for j in places:
                group[j] = new
        top = below[top]
        if top >= 0:
            above[top] = -1
    return out


class PrefixHashes:
    """Hashes of all prefixes, from which two stretches of equal length are compared at once."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words, self.sums, self.powers = words, [], []
        for base in BASES:
            power = np.ones(n + 1, np.int64)
            size, step = 1, base
            while size <= n:
                more = min(size, n + 1 - size)
                power[size: size + more] = power[:more] * step % PRIME
                size, step = size + more, step * step % PRIME
            self.powers.append(power)
            self.sums.append(np.r_[0, np.cumsum(words * power[:n] % PRIME)] % PRIME)

    def same(self, at: np.ndarray, length: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Are the ``length`` words from ``at`` those from ``at + shift``?"""
        out = np.ones(len(at), bool)
        for total, power in zip(self.sums, self.powers, strict=True):
            left, right = total[at + length] - total[at], total[at + shift + length] - total[at + shift]
            out &= left % PRIME * power[shift] % PRIME == right % PRIME
        return out

    def extension(self, at: np.ndarray, shift: np.ndarray, back: bool) -> np.ndarray:
        """Longest common extension of the places ``at`` and ``at + shift``: to the right, or of what ends before them to the left."""
        room = at if back else len(self.words) - at - shift
        out = np.zeros(len(at), np.int64)
        step = 1 << int(room.max(initial=0)).bit_length()
        while step := step >> 1:
            more = out + step
            fits = np.flatnonzero(more <= room)
            begin = at[fits] - more[fits] if back else at[fits]
            out[fits] += step * self.same(begin, more[fits], shift[fits])
        return out


def lyndon_runs(words: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Rows (begin, end, period) of the runs of one text. ``ranks`` order its words; rank 0 stands for the ends of its parts, which
    differ from each other in ``words``, so that no run goes past one."""
    hashes = PrefixHashes(words)
    found = []
    for order in (ranks, np.where(ranks > 0, ranks.max(initial=0) + 1 - ranks, 0)):
        lyndon = np.array(lyndon_array(order.tolist()), np.int64)
        at = np.flatnonzero(ranks > 0)
        period = lyndon[at]
        follows = at + 2 * period <= len(words)
        at, period = at[follows], period[follows]
        again = lyndon[at + period] == period
        at, period = at[again], period[again]
        if not len(at):
            continue
        begin = at - hashes.extension(at, period, back=True)
        end = at + period + hashes.extension(at, period, back=False)
        long = end - begin >= np.maximum(MIN_LENGTH, MIN_PERIODS * period)
        found.append(np.stack([begin, end, period, at], axis=1)[long])
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = np.concatenate(found)
    rows = rows[np.unique(rows[:, :3], axis=0, return_index=True)[1]]
    for row in rows:  # words decide, not hashes
        begin, end, period, at = row
        off = begin + np.flatnonzero(words[begin: end - period] != words[begin + period: end])
        row[0] = off[off < at].max(initial=begin - 1) + 1
        row[1] = off[off >= at].min(initial=end - period) + period
    rows = rows[rows[:, 1] - rows[:, 0] >= np.maximum(MIN_LENGTH, MIN_PERIODS * rows[:, 2])]
    return np.unique(rows[:, :3], axis=0)


def find_runs(texts: list[np.ndarray], cut: bool = True) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start, then period. ``texts`` hold the numbers of their words, equal words
    of different texts with different numbers."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.r_[0, np.cumsum(sizes)]
    words = np.concatenate([*texts, np.zeros(0, np.int64)]).astype(np.int64)
    if cut:
        stretches = repeating_stretches(words, np.repeat(np.arange(len(texts)), sizes))
    else:
        stretches = [(int(b), int(e)) for b, e in zip(starts, starts[1:], strict=False) if e - b >= MIN_LENGTH]
    if not stretches:
        return out
    kinds, named = np.unique(np.concatenate([words[b:e] for b, e in stretches]), return_inverse=True)
    lengths = np.array([e - b for b, e in stretches])
    # every stretch is followed by an end of its own
    place = np.arange(lengths.sum()) + np.repeat(np.arange(len(stretches)), lengths)
    joined = np.arange(len(place) + len(stretches), dtype=np.int64) + len(kinds) + 1
    joined[place] = named + 1
    ranks = np.zeros(len(joined), np.int64)
    ranks[place] = named + 1
    offsets = np.r_[0, np.cumsum(lengths + 1)]
    rows = lyndon_runs(joined, ranks)
    part = np.searchsorted(offsets, rows[:, 0], side="right") - 1
    for (begin, end, period), k in zip(rows.tolist(), part.tolist(), strict=True):
        at = stretches[k][0] + begin - int(offsets[k])
        text = int(np.searchsorted(starts, at, side="right")) - 1
        out[text].append((at - int(starts[text]), end - begin, period))
    return [sorted(set(r), key=lambda x: (x[0], x[2])) for r in out]


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length / period, compared exactly; of equal ones the first, then the one of the smallest period."""
    best = None
    for run in runs:
        if best is None or (run[1] * best[2], -run[0], -run[2]) > (best[1] * run[2], -best[0], -best[2]):
            best = run
    return best


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """False for the words that a run repeats: those after its first period."""
    edge = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


RESULT = [("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()),
          ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]


def _results(ids: list, texts: list[str], plant: bool, cut: bool) -> list[tuple]:
    spoken, numbers, fresh = [], [], count()
    for doc_id, text in zip(ids, texts, strict=True):
        said = text.encode().split()  # of bytes: at ASCII white space only
        where = planted(doc_id, len(said)) if plant else None
        if where:
            a, p = where
            said = said[:a] + (said[a: a + p] * ((len(said) - a) // p + 1))[: len(said) - a]
        known: defaultdict[bytes, int] = defaultdict(fresh.__next__)
        spoken.append(said)
        numbers.append(np.fromiter(map(known.__getitem__, said), np.int64, len(said)))
    rows = []
    for said, runs in zip(spoken, find_runs(numbers, cut), strict=True):
        best = best_run(runs) or (None, None, None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = said if not runs else [w for w, k in zip(said, kept_words(len(said), runs).tolist(), strict=True) if k]
        rows.append((len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(listed.encode()).hexdigest(),
                     hashlib.sha256(b" ".join(kept)).hexdigest()))
    return rows


def periodic_runs(docs: DataFrame, plant: bool = False, cut: bool = True) -> DataFrame:
    """doc_id, n_runs, the strongest run (start, length, period, exponent_milli; nulls if there is none), and digests of all runs and of
    the text without its repeated periods. ``plant`` makes the words of some documents periodic first, as the contract of the query says."""
    narrow_batches(docs.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            rows = _results(ids.to_pylist(), batch.column("text").to_pylist(), plant, cut)
            columns = list(zip(*rows, strict=True)) or [()] * len(RESULT)
            made = [pa.array(list(c), t) for c, (_, t) in zip(columns, RESULT, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *made], names=["doc_id", *(n for n, _ in RESULT)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", null_to_empty().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
             "runs_sha256 string, collapsed_sha256 string")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(read(spark, sf_dir, "documents"), plant=True)
