"""Periodic runs of words: internal pattern matching of dyadic blocks by range successors over a suffix array."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import lean

#: Words of documents that are searched together; a longer document is searched alone.
GROUP_WORDS = 1 << 17
#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4


class WaveletMatrix:
    """Values below ``2 ** bits`` in packed bit planes, for rank and quantile queries on many ranges at once."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.planes: list[tuple[np.ndarray, np.ndarray, int]] = []
        for b in range(self.bits - 1, -1, -1):
            bit = (values >> b & 1).astype(bool)
            words = np.zeros(n // 64 + 1, np.uint64)
            words.view(np.uint8)[:(n + 7) // 8] = np.packbits(bit, bitorder="little")
            ones = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]))
            self.planes.append((words, ones, n - int(bit.sum())))
            values = np.concatenate((values[~bit], values[bit]))

    @staticmethod
    def _ones(plane: tuple[np.ndarray, np.ndarray, int], i: np.ndarray) -> np.ndarray:
        """Set bits before each place ``i``."""
        words, ones, _ = plane
        at = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return ones[at] + np.bitwise_count(words[at] & mask)

    def below(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many values of each range [lo, hi) are below ``value``."""
        out = np.zeros(len(lo), np.int64)
        for level, plane in enumerate(self.planes):
            a, b = self._ones(plane, lo), self._ones(plane, hi)
            one = (value >> (self.bits - 1 - level) & 1).astype(bool)
            out += np.where(one, (hi - lo) - (b - a), 0)
            lo, hi = np.where(one, plane[2] + a, lo - a), np.where(one, plane[2] + b, hi - b)
        return out

    def quantile(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) of each range; k must lie within the range."""
        out = np.zeros(len(lo), np.int64)
        for plane in self.planes:
            a, b = self._ones(plane, lo), self._ones(plane, hi)
            zeros = (hi - lo) - (b - a)
            one = k >= zeros
            out = out << 1 | one
            k = np.where(one, k - zeros, k)
            lo, hi = np.where(one, plane[2] + a, lo - a), np.where(one, plane[2] + b, hi - b)
        return out


def block_intervals(codes: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The suffix array of ``codes`` (sorted by prefix doubling as deep as ``longest`` words or until all differ), and for every
    block length 2, 4, ... up to ``longest`` the aligned blocks that occur again: (length, starts, lo, hi), where the suffixes that
    begin with a block stand at [lo, hi) of the array."""
    n = len(codes)
    # rank: number of suffixes with a smaller prefix of the present length, equal for equal prefixes
    order = np.argsort(codes, kind="stable")
    first = np.concatenate(([True], codes[order][1:] != codes[order][:-1]))
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    blocks = []
    length = 1
    while length < longest:
        # only prefixes that occur more than once need a longer look
        size = np.bincount(rank, minlength=n)
        tied = np.flatnonzero(size[rank] > 1)
        if not len(tied):
            break
        ahead = tied + length
        key = rank[tied] * (n + 1) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        sorted_key, sorted_rank = key[by], rank[tied][by]
        place = np.arange(len(by))
        new_class = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
        new_rank = np.concatenate(([True], sorted_rank[1:] != sorted_rank[:-1]))
        begin = np.maximum.accumulate(np.where(new_class, place, 0))
        base = np.maximum.accumulate(np.where(new_rank, place, 0))
        rank[tied[by]] = sorted_rank + begin - base
        length *= 2
        at = tied[(tied % length == 0) & (tied + length <= n)]
        size = np.bincount(rank[tied], minlength=n)
        at = at[size[rank[at]] > 1]
        if len(at):
            blocks.append((length, at, rank[at], rank[at] + size[rank[at]]))
    return np.argsort(rank, kind="stable"), blocks


def candidate_periods(codes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks and distances to their next or last occurrence, where that is at most a block's length away.

    A run of period q and at least max(6, 4 q) words holds an aligned block of 2^k words, q <= 2^k < 2 q (for q = 1: 2 words),
    that occurs again within the run exactly q words later or earlier: occurrences of a block at least as long as the
    period form one progression with that difference.
    """
    if len(codes) < LEAST_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    suffixes, blocks = block_intervals(codes, longest)
    starts, periods = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    tree = WaveletMatrix(suffixes) if blocks else None
    for length, at, lo, hi in blocks:
        place = tree.below(lo, hi, at)
        for has, step in ((place + 1 < hi - lo, 1), (place > 0, -1)):
            found = tree.quantile(lo[has], hi[has], place[has] + step)
            gap = np.abs(found - at[has])
            near = gap <= length
            starts.append(at[has][near])
            periods.append(gap[near])
    return np.concatenate(starts), np.concatenate(periods)


def _agree(codes: np.ndarray, a: int, b: int, lo: int, hi: int, back: bool) -> int:
    """How many places codes[a..] and codes[b..] (a < b) agree, forwards within ``hi`` or backwards (before a and b) within ``lo``."""
    most, done, step = (a - lo if back else hi - b), 0, 64
    while done < most:
        m = min(step, most - done)
        if back:
            differ = codes[a - done - m:a - done] != codes[b - done - m:b - done]
            differ = differ[::-1]
        else:
            differ = codes[a + done:a + done + m] != codes[b + done:b + done + m]
        k = int(differ.argmax())
        if differ[k]:
            return done + k
        done, step = done + m, step * 2
    return done


def find_runs(codes: np.ndarray, bounds: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of every document, sorted; document d is codes[bounds[d]:bounds[d + 1]].

    No code may occur in two documents. Each candidate is checked word by word, so all that is returned is exact.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    widest = int(np.diff(bounds).max(initial=0)) // LEAST_PERIODS
    longest = max(2, 1 << max(0, widest - 1).bit_length())
    starts, periods = candidate_periods(codes, longest)
    if not len(starts):
        return out
    by = np.lexsort((starts, periods))
    owner = np.searchsorted(bounds, starts, side="right") - 1
    last_period, covered = 0, -1
    for i in by.tolist():
        s, q, d = int(starts[i]), int(periods[i]), int(owner[i])
        if q != last_period:
            last_period, covered = q, -1
        if s < covered:
            continue
        lo, hi = int(bounds[d]), int(bounds[d + 1])
        if s + q >= hi:
            s -= q
        begin = s - _agree(codes, s, s + q, lo, hi, True)
        end = s + q + _agree(codes, s, s + q, lo, hi, False)
        if end - begin >= max(LEAST_WORDS, LEAST_PERIODS * q):
            out[d].append((begin - lo, end - begin, q))
            covered = end - q + 1
    for d, found in enumerate(out):
        out[d] = sorted(set(found), key=lambda r: (r[0], r[2]))
    return out


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words after the contract's periodic rewriting of every tenth document; a null id leaves them as they are."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * -(-(n - a) // p))[:n - a]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop).tolist()) if not d]


def search(documents: list[list[bytes]], group_words: int = GROUP_WORDS) -> list[list[tuple[int, int, int]]]:
    """Runs of each document's words; documents are searched together up to ``group_words`` words, longer ones alone."""
    out: list[list[tuple[int, int, int]]] = []
    parts: list[np.ndarray] = []
    base = total = 0

    def close() -> None:
        nonlocal parts, base, total
        if parts:
            bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            out.extend(find_runs(np.concatenate(parts), bounds))
        parts, base, total = [], 0, 0

    for words in documents:
        if total + len(words) > group_words:
            close()
        number = dict(zip(dict.fromkeys(words), range(base, base + len(words))))  # own numbers for every document
        parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        base += len(number)
        total += len(words)
    close()
    return out


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: bool = False) -> DataFrame:
    """Runs of repeated word sequences in every row's whole text; one row per row, found in the task that reads it.

    Words are runs without ASCII white space. A run is a maximal stretch with smallest period q whose words q apart are
    equal, of at least max(6, 4 q) words. Columns: the id, ``runs`` (array of start, length, period, by start, then
    period), ``collapsed`` (the words that no run holds after its first period, joined by one space). ``rewrite`` first
    applies :func:`planted` (ids must be integers). Null and empty texts have no run and an empty ``collapsed``; null
    and repeated ids are rows like others; other columns are ignored; an empty table gives no rows. Memory is bounded by
    a batch and the longest text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                words = [(t or b"").split() for t in part.column(1).cast(pa.binary()).to_pylist()]
                if rewrite:
                    words = [planted(w, i) for w, i in zip(words, part.column(0).to_pylist())]
                found = search(words)
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found], _RUNS),
                    pa.array([b" ".join(collapse(w, r)).decode() for w, r in zip(words, found)], pa.string()),
                ], [id_col, "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(
        lean(run), f"`{id_col}` {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
