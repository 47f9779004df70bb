"""Packing of tokenised documents into fixed windows by best-fit decreasing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import chunks, lean
from concord.llm.tokens import byte_bpe, encoder

#: Columns of the result besides the id.
PIECE = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class OpenWindows:
    """Open windows by remaining capacity: a segment tree whose leaf ``c`` counts windows with ``c`` tokens left.

    ``take(need)`` finds the tightest window, the smallest remaining capacity of at least ``need``, in
    O(log window) steps; windows of equal capacity are taken last in, first out.
    """

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)
        self.held: list[list[int]] = [[] for _ in range(self.size)]

    def _add(self, capacity: int, by: int) -> None:
        i = capacity + self.size
        while i:
            self.tree[i] += by
            i >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.held[capacity].append(window)
        self._add(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, window) of the tightest open window, removed; None if none fits."""
        i = need + self.size
        if not self.tree[i]:
            # climb until a right sibling holds a window, then go down to its leftmost leaf
            while i > 1 and (i & 1 or not self.tree[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.tree[2 * i] else 2 * i + 1
        capacity = i - self.size
        window = self.held[capacity].pop()
        self._add(capacity, -1)
        return capacity, window


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """Window and offset of each piece (1 to ``window`` tokens), by best-fit decreasing; the number of windows."""
    where, offset, n = [0] * len(lengths), [0] * len(lengths), 0
    tree = OpenWindows(window)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        found = tree.take(need)
        if found is None:
            found, n = (window, n), n + 1
        capacity, where[i] = found
        offset[i] = window - capacity
        if capacity > need:
            tree.put(capacity - need, where[i])
    return where, offset, n


def close_gaps(pieces: list[tuple], window: int) -> list[tuple]:
    """Pieces (doc, start, ids, total) packed into rows (…, window number, offset) with no gap but in one window.

    Best-fit decreasing first. What it leaves open is closed by cutting: the pieces of the emptiest windows are
    cut to fill the gaps of the fullest. The tokens left at last go to windows whose lengths are powers of two,
    which need no padding.
    """
    where, offset, n = best_fit([len(p[2]) for p in pieces], window)
    held: list[list[int]] = [[] for _ in range(n)]
    for i, w in enumerate(where):
        held[w].append(i)
    fill = [sum(len(pieces[i][2]) for i in h) for h in held]
    rows = []
    # fullest windows are kept, as many as all tokens can fill; the others' pieces are dealt into their gaps
    order = sorted(range(n), key=lambda w: -fill[w])
    keep = sum(fill) // window
    for k, w in enumerate(order[:keep]):
        rows += [(*pieces[i], k, offset[i]) for i in held[w]]
    gaps = [(k, fill[w]) for k, w in enumerate(order[:keep]) if fill[w] < window]
    left = sum(fill) - keep * window
    for bit in reversed(range(window.bit_length())):
        if left >> bit & 1:
            gaps.append((keep, window - (1 << bit)))
            keep += 1
    gap = iter(gaps)
    number, at = next(gap, (0, window))
    tail = {k: s for k, s in gaps if k >= sum(fill) // window}
    for w in order[sum(fill) // window:]:
        for i in held[w]:
            doc, start, ids, total = pieces[i]
            while len(ids):
                if at == window:
                    number, at = next(gap)
                cut = min(len(ids), window - at)
                rows.append((doc, start, ids[:cut], total, number, at - tail.get(number, 0)))
                start, ids, at = start + cut, ids[cut:], at + cut
    return rows


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1,
         ranks: str | None = None, batch_tokens: int = 1_000_000) -> DataFrame:
    """Pack whole documents into windows of ``window`` tokens; one row per piece.

    A document is its text's token ids (strings of added tokens as these) and then ``end_id``. Documents longer than a window are first cut into full
    windows; the remainders of a batch are placed by best-fit decreasing, and the gaps are closed by cutting (see
    :func:`close_gaps`). Each task packs its own rows in batches of about ``batch_tokens`` remainder tokens: no
    shuffle, memory bounded by the batch and the longest text. ``sequence_id`` is the task's number times 2^33
    plus a running number, so a task that runs again gives the same rows.

    Columns: the id, ``start`` (ids of the document before the piece), ``length``, ``ids`` (little-endian uint32),
    ``doc_tokens``, ``sequence_id``, ``offset``. A null or empty text is one piece that holds only ``end_id``;
    null and repeated ids are packed like others; other columns are ignored; an empty table gives no rows.
    """
    ranks = ranks or byte_bpe()
    id_type = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(ranks).ids
        names = [id_col, *(c.split()[0] for c in PIECE.split(", "))]
        types = [None, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        base, number = TaskContext.get().partitionId() << 33, 0

        def out(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            for a, b in chunks(len(rows), 20_000):
                part = rows[a:b]
                cols = [[r[0] for r in part], [r[1] for r in part], [len(r[2]) for r in part],
                        [r[2].astype("<u4", copy=False).tobytes() for r in part], [r[3] for r in part],
                        [base + number + r[4] for r in part], [r[5] for r in part]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t or key) for c, t in zip(cols, types)], names)

        rest: list[tuple] = []
        full: list[tuple] = []
        size, key = 0, None
        for batch in batches:
            key = batch.schema.field(0).type
            for a, b in chunks(batch.num_rows, 256):
                part = batch.slice(a, b - a)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.append(encode(text, added=True), np.uint32(end_id))
                    whole = len(ids) // window * window
                    full += [(doc, s, ids[s:s + window], len(ids), k, 0)
                             for k, s in enumerate(range(0, whole, window), len(full))]
                    if whole < len(ids):
                        rest.append((doc, whole, ids[whole:].copy(), len(ids)))
                        size += len(ids) - whole
                if len(full) * window + size >= batch_tokens or size >= batch_tokens:
                    yield from out(full)
                    number, full = number + len(full), []
                if size >= batch_tokens:
                    rows = close_gaps(rest, window)
                    yield from out(rows)
                    number, rest, size = number + max(r[4] for r in rows) + 1, [], 0
        if full:
            yield from out(full)
            number += len(full)
        if rest:
            yield from out(close_gaps(rest, window))

    schema = f"`{id_col}` {id_type.simpleString()}, {PIECE}"
    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(lean(run), schema)
