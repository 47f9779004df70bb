"""Toxicity: a linear classifier over character n-grams that are scaled by their naive Bayes log-count ratios."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import BROADCAST_ROWS, lean, written

#: N-grams are hashed into this many cells, which bounds the model whatever the texts.
CELLS = 1 << 18
#: Lengths of the n-grams in bytes of UTF-8.
SIZES = (3, 4, 5, 6)
#: Pseudo-count of a cell, and the standard errors by which a log-count ratio must differ from 0 to count.
SMOOTHING, CLEAR = 1.0, 3.0

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[[c for c in range(128) if not chr(c).isalnum()]] = 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((x ^ (x >> np.uint64(29))) & np.uint64(CELLS - 1)).astype(np.int32)


class Cells:
    """Distinct cells of a text's n-grams. One marker array per worker stands in for sorting."""

    def __init__(self):
        self.mark = np.zeros(CELLS, np.int32)

    def of(self, text: bytes | None) -> np.ndarray:
        """Cells of the whole text: A-Z in lower case, each run of other ASCII characters than letters and digits as one blank, blanks at both ends."""
        data = _FOLD[np.frombuffer(text or b"", np.uint8)]
        blank = data == 32
        keep = np.ones(len(data), bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        code = np.concatenate(([32], data[keep], [32])).astype(np.uint64)
        h, parts = code, []
        for size in range(2, SIZES[-1] + 1):
            if len(h) < 2:
                break
            h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + code[size - 1:]
            if size in SIZES:
                parts.append(_mixed(h ^ np.uint64(size)))
        cells = np.concatenate(parts) if parts else np.empty(0, np.int32)
        place = np.arange(len(cells), dtype=np.int32)
        self.mark[cells] = place
        return cells[self.mark[cells] == place]


@dataclass
class Model:
    """A weight for every cell (its fitted weight times its log-count ratio) and the offset."""

    weights: np.ndarray
    offset: float

    def score(self, cells: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.offset + self.weights[cells].sum(), -700, 700))))


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes | None]:
    for a in range(0, batch.num_rows, 256):
        yield from batch.column(column).slice(a, 256).cast(pa.binary()).to_pylist()


def log_count_ratios(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Scale of every cell, and rows by label, from all rows of ``train`` (text, label).

    The ratio is log(share of class 1's rows that have the cell / share of class 0's); within ``CLEAR`` standard errors of 0 it is 0.
    A task counts in dense arrays and returns what is not zero; at most ``CELLS`` sums come to the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n, cells = np.zeros((2, CELLS), np.int64), np.zeros(2, np.int64), Cells()
        for batch in batches:
            for text, label in zip(_texts(batch, 0), batch.column(1).to_pylist()):
                seen[label, cells.of(text)] += 1
                n[label] += 1
        at = np.flatnonzero(seen.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1).astype(np.int32)), *[
            pa.array(np.append(seen[k, at], n[k])) for k in (0, 1)]], ["cell", "zero", "one"])

    sums = train.select("text", "label").mapInArrow(lean(count), "cell int, zero long, one long").groupBy("cell").agg(
        F.sum("zero").alias("zero"), F.sum("one").alias("one")).toArrow()
    total, have = np.zeros(2), np.zeros((2, CELLS))
    cell = sums["cell"].to_numpy()
    for k, name in enumerate(("zero", "one")):
        values = sums[name].to_numpy()
        have[k, cell[cell >= 0]] = values[cell >= 0]
        total[k] = values[cell < 0].sum()
    share = (have + SMOOTHING) / (total[:, None] + 2 * SMOOTHING)
    ratio = np.log(share[1] / share[0])
    error = np.sqrt(((1 - share) / (have + SMOOTHING)).sum(0))
    return np.where(np.abs(ratio) > CLEAR * error, ratio, 0.0), total


def _minimise(f: Callable, x: np.ndarray, scale: np.ndarray, steps: int, kept: int = 8) -> np.ndarray:
    """Minimum of a smooth convex function (value and gradient by ``f``) by limited-memory BFGS with ``scale`` as first inverse Hessian."""
    value, slope = f(x)
    past: deque = deque(maxlen=kept)
    for _ in range(steps):
        if np.abs(slope).max() < 1e-4:
            break
        q, alphas = slope.copy(), []
        for s, y, r in reversed(past):
            alphas.append(r * (s @ q))
            q -= alphas[-1] * y
        q *= scale * (1 / (past[-1][2] * (past[-1][1] @ (scale * past[-1][1]))) if past else 1.0)
        for (s, y, r), alpha in zip(past, reversed(alphas)):
            q += (alpha - r * (y @ q)) * s
        step = 1.0
        while True:
            new = x - step * q
            new_value, new_slope = f(new)
            if new_value <= value - 1e-4 * step * (slope @ q) or step < 1e-3:
                break
            step /= 4
        if new_value >= value:
            break
        s, y = new - x, new_slope - slope
        if s @ y > 1e-12:
            past.append((s, y, 1 / (s @ y)))
        x, value, slope = new, new_value, new_slope
    return x


def fit(train: DataFrame, penalty: float = 0.002, steps: int = 15) -> Model:
    """Fit from all rows of ``train`` (``text``, ``label`` 0 or 1).

    Rows keep the cells whose scale is not 0, in a written table; the weights minimise the mean logistic loss plus ``penalty`` / 2 times
    their squares. A step sums the loss and the gradient over all rows in the tasks that read them; tasks' sums are added in a second
    stage, so that only a few arrays of the model's size come to the driver. Without rows of both classes every text gets the share of class 1.
    """
    scale, total = log_count_ratios(train)
    if not total.all():
        share = float(total[1] / total.sum()) if total.sum() else 0.5
        return Model(np.zeros(CELLS), float(np.clip(np.log(share / (1 - share)) if 0 < share < 1 else (share - 0.5) * 1400, -700, 700)))
    used = np.flatnonzero(scale)
    place = np.full(CELLS, -1, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    sc = train.sparkSession.sparkContext
    at = sc.broadcast(place)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells()
        for batch in batches:
            rows = []
            for text in _texts(batch, 0):
                own = at.value[cells.of(text)]
                rows.append(own[own >= 0])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.ListArray.from_arrays(
                np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32), pa.array(np.concatenate(rows) if rows else np.empty(0, np.int32)))],
                ["label", "cells"])

    table = written(train.select("text", "label").mapInArrow(lean(keep), "label int, cells array<int>"), "ngrams")
    r, n = scale[used], total.sum()

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        model = sc.broadcast((x[:-1] * r, x[-1]))

        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, offset = model.value
            sums = np.zeros(len(weights) + 2)
            for batch in batches:
                for a in range(0, batch.num_rows, 4096):
                    rows = batch.slice(a, 4096)
                    cells, label = rows.column(1).flatten().to_numpy(), rows.column(0).to_numpy()
                    size = np.diff(rows.column(1).offsets.to_numpy())
                    owner = np.repeat(np.arange(len(label)), size)
                    z = offset + np.bincount(owner, weights[cells], len(label))
                    p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
                    sums[:-2] += np.bincount(cells, (p - label)[owner], len(weights))
                    sums[-2] += (p - label).sum()
                    sums[-1] += (np.logaddexp(0, z) - label * z).sum()
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % 8], pa.int32()), pa.array([sums.tobytes()])], ["part", "sums"])

        def add(group: pa.Table) -> pa.Table:
            return pa.table({"sums": pa.array([sum(np.frombuffer(s) for s in group["sums"].to_pylist()).tobytes()])})

        parts = table.mapInArrow(part, "part int, sums binary").groupBy("part").applyInArrow(add, "sums binary").collect()
        model.destroy()
        sums = sum(np.frombuffer(p["sums"]) for p in parts)
        slope = np.append(sums[:-2] * r / n + penalty * x[:-1], sums[-2] / n)
        return sums[-1] / n + penalty / 2 * float(x[:-1] @ x[:-1]), slope

    first = np.append(np.zeros(len(used)), np.log(total[1] / total[0]))
    x = _minimise(loss, first, np.append(np.full(len(used), 1.0), 4.0), steps)
    weights = np.zeros(CELLS)
    weights[used] = x[:-1] * r
    return Model(weights, float(x[-1]))


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text leaves 2 when divided by 4; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``text`` and ``label`` of labelled rows outside the held-out fold, as a written table. Ids whose labels are null or contradict each
    other are left out. Labels counted under ``BROADCAST_ROWS`` are broadcast; with more, texts are shuffled once."""
    clear = written(labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(
        F.min(label_col).cast("int").alias("_label"), F.max(label_col).alias("_other")).where("_label = _other").select(F.col(id_col).alias("_id"), "_label"), "labels")
    clear = F.broadcast(clear) if clear.count() <= BROADCAST_ROWS else clear
    rows = docs.where(~held_out(id_col)).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.join(clear, "_id").select("text", F.col("_label").alias("label")), "train")


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The id, ``held_out``, ``score`` (0 to 1) and ``predicted`` of every row's whole text, scored where it is read.

    Only the text enters a score. Null and empty texts are scored as the empty text; null and repeated ids are scored like others (equal
    texts score alike); without labels of both classes all texts get the share of class 1; other columns are ignored; an empty table gives no rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(train_rows(docs, labels, id_col, text_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells()
        for batch in batches:
            scores = pa.array([model.value.score(cells.of(t)) for t in _texts(batch, 2)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), scores], [id_col, "held_out", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(id_col, held_out(id_col).alias("held_out"), F.col(text_col).cast("string")).mapInArrow(
        lean(run), f"`{id_col}` {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
