"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import lean, written

STATISTICS = ("log_chars", "log_word_length", "upper", "digit", "punctuation", "symbol", "bar", "bang", "newline",
              "non_ascii", "entropy", "vocabulary", "echo", "line_variety", "stop_end")

_CLASSES = np.zeros((9, 256))
for _row, _chars in enumerate((
        "".join(map(chr, range(65, 91))), "0123456789", ".,;:'\"-()?", "#$%&*@^~_=+<>{}[]\\/`", "|", "!", "\n", " \t\r")):
    _CLASSES[_row, [ord(c) for c in _chars]] = 1
_CLASSES[8, 128:] = 1


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text; a null text counts as empty."""
    data = (text or "").encode()
    n = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, digit, dots, symbol, bar, bang, newline, _, high = _CLASSES @ counts
    words = data.split()
    k = len(words)
    share = lambda c, of: math.log((c + 0.5) / (of + 1))
    p = counts[counts > 0] / max(n, 1)
    lines = data.split(b"\n")
    return [
        math.log1p(n), math.log((n + 1) / (k + 1)), share(upper, n), share(digit, n), share(dots, n), share(symbol, n),
        share(bar, n), share(bang, n), share(newline, n), share(high, n), float(-(p * np.log(p)).sum()),
        math.log((len(set(words)) + 1) / (k + 1)), share(sum(map(eq, words, words[1:])), k),
        math.log(len(set(lines)) / len(lines)), share(sum(w.endswith((b".", b",")) for w in words), k),
    ]


def _matrix(texts: pa.Array) -> np.ndarray:
    rows: list[list[float]] = []
    for a in range(0, len(texts), 256):
        rows += [statistics(t) for t in texts.slice(a, 256).to_pylist()]
    return np.array(rows, dtype=float).reshape(len(rows), len(STATISTICS))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``stats`` (array of double, as in ``STATISTICS``) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_matrix(batch.column(1)).tolist(), pa.list_(pa.float64()))], [id_col, "stats"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(lean(run), f"`{id_col}` {kind}, stats array<double>")


@dataclass
class Discriminant:
    """Per class: mean, inverse Cholesky factor of the shrunk covariance, and log prior less half log determinant."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    offsets: list[float]
    share: float  # of class 1; the score if a class is missing

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 from the difference of the Mahalanobis log densities."""
        if not self.factors or not len(x):
            return np.full(len(x), self.share)
        density = [o - 0.5 * (((x - m) @ f.T) ** 2).sum(1) for m, f, o in zip(self.means, self.factors, self.offsets)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(train: DataFrame, shrink: float = 0.1, ridge: float = 0.02) -> Discriminant:
    """Fit from all rows of ``train`` (stats, label 0 or 1).

    One grouping sums counts, first and second moments by class; only these sums come to the driver. A class's
    covariance is shrunk by ``shrink`` towards the pooled one and by ``ridge`` towards its mean variance. Without
    rows of both classes the model scores every text with the share of class 1 (0.5 without rows).
    """
    d = len(STATISTICS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            label = batch.column(1).to_numpy(zero_copy_only=False)
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for c in (0, 1):
                own = x[label == c]
                sums[c] += np.concatenate(([len(own)], own.sum(0), (own.T @ own).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(sums.tolist(), pa.list_(pa.float64()))],
                                         ["label", "sums"])

    parts = train.select("stats", F.col("label").cast("int")).mapInArrow(lean(moments), "label int, sums array<double>")
    total = np.zeros((2, 1 + d + d * d))
    for r in parts.select("label", F.posexplode("sums")).groupBy("label", "pos").agg(F.sum("col").alias("v")).collect():
        total[r["label"], r["pos"]] = r["v"]
    n = total[:, 0]
    if not n.all():
        return Discriminant([], [], [], float(n[1] / n.sum()) if n.sum() else 0.5)
    means = [total[c, 1:1 + d] / n[c] for c in (0, 1)]
    own = [total[c, 1 + d:].reshape(d, d) / n[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    factors, offsets = [], []
    for c in (0, 1):
        cov = (1 - shrink) * own[c] + shrink * pooled
        cov = (1 - ridge) * cov + ridge * max(np.trace(cov) / d, 1e-9) * np.eye(d)
        chol = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(chol))
        offsets.append(float(np.log(n[c] / n.sum()) - np.log(np.diag(chol)).sum()))
    return Discriminant(means, factors, offsets, float(n[1] / n.sum()))


def held_out(id_col: str = "doc_id", folds: int = 5):
    """True where crc32 of the id as text is divisible by ``folds``; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == 0


def train_rows(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """Labelled rows outside the held-out fold. Ids whose labels are null or contradict each other are left out."""
    clear = labels.where(F.col(label_col).isin(0, 1)).groupBy(id_col).agg(
        F.min(label_col).alias("label"), F.max(label_col).alias("_other")).where("label = _other").select(id_col, "label")
    return stats.where(~held_out(id_col)).join(clear, id_col)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.3) -> DataFrame:
    """The id, ``held_out``, ``score`` (0 to 1) and ``predicted`` of every row's whole text.

    Statistics are computed once into a written table; the model is fitted on its labelled rows outside the
    held-out fold. Only the text enters a score. Null and empty texts are scored as the empty text; null and
    repeated ids are scored like others (equal texts score alike); an empty table gives no rows.
    """
    stats = written(document_statistics(docs, id_col, text_col), "stats")
    model = fit(train_rows(stats, labels, id_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.score(x))],
                                             [id_col, "held_out", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = stats.select(id_col, held_out(id_col).alias("held_out"), "stats").mapInArrow(
        lean(run), f"`{id_col}` {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` whose whole text scores at least ``threshold``, with all their columns.

    The model is fitted as in :func:`score`; texts are then scored where they are, without a shuffle.
    """
    model = fit(train_rows(document_statistics(docs, id_col, text_col), labels, id_col))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                yield part.filter(pa.array(model.score(_matrix(part.column(at))) >= threshold))

    return docs.mapInArrow(lean(run), docs.schema)
