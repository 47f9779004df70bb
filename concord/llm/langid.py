"""Language identification by a mixture of n-gram models, fitted to each document by expectation-maximisation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import lean

#: Letter trigrams are hashed into this many cells, which bounds the model by languages x cells.
CELLS = 1 << 16
#: Pseudo-count of a cell.
SMOOTHING = 0.5

_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTERS


def trigram_cells(text: str | None) -> np.ndarray:
    """Cells of all letter trigrams of the whole lower-cased text; runs of other characters count as one space.
    Empty for a text without a letter."""
    if not text:
        return np.empty(0, np.int64)
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[code]
    if not letter.any():
        return np.empty(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    code = np.where(letter, code, 0)[keep].astype(np.uint64)
    code = np.concatenate((np.zeros(1, np.uint64), code, np.zeros(1, np.uint64)))
    mixed = (code[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ code[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
             ^ code[2:] * np.uint64(0x165667B19E3779F9))
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(48)).astype(np.int64)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities (cells x languages) from all rows with a language and a letter.

    Each task counts cells in dense arrays and returns what is not zero; the sums over all rows, at most
    languages x ``CELLS`` numbers, come to the driver as the model.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    cells = trigram_cells(text)
                    if len(cells):
                        own = sums.setdefault(lang, np.zeros(CELLS, np.int64))
                        own += np.bincount(cells, minlength=CELLS)
        for lang, own in sums.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(own[at])], ["lang", "cell", "n"])

    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string"), F.col(text_col).cast("string"))
    sums = rows.mapInArrow(lean(count), "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    table = sums.groupBy("lang").agg(F.collect_list("cell").alias("cells"), F.collect_list("n").alias("n")).orderBy("lang").collect()
    counts = np.full((CELLS, len(table)), SMOOTHING)
    for k, r in enumerate(table):
        counts[r["cells"], k] += r["n"]
    return [r["lang"] for r in table], np.log(counts / counts.sum(0))


def mixture(likelihood: np.ndarray, n: np.ndarray, steps: int = 40, settled: float = 1e-3) -> tuple[np.ndarray, float]:
    """Proportions of the languages (columns) and the log likelihood, by expectation-maximisation."""
    share = np.full(likelihood.shape[1], 1 / likelihood.shape[1])
    total = n.sum()
    for _ in range(steps):
        mix = likelihood @ share
        new = share * ((n / mix) @ likelihood) / total
        done = np.abs(new - share).max() < settled
        share = new
        if done:
            break
    return share, float(n @ np.log(likelihood @ share))


def infer(text: str | None, log_p: np.ndarray, penalty: float) -> tuple[np.ndarray, list[int]] | None:
    """Proportions under the full mixture, and the languages selected by penalised likelihood, largest first.

    From the most likely single language on, the mixture's languages are added in the order of their proportions
    while the log likelihood gains more than ``penalty`` x log(trigrams) for each. None without letters.
    """
    cells = trigram_cells(text)
    if not len(cells) or not log_p.shape[1]:
        return None
    at, n = np.unique(cells, return_counts=True)
    logs = log_p[at]
    top = logs.max(1, keepdims=True)
    likelihood = np.exp(logs - top)
    share, _ = mixture(likelihood, n)
    single = n @ (logs - top)
    best = int(single.argmax())
    chosen, value, cost = [best], float(single[best]), penalty * np.log(len(cells))
    for k in np.argsort(-share, kind="stable").tolist():
        if k == best:
            continue
        if share[k] < 0.01:
            break
        _, more = mixture(likelihood[:, [*chosen, k]], n)
        if more - value <= cost:
            break
        chosen, value = [*chosen, k], more
    if len(chosen) > 1:
        own, _ = mixture(likelihood[:, chosen], n)
        chosen = [chosen[i] for i in np.argsort(-own, kind="stable")]
    return share, chosen


def held_out(id_col: str = "doc_id"):
    """True where crc32 of the id as text leaves 2 when divided by 4; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             penalty: float = 6.0) -> DataFrame:
    """Language of every row's whole text; one row per row.

    Models are learned from the rows outside the held-out fold whose language is known. Columns: the id, ``held_out``,
    ``lang_pred`` (the largest of the selected languages, ``und`` for a null text or one without a letter),
    ``score`` (its proportion in the full mixture, 0 for ``und``), ``langs`` (all selected, comma-joined). Only the
    text enters a prediction. Null and repeated ids are predicted like others; without any known language all are
    ``und``; an empty table gives no rows; other columns are ignored.
    """
    langs, log_p = train(docs.where(~held_out(id_col)), lang_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(log_p)  # languages x CELLS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_p = model.value
        for batch in batches:
            pred, score, sets = [], [], []
            for a in range(0, batch.num_rows, 256):
                for text in batch.column(2).slice(a, 256).to_pylist():
                    got = infer(text, log_p, penalty)
                    pred.append(langs[got[1][0]] if got else "und")
                    score.append(min(1.0, float(got[0][got[1][0]])) if got else 0.0)
                    sets.append(",".join(langs[k] for k in got[1]) if got else "")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pred, pa.string()),
                                              pa.array(score, pa.float64()), pa.array(sets, pa.string())],
                                             [id_col, "held_out", "lang_pred", "score", "langs"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, held_out(id_col).alias("held_out"), F.col(text_col).cast("string")).mapInArrow(
        lean(run), f"`{id_col}` {kind}, held_out boolean, lang_pred string, score double, langs string")
