"""Document fingerprints: bottom-k sketches of shingle hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import lean, written
from concord.llm.shingles import shingle_hashes

#: Hashes are the upper 48 bits, 12 hex digits each.
BITS = 48
#: Most buckets into which ids are cut.
MOST_BUCKETS = 1 << 14


def sketch(text: str | None, k: int, shingle: int) -> np.ndarray:
    """The ``k`` smallest distinct hashes of the text's shingles, ascending; all of them if there are fewer."""
    low = np.empty(0, np.uint64)
    for hashes in shingle_hashes(text, shingle):
        hashes = hashes >> np.uint64(64 - BITS)
        if len(low) == k:
            hashes = hashes[hashes < low[-1]]
        low = np.unique(np.concatenate((low, hashes)))[:k]
    return low


def merge(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Sketch of the union of two sketched sets."""
    return np.unique(np.concatenate((a, b)))[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimated Jaccard likeness: the share of the union's sketch that both have. Exact for sets of at most ``k``
    shingles in all; two empty sets are alike (1)."""
    union = merge(a, b, k)
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True)).mean()) if len(union) else 1.0


def distinct(a: np.ndarray, k: int) -> float:
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**BITS / (float(a[-1]) + 1)


def containment(a: np.ndarray, b: np.ndarray, k: int) -> float:
    """Estimated share of the first set's shingles that the second has; 1 for an empty first set."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct(merge(a, b, k), k)
    return min(1.0, both / distinct(a, k))


def digits(a: np.ndarray) -> str:
    """The sketch as hex digits, 12 per hash, ascending."""
    return "".join(f"{x:012x}" for x in a.tolist())


def merge_parts(parts: DataFrame, key: str, hashes: str = "hashes", k: int = 128, fan_in: int = 256) -> DataFrame:
    """One sketch per ``key`` from the sketches (arrays of long) of its parts.

    At most ``fan_in`` sketches of a key meet in a task; keys with more are merged in further rounds.
    """
    rows = parts.select(key, hashes, F.monotonically_increasing_id().alias("_n"))
    low = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(hashes)))), 1, k).alias(hashes)
    while True:
        sizes = rows.groupBy(key).agg(F.ceil(F.count("*") / fan_in).alias("_groups"))
        most = sizes.agg(F.max("_groups")).first()[0] or 1
        if most == 1:
            return rows.groupBy(key).agg(low)
        rows = written(rows.join(sizes, rows[key].eqNullSafe(sizes[key])).drop(sizes[key])
                       .groupBy(key, F.pmod(F.xxhash64("_n"), "_groups").alias("_n")).agg(low), "sketches")


def _bucket(column: str, splits: list[int]) -> F.Column:
    """Number of splits at or below the id, by a search in two steps; nulls come after all."""
    if not splits:
        return F.when(F.col(column).isNull(), F.lit(1)).otherwise(F.lit(0))
    wide = int(len(splits) ** 0.5) + 1
    blocks = [splits[i:i + wide] for i in range(0, len(splits), wide)]
    heads = F.expr("array(" + ",".join(f"{b[0]}L" for b in blocks) + ")")
    inner = F.expr("array(" + ",".join("array(" + ",".join(f"{x}L" for x in b) + ")" for b in blocks) + ")")
    block = F.size(F.filter(heads, lambda h: h <= F.col(column)))
    within = F.size(F.filter(F.element_at(inner, F.greatest(block, F.lit(1))), lambda s: s <= F.col(column)))
    return F.when(F.col(column).isNull(), F.lit(len(splits) + 1)).when(block == 0, F.lit(0)).otherwise(
        (block - 1) * wide + within)


def with_next(docs: DataFrame, id_col: str, text_col: str, rows_per_bucket: int = 512) -> DataFrame:
    """Rows dealt into sorted runs so that each row's successor follows it: ``id``, ``text``, ``bucket``, ``ahead``.

    Ids (integers) are cut at approximate quantiles, which are ids themselves, into buckets; whole texts are
    shuffled once, sorted by id (then by text) within buckets. The first row of a bucket is also sent to the
    bucket before it, the first row of all to the last, as a row with ``ahead`` = 1 that only ends the run. Null
    ids come after all others.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n, known, least = rows.agg(F.count("*"), F.count("id"), F.min("id")).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = max(1, min(MOST_BUCKETS, known // rows_per_bucket))
    cuts = rows.agg(F.percentile_approx("id", [i / want for i in range(1, want)], max(10_000, 4 * want))).first()[0] \
        if want > 1 else []
    splits = sorted({c for c in cuts or [] if c > least})
    bucket = _bucket("id", splits)
    last = len(splits) + (1 if known < n else 0) if known else 1
    marks = splits + ([least] if known else [])
    firsts = rows.where(F.col("id").isin(marks)).groupBy("id").agg(F.min("text").alias("text")) if marks else rows.limit(0)
    ahead = firsts.withColumn("bucket", F.when(F.col("id") == F.lit(least), F.lit(last)).otherwise(bucket - 1))
    if known < n:
        first_null = rows.where("id is null").groupBy("id").agg(F.min("text").alias("text"))
        ahead = ahead.unionByName(first_null.withColumn("bucket", F.lit(len(splits) if known else last)))
    both = rows.withColumn("bucket", bucket).withColumn("ahead", F.lit(0)).unionByName(ahead.withColumn("ahead", F.lit(1)))
    return both.repartition(parts, "bucket").sortWithinPartitions("bucket", "ahead", F.asc_nulls_last("id"), "text")


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 128,
                shingle: int = 5) -> DataFrame:
    """Sketches of every row's whole text and of its edited text, with their likeness; one row per row.

    The edited text is the text with its last floor(n / 2) of n code points replaced by the first as many (or all)
    of the next row's text, in ascending order of the id (the first row after the last; ties by text, null ids
    last). Columns: the id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint`` (hex, 12 digits a hash),
    ``near_edited``, ``near_next`` (resemblance), ``held_by_edited`` (containment in the edited text),
    ``n_shingles`` (distinct, estimated). Null texts count as empty: their sketch is empty, and two empty sketches
    are alike. Each task streams over its sorted rows and holds two texts and one Arrow batch. An empty table
    gives no rows; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (id, text, sketch, bucket) waiting for its successor
        for batch in batches:
            out: list[tuple] = []
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                for doc, text, bucket, ahead in zip(*(c.to_pylist() for c in part.columns)):
                    own = sketch(text, k, shingle) if held is None or held[1] != text else held[2]
                    if held is not None:
                        assert held[3] == bucket, "each bucket ends with the first row of the next"
                        cut = len(held[1]) // 2
                        edited = held[1][:len(held[1]) - cut] + text[:cut]
                        other = sketch(edited, k, shingle)
                        out.append((held[0], len(held[1]), hashlib.sha256(edited.encode()).hexdigest(), digits(held[2]),
                                    digits(other), resemblance(held[2], other, k), resemblance(held[2], own, k),
                                    containment(held[2], other, k), distinct(held[2], k)))
                    held = None if ahead else (doc, text, own, bucket)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out) if out else [[]] * 9, [batch.schema.field(0).type, pa.int64(), pa.string(), pa.string(),
                                                 pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.float64()])],
                [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
                 "held_by_edited", "n_shingles"])

    kind = docs.schema[id_col].dataType.simpleString()
    return with_next(docs, id_col, text_col).mapInArrow(lean(run), (
        f"`{id_col}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, held_by_edited double, n_shingles double"))
