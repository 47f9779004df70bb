"""Row-level checks: multiset difference (R10) and bucketed key drill-down.

Counts and sums can agree while rows differ (compensating errors). The row
check compares the two sides as multisets of whole rows:

1. rows are reduced to ``(row hash, multiplicity per side)``; duplicates collapse in
   the map-side partial aggregate, so a row repeated a billion times costs one
   shuffled record per map task;
2. one aggregate over the hashes of both sides counts each hash on either side: a
   hash that both hold is one entry of a task, and nothing is sorted. The exchange
   starts from partitions by the number of rows, so a task's share does not grow.
   The differing hashes are written to a table once and counted;
3. the row values of the differing hashes are fetched by a second scan of each
   side. Up to ``BROADCAST_HASHES`` counted hashes are broadcast, so no full row
   is shuffled; beyond that the rows that a broadcast bitmap of the hashes lets pass are joined by a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions.bitmaps import BITMAP_BITS, maybe_among
from concord.functions.canonical import common_kind, shown_type, with_row_hash
from concord.functions.keys import join_condition
from concord.functions.numeric import as_exact, identity
from concord.functions.stored import roomier, stored
from concord.operators.fingerprint import difference_entries, group_fingerprint, numeric_columns, resolve_names, special_columns

H = ["_h1", "_h2"]
BROADCAST_HASHES = 500_000  # 16 bytes and counts each: about 50 MB when broadcast


def column_differences(source: DataFrame, target: DataFrame) -> list[tuple[str, str, str | None, str | None]]:
    """``(column, difference, source type, target type)`` of the columns that cannot be compared:
    ``missing_target``, ``extra_target`` or ``no_common_type``. Names match without regard to case."""
    left = {f.name.lower(): f for f in source.schema.fields}
    right = {f.name.lower(): f for f in target.schema.fields}
    out = [(f.name, "missing_target", f.dataType.simpleString(), None) for k, f in left.items() if k not in right]
    out += [(f.name, "extra_target", None, f.dataType.simpleString()) for k, f in right.items() if k not in left]
    out += [(f.name, "no_common_type", f.dataType.simpleString(), right[k].dataType.simpleString())
            for k, f in left.items() if k in right and common_kind(f.dataType, right[k].dataType) is None]
    return out


def comparable(source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """Both sides over ``columns`` with their row hashes, and the type in which each column is shown."""
    if columns is None:
        bad = column_differences(source, target)
        if bad:
            raise ValueError("columns that cannot be compared: " + ", ".join(f"{c} ({d})" for c, d, _, _ in bad))
        columns = source.columns
    columns = list(columns)
    actual = {f.name.lower(): f for f in target.schema.fields}
    types = {f.name.lower(): f.dataType for f in source.schema.fields}
    pairs = {c: (types[c.lower()], actual[c.lower()].dataType) for c in columns}
    kinds = {c: common_kind(*p) for c, p in pairs.items()}
    if None in kinds.values():
        raise ValueError(f"no common type: {[c for c, k in kinds.items() if k is None]}")
    order = sorted(columns)

    def hashed(df: DataFrame) -> DataFrame:
        names = {n.lower(): n for n in df.columns}
        return with_row_hash(df.select(*[F.col(names[c.lower()]).alias(c) for c in columns]), order, kinds)

    return hashed(source), hashed(target), {c: shown_type(*p) for c, p in pairs.items()}


def maybe_in(df: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The rows of ``df`` whose hash may be one of the ``n`` of ``wanted`` (:mod:`concord.functions.bitmaps`)."""
    return maybe_among(df, H[0], wanted, n, BITMAP_BITS)


def row_multiset_diff(source: DataFrame, target: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows whose multiplicity differs: ``(<row columns>, source_count, target_count)``.

    Values are compared at a common type per column (``functions.canonical``), so a retyped copy of a table
    is equal to it. Without ``columns`` every column takes part, and one that a side lacks or that has no common
    type raises; name the columns to compare only those, or use ``row_report`` to get such columns as rows.
    """
    s, t, shown = comparable(source, target, columns)
    counts = ("source_count", "target_count")
    sides = [df.select(*H, *[F.lit(int(i == side)).cast("long").alias(c) for i, c in enumerate(counts)]) for side, df in enumerate((s, t))]
    both = roomier(sides[0], s.count() + t.count()).unionByName(sides[1])
    d = both.groupBy(*H).agg(*[F.sum(c).alias(c) for c in counts]).where(F.col("source_count") != F.col("target_count"))
    d = stored(d, "rowdiff")
    n = d.count()

    def rows_of(df: DataFrame, wanted: DataFrame) -> DataFrame:
        if n > BROADCAST_HASHES:
            df = maybe_in(df, wanted, n)
        # the stored hashes on the left: the join runs in their session, with its partitions
        found = (F.broadcast(wanted) if n <= BROADCAST_HASHES else wanted.hint("merge")).join(df, H)
        values = [F.col(c).cast(kind).alias(c) for c, kind in shown.items()]
        return found.select(*H, *values, "source_count", "target_count").dropDuplicates(H)

    return rows_of(s, d.where("source_count > 0")).unionByName(rows_of(t, d.where("source_count = 0"))).drop(*H)


def row_report(source: DataFrame, target: DataFrame) -> DataFrame:
    """All differences as rows ``(difference, column_name, source_type, target_type, row, source_count, target_count)``.

    Columns that cannot be compared come as rows of their own; ``row`` rows carry the differing row over the other
    columns as JSON.
    """
    bad = column_differences(source, target)
    skip = {c.lower() for c, *_ in bad}
    columns = [c for c in source.columns if c.lower() not in skip]
    spark = source.sparkSession
    head = spark.createDataFrame(
        [(d, c, s, t) for c, d, s, t in bad], "difference string, column_name string, source_type string, target_type string")
    none = F.lit(None)
    out = head.select("*", none.cast("string").alias("row"), none.cast("long").alias("source_count"), none.cast("long").alias("target_count"))
    if not columns:
        return out
    rows = row_multiset_diff(source, target, columns)
    return out.unionByName(rows.select(
        F.lit("row").alias("difference"), *[none.cast("string").alias(c) for c in ("column_name", "source_type", "target_type")],
        F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("row"), "source_count", "target_count"))


def key_fingerprint(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Per key row count, exact sums and special values (see ``fingerprint.group_fingerprint``)."""
    return group_fingerprint(df, [key], list(columns))


def bucket_fingerprint(df: DataFrame, key: str, columns: Sequence[str], buckets: int) -> DataFrame:
    """Level 1: per bucket of ``pmod(xxhash64(key), buckets)`` the row count and two sums of row hashes.

    A row's hash covers the key and, for each column, the value that level 2 sums (at its exact scale, NULL as 0)
    or, where it cannot be summed, its identity. Equal rows hash alike whatever their type, no magnitude is
    left out, and multiplicities add up. Aggregated straight from the rows with a partial aggregate, so the
    shuffle carries at most ``buckets`` records per map task.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for c in columns:
        if c not in types:
            parts.append(F.lit("absent"))
            continue
        exact = as_exact(F.col(c), types[c])
        summed = F.coalesce(exact, F.lit(0).cast("decimal(38,6)"))
        special = exact.isNull() & F.col(c).isNotNull()
        parts += [summed, special, *[F.when(special, x) for x in identity(F.col(c), types[c])]]
    one = F.xxhash64(F.col(key), *parts).cast("decimal(20,0)")
    two = F.xxhash64(F.lit("concord/second"), F.col(key), *parts).cast("decimal(20,0)")
    return df.groupBy(F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).alias("bucket")).agg(
        F.sum(one).alias("c1"), F.sum(two).alias("c2"), F.count(F.lit(1)).alias("n"), F.max(F.col(key).isNull()).alias("has_null"))


def bucket_drilldown(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None = None,
                     buckets: int = 4096) -> DataFrame:
    """Per-key differences ``(key, check, column_name, source_value, target_value)``.

    Level 1 compares ``buckets`` fingerprints per side; level 2 computes exact per-key fingerprints only for rows
    in mismatched buckets (the bucket list is at most ``buckets`` ids, a proven bound, so it is broadcast).
    Matched tables shuffle only bucket rows. Checks: ``group_count``, ``group_sum`` and the group's special values, as in
    the group fingerprint. NULL keys form their own key. The key's types should agree on the two sides.
    """
    source, target, columns = _columns(source, target, key, columns)
    sb = bucket_fingerprint(source, key, columns, buckets)
    tb = bucket_fingerprint(target, key, columns, buckets)
    same = None
    for c in ("c1", "c2", "n", "has_null"):
        e = F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
        same = e if same is None else same & e
    bad = sb.alias("s").join(tb.alias("t"), F.col("s.bucket") == F.col("t.bucket"), "full_outer").where(~same).select(
        F.coalesce(F.col("s.bucket"), F.col("t.bucket")).alias("bucket"))
    bad = F.broadcast(bad)  # at most `buckets` rows

    def narrowed(df: DataFrame) -> DataFrame:
        b = df.withColumn("bucket", F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)))
        return b.join(bad, "bucket", "left_semi").drop("bucket")

    return _direct(narrowed(source), narrowed(target), key, columns)


def direct_key_diff(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The same answer as ``bucket_drilldown`` without level 1 (reference for tests)."""
    source, target, columns = _columns(source, target, key, columns)
    return _direct(source, target, key, columns)


def _columns(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None):
    if columns is None:
        columns = [c for c in numeric_columns(source) if c.lower() != key.lower()]
    return resolve_names(source, [key, *columns]), resolve_names(target, [key, *columns]), list(columns)


def _direct(source: DataFrame, target: DataFrame, key: str, columns: list[str]) -> DataFrame:
    s = key_fingerprint(source, key, columns)
    t = key_fingerprint(target, key, columns)
    names = [c for c in s.columns if c.startswith(("_kn", "_kv", "_kr"))]
    g = s.alias("s").join(t.alias("t"), join_condition(names, "s", "t"), "full_outer").select(
        F.coalesce(F.col(f"s.{key}"), F.col(f"t.{key}")).alias(key), F.col("s.n").alias("sn"), F.col("t.n").alias("tn"),
        *[F.col(f"{a}._{p}{i}").alias(f"{a}{p}{i}") for a in "st" for p in "sx" for i in range(len(columns))])
    entries = difference_entries(columns, set(source.columns), set(target.columns), "group_", 0.0, special_columns(source, target, columns))
    return g.select(key, F.inline(F.array(*entries))).where(~F.col("ok")).select(
        key, "check", "column_name", F.col("sv").alias("source_value"), F.col("tv").alias("target_value"))
