"""Reconciliation by fingerprints.

A fingerprint of a table is, per group key, the row count, the exact sum of
every numeric column, and the counts of the values that no sum can hold (NaN,
infinities, magnitudes from 1e22 on; the latter also by a sum of hashes). It is computed in one scan per side with partial
(map-side) aggregation, so the shuffle carries one row per group and map task
whatever the skew of the key. Totals (row count, column sums) are rolled up
from the group rows, never re-scanned.

Differences come back as a long DataFrame

    (source, target, check, column_name, group_key, source_value, target_value)

with ``check`` one of ``count``, ``sum``, ``nan``, ``positive_infinity``,
``negative_infinity``, ``out_of_range`` (the last four with counts as values),
the same with the prefix ``group_``, or ``error`` for a pair that cannot be
compared; an empty frame means the two sides agree. Unlike a single "group fingerprint
mismatch" message it names the group and the column that differ.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from concord.functions.concurrent import AT_ONCE, isolated, reason
from concord.functions.keys import join_condition, restore_key, split_keys
from concord.functions.numeric import SPECIAL_CHECKS, SUM_LIMIT, SUM_TYPE, add_special, always_summable, exact_sum, special_values, within_tolerance
from concord.functions.stored import stored

DEFAULT_TOLERANCE = 1e-4  # relative and absolute, for total sums
BATCH = 4  # pairs or tables of one plan
SPECIAL_TYPE = ("struct<nan:bigint,positive_infinity:bigint,negative_infinity:bigint,out_of_range:bigint,"
                "digest:decimal(38,0)>")
DIFF_COLUMNS = ("source", "target", "check", "column_name", "group_key", "source_value", "target_value")


def numeric_columns(df: DataFrame) -> list[str]:
    """R2: columns of a numeric type (decimals included, booleans excluded)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and not isinstance(f.dataType, BooleanType)]


def key_column(df: DataFrame) -> str:
    """The first non-numeric column, else the first column."""
    numeric = set(numeric_columns(df))
    return next((c for c in df.columns if c not in numeric), df.columns[0])


def _sum_name(i: int) -> str:
    return f"_s{i}"


def resolve_names(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with the columns in ``names`` renamed to that spelling, matched without regard to case."""
    have = {c.lower(): c for c in df.columns}
    change = {have[n.lower()]: n for n in names if n.lower() in have and have[n.lower()] != n}
    return df.withColumnsRenamed(change) if change else df


def group_fingerprint(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per key: ``n``, ``_s<i>`` = exact sum of ``columns[i]`` (NULL as 0, NULL when it overflows) and
    ``_x<i>`` = its special values (``numeric.special_values``).

    A column absent from ``df`` gets NULLs, which the comparison reports.
    The key is grouped as ``(isnull, coalesce)`` pairs (kept in the output) so a
    null-safe comparison joins without re-shuffling (``functions.keys``).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    split, names = split_keys(df, keys)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        aggs += [exact_sum(F.col(c), types[c]).alias(_sum_name(i)) if c in types else F.lit(None).cast(SUM_TYPE).alias(_sum_name(i)),
                 special_values(F.col(c), types[c]).alias(f"_x{i}") if c in types else F.lit(None).cast(SPECIAL_TYPE).alias(f"_x{i}")]
    g = df.groupBy(*split).agg(*aggs)
    return g.select(*names, *[restore_key(j, names).alias(k) for j, k in enumerate(keys)], "n",
                    *[f"{p}{i}" for p in ("_s", "_x") for i in range(len(columns))])


def special_columns(source: DataFrame, target: DataFrame, columns: Sequence[str]) -> set[str]:
    """The columns that may hold values no sum can hold, by their type on either side."""
    return {f.name for df in (source, target) for f in df.schema.fields if f.name in set(columns) and not always_summable(f.dataType)}


def difference_entries(columns: Sequence[str], in_src: set[str], in_tgt: set[str], prefix: str, tolerance: float,
                       special: set[str] | None = None) -> list[Column]:
    """Structs ``(check, column_name, sv, tv, ok)`` of one joined row with ``sn``, ``tn``, ``ss<i>``, ``ts<i>``, ``sx<i>``, ``tx<i>``.

    A side without the group counts as empty; a sum that overflowed, or a column a side does not have, never agrees.
    """
    dec = lambda c: c.cast(SUM_TYPE)
    zero, row = F.lit(0).cast(SUM_TYPE), lambda check, col, sv, tv, ok: F.struct(
        F.lit(prefix + check).alias("check"), F.lit(col).cast("string").alias("column_name"), sv.alias("sv"), tv.alias("tv"), ok.alias("ok"))
    out = [row("count", None, dec(F.col("sn")), dec(F.col("tn")), F.coalesce("sn", F.lit(0)) == F.coalesce("tn", F.lit(0)))]
    for i, c in enumerate(columns):
        both = c in in_src and c in in_tgt
        a, b = (F.when(F.col(f"{x}n").isNull(), zero).otherwise(F.col(f"{x}s{i}")) for x in "st")
        same = F.coalesce(a == b, F.lit(False)) if tolerance == 0 else within_tolerance(a, b, tolerance)
        out.append(row("sum", c, F.col(f"ss{i}"), F.col(f"ts{i}"), same if both else F.lit(False)))
        if not both or special is not None and c not in special:
            continue
        for check in SPECIAL_CHECKS:
            x, y = (F.coalesce(F.col(f"{x}x{i}.{check}"), F.lit(0)) for x in "st")
            same = x == y
            if check == "out_of_range":
                same = same & (F.coalesce(F.col(f"sx{i}.digest"), F.lit(0)) == F.coalesce(F.col(f"tx{i}.digest"), F.lit(0)))
            out.append(row(check, c, dec(x), dec(y), same))
    return out


def fingerprint_long(df: DataFrame, keys: Sequence[str] | None = None,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """The fingerprint as ``(group_key, column_name, row_count, value_sum)``.

    ``column_name`` is NULL on the per-group count row. An empty input gives an
    empty frame (count 0, no sums, no groups).
    """
    keys = list(keys or [key_column(df)])
    columns = list(columns if columns is not None else numeric_columns(df))
    g = group_fingerprint(df, keys, columns)
    entries = [F.struct(F.lit(None).cast("string").alias("column_name"), F.col("n").cast(SUM_TYPE).alias("v"))]
    entries += [F.struct(F.lit(c).alias("column_name"), F.col(_sum_name(i)).alias("v")) for i, c in enumerate(columns)]
    return g.select(
        _render_key(keys).alias("group_key"),
        F.col("n").alias("row_count"),
        F.inline(F.array(*entries)),
    ).select("group_key", "column_name", "row_count", F.col("v").alias("value_sum"))


def numeric_sums(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, non_null, value_sum, n_special, all_null)`` per numeric column, in one scan.

    ``value_sum`` is over what a sum can hold; ``n_special`` counts the values it leaves out (NaN, infinities and
    magnitudes from 1e22 on), so a sum with ``n_special`` > 0 is not the whole column.

    ``all_null`` flags a numeric column without a single value: the reference
    decides "numeric" from the values and would not have summed it.
    """
    columns = list(columns if columns is not None else numeric_columns(df))
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = []
    for i, c in enumerate(columns):
        special = F.col(c).isNotNull() & ~F.coalesce(F.abs(F.col(c).cast("double")) < F.lit(SUM_LIMIT), F.lit(False))
        aggs += [F.count(F.col(c)).alias(f"_n{i}"), exact_sum(F.col(c), types[c]).alias(_sum_name(i)), F.count_if(special).alias(f"_x{i}")]
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_n{i}").alias("non_null"),
                 F.col(_sum_name(i)).alias("value_sum"), F.col(f"_x{i}").alias("n_special"), (F.col(f"_n{i}") == 0).alias("all_null"))
        for i, c in enumerate(columns)
    ])))


def _render_key(keys: Sequence[str]) -> Column:
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    # each part behind its length, so that no separator inside a value can make two keys look alike
    part = lambda k: F.col(k).cast("string")
    return F.concat_ws("|", *[F.coalesce(F.concat(F.length(part(k)), F.lit(":"), part(k)), F.lit("␀")) for k in keys])


@dataclass(frozen=True)
class Pair:
    """One source/target correspondence to reconcile."""

    source_name: str
    target_name: str
    source: DataFrame
    target: DataFrame


def shared_plan(source: DataFrame, target: DataFrame, keys: Sequence[str] | None,
                columns: Sequence[str] | None) -> tuple[list[str], list[str]]:
    """One key and column choice for both sides (the reference lets each side pick its own).

    Columns are the union of both sides' numeric columns, source order first, so
    a numeric column present only in the target is reported, not ignored.
    """
    keys = list(keys or [key_column(source)])
    if columns is None:
        src_num = numeric_columns(source)
        have = {c.lower() for c in src_num}
        named = {c.lower(): c for c in source.columns}  # a source column's spelling wins
        tgt_num = [named.get(c.lower(), c) for c in numeric_columns(target) if c.lower() not in have]
        lower = {k.lower() for k in keys}
        columns = [c for c in src_num + tgt_num if c.lower() not in lower]
    return keys, list(columns)


def compare(pair: Pair, keys: Sequence[str] | None = None, columns: Sequence[str] | None = None,
            tolerance: float = DEFAULT_TOLERANCE, group_tolerance: float = 0.0) -> DataFrame:
    """Fingerprint both sides and return the differences (empty when matched).

    Row counts compare exactly; total sums within ``tolerance`` (relative and
    absolute); per-group counts exactly and per-group sums within
    ``group_tolerance`` (0: exact, as the reference's dict equality).
    NULL keys match NULL keys only (null-safe join).
    """
    keys, columns = shared_plan(pair.source, pair.target, keys, columns)
    source, target = (resolve_names(df, [*keys, *columns]) for df in (pair.source, pair.target))
    lost = [k for k in keys if k not in source.columns or k not in target.columns]
    if lost:
        return unusable(pair, f"key not on both sides: {', '.join(lost)}")
    return compare_fingerprints(
        group_fingerprint(source, keys, columns), group_fingerprint(target, keys, columns),
        pair.source_name, pair.target_name, keys, columns, set(source.columns), set(target.columns),
        tolerance, group_tolerance, special_columns(source, target, columns))


def unusable(pair: Pair, reason: str) -> DataFrame:
    """The one difference row of a pair that cannot be compared: check ``error``, the reason as ``group_key``."""
    spark = pair.source.sparkSession
    return spark.createDataFrame([(pair.source_name, pair.target_name, "error", None, reason, None, None)],
                                 "source string, target string, check string, column_name string, group_key string, "
                                 f"source_value {SUM_TYPE}, target_value {SUM_TYPE}")


def compare_fingerprints(sfp: DataFrame, tfp: DataFrame, source_name: str, target_name: str,
                         keys: Sequence[str], columns: Sequence[str], in_src: set[str] | None = None,
                         in_tgt: set[str] | None = None, tolerance: float = DEFAULT_TOLERANCE,
                         group_tolerance: float = 0.0, special: set[str] | None = None) -> DataFrame:
    """R7/R8 over two group fingerprints (``group_fingerprint`` output, possibly persisted).

    ``in_src`` / ``in_tgt`` name the columns each side has, ``special`` those that may hold values no sum can hold
    (default: all).
    """
    keys, columns = list(keys), list(columns)
    in_src = set(columns) if in_src is None else in_src
    in_tgt = set(columns) if in_tgt is None else in_tgt
    names = [c for c in sfp.columns if c.startswith(("_kn", "_kv", "_kr"))]
    if names and all(c in tfp.columns for c in names):
        cond = join_condition(names, "s", "t")
    else:
        cond = reduce(lambda a, b: a & b, [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys])
    n = range(len(columns))
    x = [i for i in n if special is None or columns[i] in special]
    g = sfp.alias("s").join(tfp.alias("t"), cond, "full_outer").select(
        *[F.coalesce(F.col(f"s.{k}"), F.col(f"t.{k}")).alias(k) for k in keys],
        F.col("s.n").alias("sn"), F.col("t.n").alias("tn"),
        *[F.col(f"{a}._{p}{i}").alias(f"{a}{p}{i}") for a in "st" for p, own in (("s", n), ("x", x)) for i in own])

    # Totals from each side's group rows (two one-row aggregates folded into one
    # row), not from the joined frame: no second join for the totals branch.
    def side_totals(f: DataFrame, tag: str) -> DataFrame:
        # a total with an overflowed group, or that overflows itself, is NULL
        total = lambda i: F.when(F.count_if(F.col(_sum_name(i)).isNull()) == 0, F.coalesce(
            F.when(F.count(F.lit(1)) == 0, F.lit(0).cast(SUM_TYPE)), F.try_sum(_sum_name(i))))
        return f.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[total(i).alias(f"v{i}") for i in n],
                     *[add_special(f"_x{i}").alias(f"x{i}") for i in x]).withColumn("_side", F.lit(tag))

    both = side_totals(sfp, "s").unionByName(side_totals(tfp, "t"))
    pick = lambda tag, c: F.max(F.when(F.col("_side") == tag, F.col(c)))
    totals = both.agg(*[pick(a, c).alias(a + d) for a in "st" for c, d in (
        [("n", "n")] + [(f"v{i}", f"s{i}") for i in n] + [(f"x{i}", f"x{i}") for i in x])])
    head = [F.lit(source_name).alias("source"), F.lit(target_name).alias("target"), "check", "column_name"]
    tail = [F.col("sv").alias("source_value"), F.col("tv").alias("target_value")]
    total_diffs = totals.select(F.inline(F.array(*difference_entries(columns, in_src, in_tgt, "", tolerance, special)))).where(
        ~F.col("ok")).select(*head, F.lit(None).cast("string").alias("group_key"), *tail)
    group_diffs = g.select(_render_key(keys).alias("group_key"), F.inline(F.array(
        *difference_entries(columns, in_src, in_tgt, "group_", group_tolerance, special)))).where(
        ~F.col("ok")).select(*head, "group_key", *tail)
    return total_diffs.unionByName(group_diffs)


def row_counts(tables: dict[str, DataFrame], batch: int = BATCH, at_once: int = AT_ONCE) -> DataFrame:
    """``(name, n, error)`` of every table. A table that cannot be read has no ``n`` and the reason as ``error``.

    A count of Parquet files reads no column, only the row numbers in the files' footers.
    """
    spark = next(iter(tables.values())).sparkSession
    schema = "name string, n long, error string"

    def counted(names: Sequence[str]) -> list[tuple]:
        every = balanced_union([tables[x].agg(F.count(F.lit(1)).alias("n")).select(F.lit(x).alias("name"), "n") for x in names])
        return [(r["name"], r["n"], None) for r in every.collect()]  # a number a table, as many as the caller lists

    rows = isolated(spark, list(tables), counted, lambda name, e: [(name, None, reason(e))], batch, at_once)
    return spark.createDataFrame([r for part in rows for r in part], schema)


def rowcount_parity(pairs: Iterable[Pair], batch: int = BATCH, at_once: int = AT_ONCE) -> DataFrame:
    """``(source, target, source_rows, target_rows, matched)`` for every pair.

    Each distinct table name is counted once (a source shared by several pairs is scanned once), ``batch`` tables a plan and
    ``at_once`` plans in flight. All pairs are reported; one with an unreadable side has NULL for its rows
    and is not matched. Call ``assert_parity`` to raise on the first mismatch.
    """
    pairs = list(pairs)
    tables: dict[str, DataFrame] = {}
    for p in pairs:
        tables.setdefault(p.source_name, p.source)
        tables.setdefault(p.target_name, p.target)
    counts = row_counts(tables, batch, at_once)
    names = counts.sparkSession.createDataFrame([(i, p.source_name, p.target_name) for i, p in enumerate(pairs)],
                                                "pos int, source string, target string")
    c = F.broadcast(counts.drop("error"))  # one row per distinct table name: bounded by the pair list
    out = (names.join(c.withColumnRenamed("name", "source").withColumnRenamed("n", "source_rows"), "source")
           .join(c.withColumnRenamed("name", "target").withColumnRenamed("n", "target_rows"), "target"))
    return out.select("source", "target", "source_rows", "target_rows",
                      F.coalesce(F.col("source_rows") == F.col("target_rows"), F.lit(False)).alias("matched"))


def assert_parity(report: DataFrame) -> None:
    """Raise ``ValueError`` naming the first (by source) mismatched pair; the report is small."""
    bad = report.where(~F.col("matched")).orderBy("source").limit(1).collect()
    if bad:
        r = bad[0]
        raise ValueError(f"row-count mismatch for {r.source}: source={r.source_rows}, target={r.target_rows}")


def reconcile(pairs: Iterable[Pair], keys: Sequence[str] | None = None, tolerance: float = DEFAULT_TOLERANCE,
              group_tolerance: float = 0.0, batch: int = BATCH, at_once: int = AT_ONCE) -> DataFrame:
    """The difference rows of many pairs.

    Up to ``batch`` pairs are one plan, ``at_once`` plans run at the same time, and each writes its differences to the shared
    folder, so neither a plan nor the driver's memory grows with the list. A pair that cannot be compared (no shared
    key, an unreadable side, a value that fails while it is read) is one ``error`` row and stops no other.
    """
    pairs = list(pairs)

    def compared(part: Sequence[Pair]) -> DataFrame:
        frames = []
        for p in part:
            try:
                frames.append(compare(p, keys, None, tolerance, group_tolerance))
            except (AnalysisException, ValueError, KeyError) as e:
                frames.append(unusable(p, str(e).splitlines()[0][:300]))
        return stored(balanced_union(frames), "differences")

    return balanced_union(isolated(pairs[0].source.sparkSession, pairs, compared, lambda p, e: unusable(p, reason(e)), batch, at_once))


def balanced_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames of one schema, as a tree of logarithmic depth."""
    frames = list(frames)
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i] for i in range(0, len(frames), 2)]
    return frames[0]


def verdict(pairs: Sequence[Pair], diffs: DataFrame) -> DataFrame:
    """``(source, target, n_diffs, status, batch_status)``.

    ``status`` is ``validated`` when the pair has no difference, else ``flagged``;
    ``batch_status`` is ``validated`` only when every pair is.
    """
    spark = diffs.sparkSession
    names = spark.createDataFrame([(p.source_name, p.target_name) for p in pairs], "source string, target string")
    counts = diffs.groupBy("source", "target").agg(F.count(F.lit(1)).alias("n_diffs"))
    v = names.join(counts, ["source", "target"], "left").select(
        "source", "target", F.coalesce("n_diffs", F.lit(0)).alias("n_diffs"))
    v = v.withColumn("status", F.when(F.col("n_diffs") == 0, "validated").otherwise("flagged"))
    # One row per pair (a list the caller holds), so a global window here is bounded.
    from pyspark.sql import Window
    all_ok = F.min(F.col("n_diffs") == 0).over(Window.partitionBy())
    return v.withColumn("batch_status", F.when(all_ok, "validated").otherwise("flagged"))
