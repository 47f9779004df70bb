"""Conform a DataFrame to a target schema before loading it.

Rules, in order, per source column (fixed behaviour of the reference's loader):

1. not in the target schema: dropped;
2. a lenient datetime column: the target must be DATETIME or TIMESTAMP, else a
   mismatch; values pass unchanged;
3. target STRING: cast to text (NULL stays NULL, unlike the pandas original);
4. target BOOL/BOOLEAN: a boolean source passes; a numeric source converts only
   when all its non-null values are 0 or 1 (NULL becomes false), else mismatch;
   any other source is a mismatch;
5. boolean source, non-boolean target: mismatch;
6. numeric source, target INTEGER: cast to bigint; target FLOAT: cast to double;
7. text source, numeric target: ``try_cast`` (bad values become NULL and are
   counted); INTEGER/INT64 to bigint, other numeric names to double;
8. numeric source, other numeric target names: unchanged;
9. numeric source, non-numeric non-STRING target: mismatch;
10. anything else: accepted unchanged.

Mismatched columns stay in the output (unchanged); target columns absent from
the source are reported and, with ``fill_missing``, added as typed NULLs.

The 0/1 test is data-dependent: one aggregate pass returns one boolean per
candidate column. Conversion failures are counted by an ``Observation`` when
the conformed frame is written, not by an extra scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from concord.functions.types import loader_type_name

# The target numeric type names the loader knows.
TARGET_NUMERIC_TYPES = ("INTEGER", "INT64", "FLOAT", "FLOAT64", "NUMERIC", "BIGNUMERIC")
DATETIME_TYPES = ("DATETIME", "TIMESTAMP")
BOOL_TYPES = ("BOOL", "BOOLEAN")

# Spark type for a target type name when a column is converted or filled.
SPARK_TYPE = {"STRING": "string", "BOOL": "boolean", "BOOLEAN": "boolean", "INTEGER": "bigint", "INT64": "bigint",
              "FLOAT": "double", "FLOAT64": "double", "NUMERIC": "decimal(38,9)", "BIGNUMERIC": "double",
              "DATETIME": "timestamp_ntz", "TIMESTAMP": "timestamp", "DATE": "date"}

REPORT_SCHEMA = "column_name string, source_type string, target_type string, action string, ok boolean, message string"


@dataclass
class Conformed:
    ok: bool
    frame: DataFrame
    report: DataFrame
    failures: Observation | None = None
    failure_columns: list[str] = field(default_factory=list)
    exprs: dict[str, Column] = field(default_factory=dict)

    def failure_counts(self) -> dict[str, int]:
        """Values turned NULL by a failed conversion, per column; available after ``frame`` ran."""
        if self.failures is None:
            return {}
        got = self.failures.get
        return {c: int(got.get(f"failed_{c}", 0) or 0) for c in self.failure_columns}


def _zero_one_columns(df: DataFrame, candidates: Sequence[str]) -> dict[str, bool]:
    if not candidates:
        return {}
    row = df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(0, 1)).alias(c) for c in candidates]).first()
    return {c: row[c] == 0 for c in candidates}


def conform(df: DataFrame, target: Sequence[tuple[str, str]], lenient_datetime_columns: Sequence[str] = (),
            fill_missing: bool = False) -> Conformed:
    """``target`` is ``[(column, TYPE_NAME), ...]``; returns ok flag, frame and report."""
    spark: SparkSession = df.sparkSession
    tgt = {name: t.upper() for name, t in target}
    lenient = set(lenient_datetime_columns)
    src_types = {f.name: f.dataType for f in df.schema.fields}
    loader = {c: loader_type_name(t) for c, t in src_types.items()}
    bool_candidates = [c for c in df.columns if c in tgt and c not in lenient and tgt[c] in BOOL_TYPES
                       and loader[c] == "FLOAT64"]
    zero_one = _zero_one_columns(df, bool_candidates)

    out, report, failed, exprs = [], [], [], {}
    all_ok = True
    for c in df.columns:
        st = loader[c]
        if c not in tgt:
            report.append((c, st, None, "drop", True, "not in target schema"))
            continue
        tt = tgt[c]
        col = F.col(c)
        action, ok, msg = "keep", True, f"source {st} vs target {tt}"
        if c in lenient:
            ok = tt in DATETIME_TYPES
            msg = f"lenient datetime column must be DATETIME/TIMESTAMP, found {tt}" if not ok else msg
        elif tt == "STRING":
            col, action = col.cast("string"), "cast"
        elif tt in BOOL_TYPES:
            if isinstance(src_types[c], BooleanType):
                pass
            elif st == "FLOAT64" and zero_one.get(c, False):
                col, action, msg = F.coalesce(col != 0, F.lit(False)), "cast", "0/1 values to boolean, NULL to false"
            else:
                ok, msg = False, f"type mismatch (source {st} -> target {tt})"
        elif st == "BOOL":
            ok, msg = False, f"type mismatch (source BOOL -> target {tt})"
        elif st == "FLOAT64" and tt == "INTEGER":
            col, action = _whole(col), "cast"
            msg = f"source {st} -> target {tt} (values that are not whole set to NULL)"
            failed.append(c)
        elif st == "FLOAT64" and tt == "FLOAT":
            col, action = col.cast("double"), "cast"
        elif st == "STRING" and tt in TARGET_NUMERIC_TYPES:
            col, action = col.try_cast("bigint" if tt in ("INTEGER", "INT64") else "double"), "cast"
            msg = f"source STRING -> target {tt} (non-numeric values set to NULL)"
            failed.append(c)
        elif st == "FLOAT64" and tt in TARGET_NUMERIC_TYPES:
            pass
        elif st == "FLOAT64":
            ok, msg = False, f"numeric mismatch (source FLOAT -> target {tt})"
        all_ok = all_ok and ok
        out.append(col.alias(c))
        exprs[c] = col
        report.append((c, st, tt, action if ok else "mismatch", ok, msg))
    for name, t in target:
        if name not in src_types:
            report.append((name, None, t.upper(), "fill" if fill_missing else "missing", True,
                           "target column missing from source; will be NULL"))
            if fill_missing:
                out.append(F.lit(None).cast(SPARK_TYPE.get(t.upper(), "string")).alias(name))
    frame = df.select(*out)
    obs = None
    if failed:
        obs = Observation("concord_conform")
        frame = _observe_failures(df, out, failed, obs)
    return Conformed(all_ok, frame, spark.createDataFrame(report, REPORT_SCHEMA), obs, failed, exprs)


def _whole(c: Column) -> Column:
    """A number as bigint if it is whole and in range, else NULL."""
    v = c.try_cast("bigint")
    return F.when(v == c, v)


def conformance_audit(df: DataFrame, target: Sequence[tuple[str, str]], lenient_datetime_columns: Sequence[str] = ()) -> DataFrame:
    """A12 as rows: the report with ``n_failed`` (values a conversion would set to NULL, counted over all rows in one
    scan) and ``table_ok`` (no column is a mismatch)."""
    result = conform(df, target, lenient_datetime_columns)
    names = result.failure_columns
    both = df.select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(names)], *[result.exprs[c].alias(f"_t{i}") for i, c in enumerate(names)])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_failed")) for i, c in enumerate(names)]
    if not names:
        return result.report.withColumn("n_failed", F.lit(0).cast("long")).withColumn("table_ok", F.lit(result.ok))
    counts = both.agg(*[F.count_if(F.col(f"_s{i}").isNotNull() & F.col(f"_t{i}").isNull()).alias(f"n{i}") for i in range(len(names))])
    return result.report.join(F.broadcast(counts.select(F.inline(F.array(*entries)))), "column_name", "left").withColumn(
        "n_failed", F.coalesce("n_failed", F.lit(0))).withColumn("table_ok", F.lit(result.ok))


def _observe_failures(df: DataFrame, out: list, failed: list[str], obs: Observation) -> DataFrame:
    keep = [F.col(c).alias(f"_src_{c}") for c in failed]
    staged = df.select(*out, *keep)
    metrics = [F.count_if(F.col(f"_src_{c}").isNotNull() & F.col(c).isNull()).alias(f"failed_{c}") for c in failed]
    return staged.observe(obs, *metrics).drop(*[f"_src_{c}" for c in failed])
