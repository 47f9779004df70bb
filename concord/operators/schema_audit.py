"""Schema audit (A1, A4-A9): align two sides' columns and judge them.

Column metadata comes from each side's schema (``df.schema`` or the catalog),
never from rows, and is turned into one small DataFrame for the whole catalog.
The alignment is one full outer join over *all* pairs at once, then a ``CASE``
chain per column; table verdicts are conditional counts per pair.

Statuses and severities (fixed values of the reference):

* ``extra_target`` (warning): only the target has the column;
* ``missing_target`` (error): only the source has it;
* ``type_mismatch`` (error): type families differ;
* ``compatible_with_warnings`` (warning): same family, target narrower
  (required vs nullable, lower precision / scale / length);
* ``compatible`` (ok);
* ``metadata_error`` (error): a side's schema could not be resolved.

Sample evidence (A8) is attached for information and never changes a verdict.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from concord.functions.concurrent import run_all
from concord.functions.text import strip_ws
from concord.functions.types import char_length, declared_type, numeric_shape, type_family

META_SCHEMA = ("source_table string, target_table string, side string, column_name string, raw_type string, "
               "nullable boolean, ordinal int, length int, precision int, scale int")
PAIR_KEYS = ["source_table", "target_table"]


@dataclass(frozen=True)
class AuditPair:
    """A source/target pair whose schemas are resolved lazily (a failure becomes a metadata_error row)."""

    source_table: str
    target_table: str
    source: Callable[[], DataFrame]
    target: Callable[[], DataFrame]


def _meta_rows(pair: AuditPair, side: str, df: DataFrame) -> list[tuple]:
    rows = []
    for i, f in enumerate(df.schema.fields, start=1):
        precision, scale = numeric_shape(f.dataType)
        rows.append((pair.source_table, pair.target_table, side, f.name, declared_type(f.dataType),
                     bool(f.nullable), i, char_length(f.dataType), precision, scale))
    return rows


def column_metadata(spark: SparkSession, pairs: Sequence[AuditPair]) -> tuple[DataFrame, DataFrame]:
    """``(metadata, errors)``; ``errors`` holds ``(source_table, target_table, notes)``.

    Only schemas are resolved here (catalog calls from the driver, several at the same time); one failing pair
    does not stop the others.
    """
    meta, errors = [], []
    calls = [lambda p=p: _meta_rows(p, "source", p.source()) + _meta_rows(p, "target", p.target()) for p in pairs]
    for p, rows in zip(pairs, run_all(spark, calls)):
        if isinstance(rows, Exception):  # unresolvable table or path: report, continue
            errors.append((p.source_table, p.target_table, f"{type(rows).__name__}: {str(rows).splitlines()[0]}"))
        else:
            meta.extend(rows)
    m = spark.createDataFrame(meta, META_SCHEMA).withColumn("type_family", type_family(F.col("raw_type")))
    e = spark.createDataFrame(errors, "source_table string, target_table string, notes string")
    return m, e


def _side(meta: DataFrame, side: str, case_sensitive: bool) -> DataFrame:
    key = F.col("column_name") if case_sensitive else F.lower("column_name")
    p = "source_" if side == "source" else "target_"
    return meta.where(F.col("side") == side).select(
        *PAIR_KEYS, key.alias("column_key"),
        *[F.col(c).alias(p + c) for c in ("column_name", "raw_type", "type_family", "nullable", "length",
                                          "precision", "scale")])


def _truthy(c: Column) -> Column:
    return c.isNotNull() & (c != 0)


def compare_columns(meta: DataFrame, errors: DataFrame | None = None, case_sensitive: bool = False) -> DataFrame:
    """One row per pair and column key with status, severity and notes."""
    s, t = _side(meta, "source", case_sensitive), _side(meta, "target", case_sensitive)
    j = s.join(t, PAIR_KEYS + ["column_key"], "full_outer")
    sp, tp = F.col("source_column_name").isNotNull(), F.col("target_column_name").isNotNull()
    same_family = sp & tp & (F.col("source_type_family") == F.col("target_type_family"))
    w = [
        F.when((F.col("source_nullable") == True) & (F.col("target_nullable") == False),  # noqa: E712
               F.lit("target column is required but the source column is nullable")),
        F.when(_truthy(F.col("source_precision")) & _truthy(F.col("target_precision"))
               & (F.col("target_precision") < F.col("source_precision")),
               F.concat(F.lit("target precision "), F.col("target_precision").cast("string"),
                        F.lit(" is lower than source precision "), F.col("source_precision").cast("string"))),
        F.when(_truthy(F.col("source_scale")) & F.col("target_scale").isNotNull()
               & (F.col("target_scale") < F.col("source_scale")),
               F.concat(F.lit("target scale "), F.col("target_scale").cast("string"),
                        F.lit(" is lower than source scale "), F.col("source_scale").cast("string"))),
        F.when(_truthy(F.col("source_length")) & _truthy(F.col("target_length"))
               & (F.col("target_length") < F.col("source_length")),
               F.concat(F.lit("target length "), F.col("target_length").cast("string"),
                        F.lit(" is lower than source length "), F.col("source_length").cast("string"))),
    ]
    any_warning = w[0].isNotNull() | w[1].isNotNull() | w[2].isNotNull() | w[3].isNotNull()
    status = (F.when(~sp, "extra_target").when(~tp, "missing_target")
              .when(~same_family, "type_mismatch")
              .when(any_warning, "compatible_with_warnings").otherwise("compatible"))
    severity = (F.when(status.isin("missing_target", "type_mismatch"), "error")
                .when(status.isin("extra_target", "compatible_with_warnings"), "warning").otherwise("ok"))
    base_note = (F.when(~sp, F.lit("column exists only in the target"))
                 .when(~tp, F.lit("column exists in the source but is missing from the target"))
                 .when(~same_family, F.concat(F.lit("type family changed from "), F.col("source_type_family"),
                                              F.lit(" to "), F.col("target_type_family"))))
    # Warnings count only when both sides exist with the same family.
    notes = F.when(same_family, F.concat_ws("; ", *w)).otherwise(F.concat_ws("; ", base_note))
    out = j.select(
        *PAIR_KEYS, "column_key", "source_column_name", "target_column_name", "source_raw_type", "target_raw_type",
        "source_type_family", "target_type_family", sp.alias("source_present"), tp.alias("target_present"),
        status.alias("status"), severity.alias("severity"), "source_nullable", "target_nullable",
        "source_length", "target_length", "source_precision", "target_precision", "source_scale", "target_scale",
        notes.alias("notes"))
    if errors is not None:
        fixed = {"source_present": F.lit(False), "target_present": F.lit(False),
                 "status": F.lit("metadata_error"), "severity": F.lit("error"), "notes": F.col("notes")}
        err = errors.select(*[
            F.col(f.name) if f.name in PAIR_KEYS else
            fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in out.schema.fields])
        out = out.unionByName(err)
    return out


def summarize_tables(report: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """Per pair counts and ``blocked`` / ``warning`` / ``compatible``.

    Pass ``pairs`` (``source_table, target_table``) to report pairs with no
    columns at all; they are ``compatible``.
    """
    g = report.groupBy(*PAIR_KEYS).agg(
        F.count(F.lit(1)).alias("total_columns"),
        F.count_if(F.col("severity") == "ok").alias("compatible_columns"),
        F.count_if(F.col("severity") == "warning").alias("warning_columns"),
        F.count_if(F.col("severity") == "error").alias("error_columns"))
    if pairs is not None:
        g = pairs.select(*PAIR_KEYS).join(g, PAIR_KEYS, "left").fillna(
            0, ["total_columns", "compatible_columns", "warning_columns", "error_columns"])
    return g.withColumn("status", F.when(F.col("error_columns") > 0, "blocked")
                        .when(F.col("warning_columns") > 0, "warning").otherwise("compatible"))


def column_gate(report: DataFrame) -> DataFrame:
    """A5: the strict gate of the readiness check; anything not compatible blocks,
    ``extra_target`` too (it only warns in the audit).

    The gate compares type families only, so shape warnings (narrower precision,
    required vs nullable) do not block here.
    ``(source_table, target_table, blocking_columns, can_run)``.
    """
    return report.groupBy(*PAIR_KEYS).agg(
        F.count_if(~F.col("status").isin("compatible", "compatible_with_warnings")).alias("blocking_columns")
    ).withColumn("can_run", F.col("blocking_columns") == 0)


def sample_evidence(df: DataFrame, order_by: Sequence[str], limit: int = 1000, examples: int = 3,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """Over the first ``limit`` rows by ``order_by``, per column the
    non-null count and the first ``examples`` distinct rendered values (JSON text).

    The sample is a top-k (per-partition top-k, then a merge), not a sort of the table.
    """
    columns = list(columns or df.columns)
    sample = df.orderBy(*order_by).limit(limit).select(
        F.row_number().over(Window.orderBy(*order_by)).alias("_pos"), *columns)
    types = {f.name: f.dataType for f in df.schema.fields}

    def rendered(c: str) -> Column:
        # str() of the value, as the reference renders examples (booleans as True/False)
        if isinstance(types[c], BooleanType):
            return F.when(F.col(c), F.lit("True")).when(~F.col(c), F.lit("False"))
        return F.col(c).cast("string")

    long = sample.select("_pos", F.inline(F.array(*[
        F.struct(F.lit(c.lower()).alias("column_key"), rendered(c).alias("value")) for c in columns])))
    counts = long.groupBy("column_key").agg(F.count("value").alias("non_null"))
    firsts = long.where(F.col("value").isNotNull()).groupBy("column_key", "value").agg(F.min("_pos").alias("_pos"))
    ranked = firsts.withColumn("_r", F.row_number().over(Window.partitionBy("column_key").orderBy("_pos"))).where(
        F.col("_r") <= examples)
    ex = ranked.groupBy("column_key").agg(
        F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "value"))), lambda x: x["value"]))
        .alias("example_values"))
    return counts.join(ex, "column_key", "left").select(
        "column_key", "non_null", F.coalesce("example_values", F.lit("[]")).alias("example_values"))


def attach_samples(report: DataFrame, source_samples: DataFrame | None, target_samples: DataFrame | None) -> DataFrame:
    """Add ``{source,target}_sample_non_null`` / ``_sample_values`` to the column report.

    Each samples frame is ``(source_table, target_table, column_key, non_null,
    example_values)`` (``sample_evidence`` output plus the pair columns). Sample
    evidence is informational; statuses are unchanged. Missing samples give
    NULL counts and empty text, as in the reference.
    """
    out = report
    for side, samples in (("source", source_samples), ("target", target_samples)):
        if samples is None:
            out = out.withColumn(f"{side}_sample_non_null", F.lit(None).cast("long")).withColumn(
                f"{side}_sample_values", F.lit(""))
            continue
        s = samples.select(*PAIR_KEYS, "column_key", F.col("non_null").alias(f"{side}_sample_non_null"),
                           F.col("example_values").alias(f"{side}_sample_values"))
        present = F.col(f"{side}_present")
        out = out.join(s, PAIR_KEYS + ["column_key"], "left").withColumn(
            f"{side}_sample_non_null", F.when(present, F.col(f"{side}_sample_non_null"))).withColumn(
            f"{side}_sample_values", F.when(present, F.coalesce(F.col(f"{side}_sample_values"), F.lit("")))
            .otherwise(F.lit("")))
    return out


def pair_samples(df: DataFrame, source_table: str, target_table: str, order_by: Sequence[str],
                 limit: int = 1000) -> DataFrame:
    """``sample_evidence`` of one side, tagged with its pair."""
    return sample_evidence(df, order_by, limit).select(
        F.lit(source_table).alias("source_table"), F.lit(target_table).alias("target_table"), "*")


def declared_metadata(columns: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    """A1/A3 for catalogs read as data: INFORMATION_SCHEMA-style rows → metadata rows.

    ``columns``: ``(table_ref, column_name, data_type, is_nullable, ordinal,
    length, precision, scale)`` with declared type strings (e.g. read over
    JDBC); ``pairs``: ``(source_table, target_table)``; ``side``: which pair
    column ``table_ref`` matches. Missing precision/scale default from the type
    name (NUMERIC (38,9), BIGNUMERIC (76,38), INT64 (19,0)), and are parsed from
    ``DECIMAL(p,s)``-style names. A join, not a driver loop: a catalog with
    millions of columns stays distributed. Feed both sides' results to
    ``compare_columns``.
    """
    from concord.functions.types import NUMERIC_SHAPES

    t = F.upper(strip_ws(F.col("data_type")))
    shape_p = shape_s = None
    for name, (p, s) in NUMERIC_SHAPES.items():
        shape_p = (F.when(t == name, F.lit(p)) if shape_p is None else shape_p.when(t == name, F.lit(p)))
        shape_s = (F.when(t == name, F.lit(s)) if shape_s is None else shape_s.when(t == name, F.lit(s)))
    parsed_p = F.regexp_extract(t, r"\(\s*(\d+)\s*(?:,\s*\d+\s*)?\)", 1)
    parsed_s = F.regexp_extract(t, r"\(\s*\d+\s*,\s*(\d+)\s*\)", 1)
    precision = F.coalesce(F.col("precision").cast("int"), F.nullif(parsed_p, F.lit("")).cast("int"), shape_p)
    scale = F.coalesce(F.col("scale").cast("int"), F.nullif(parsed_s, F.lit("")).cast("int"), shape_s)
    key = "source_table" if side == "source" else "target_table"
    nullable = F.upper(strip_ws(F.col("is_nullable").cast("string"))).isin("YES", "Y", "TRUE", "1")
    j = columns.join(pairs.select("source_table", "target_table"), F.col("table_ref") == F.col(key))
    return j.select(
        "source_table", "target_table", F.lit(side).alias("side"), "column_name", t.alias("raw_type"),
        F.when(F.col("is_nullable").isNull(), F.lit(None).cast("boolean")).otherwise(nullable).alias("nullable"),
        F.col("ordinal").cast("int").alias("ordinal"), F.col("length").cast("int").alias("length"),
        precision.alias("precision"), scale.alias("scale"), type_family(t).alias("type_family"))
