"""Source↔target correspondence registry as DataFrames.

The registry is a table keyed on ``(source_schema, source_table)``. Every
change returns a *new version* of it (parquet has no MERGE): write the result
to a new location, then point readers at it; never overwrite a path that is
being read. Keys and target table names are lower-cased on the way in.

Status state machine (T4): a row with a target table and both sides reachable
becomes ``ready``; a ``ready`` row that no longer is becomes ``blocked``; other
statuses are left alone. Reachability is sticky (T8): a side once seen
reachable is not probed again unless ``recheck=True``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions.text import strip_ws
from concord.sources.files import CSV_READ, CSV_WRITE

KEYS = ["source_schema", "source_table"]
REGISTRY_SCHEMA = ("source_schema string, source_table string, target_project string, target_dataset string, "
                   "target_table string, status string, source_reachable boolean, source_checked_at string, "
                   "target_reachable boolean, target_checked_at string, notes string, created_at string, "
                   "updated_at string")
REGISTRY_COLUMNS = [f.split()[0] for f in REGISTRY_SCHEMA.split(", ")]
COLUMN_REGISTRY_SCHEMA = ("source_schema string, source_table string, source_column string, source_type string, "
                          "target_project string, target_dataset string, target_table string, target_column string, "
                          "target_type string, source_present boolean, target_present boolean, "
                          "compatibility_status string, checked_at string, notes string")
# The reference's CSV header, in its order, and our names for it.
CSV_COLUMNS = ["oracle_schema", "oracle_table", "bigquery_project", "bigquery_dataset", "bigquery_table", "status",
               "oracle_reachable", "oracle_checked_at", "bigquery_reachable", "bigquery_checked_at", "notes"]
CSV_TO_REGISTRY = dict(zip(CSV_COLUMNS, ["source_schema", "source_table", "target_project", "target_dataset",
                                         "target_table", "status", "source_reachable", "source_checked_at",
                                         "target_reachable", "target_checked_at", "notes"]))
TRUTHY = ("1", "true", "yes", "y")
UPDATABLE = [c for c in REGISTRY_COLUMNS if c not in KEYS + ["created_at", "updated_at"]]


def _norm_keys(df: DataFrame) -> DataFrame:
    return df.withColumn("source_schema", F.lower("source_schema")).withColumn("source_table", F.lower("source_table"))


def new_rows(df: DataFrame, now: Column, status: str = "pending") -> DataFrame:
    """Complete partial rows (any subset of registry columns plus keys) with defaults."""
    defaults = {"target_project": F.lit(""), "target_dataset": F.lit(""), "target_table": F.lit(""),
                "status": F.lit(status), "source_reachable": F.lit(False), "source_checked_at": F.lit(""),
                "target_reachable": F.lit(False), "target_checked_at": F.lit(""), "notes": F.lit(""),
                "created_at": now, "updated_at": now}
    cols = []
    for c in REGISTRY_COLUMNS:
        cols.append(F.col(c) if c in df.columns else defaults[c].alias(c))
    return _norm_keys(df.select(*cols)).withColumn("target_table", F.lower("target_table"))


def upsert(registry: DataFrame, updates: DataFrame, now: Column, order: str | None = None) -> DataFrame:
    """Insert or replace rows by key; ``created_at`` of existing rows is kept, ``updated_at`` = now.

    Several updates of one key are applied in ``order`` (the last one wins, as
    sequential upserts would), reduced by a partial ``max_by`` before the join.
    Without ``order`` the updates must hold one row per key.
    """
    if order is not None:
        rest = [c for c in updates.columns if c not in KEYS]
        last = _norm_keys(updates).groupBy(*KEYS).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r"))
        updates = last.select(*KEYS, *[F.col(f"_r.{c}").alias(c) for c in rest])
    u = new_rows(updates, now).drop("created_at", "updated_at")
    u = u.withColumn("_u", F.lit(True))
    r = registry.select(*KEYS, "created_at", *[F.col(c).alias(f"_old_{c}") for c in UPDATABLE], "updated_at")
    j = r.join(u, KEYS, "full_outer")
    hit = F.coalesce(F.col("_u"), F.lit(False))
    cols = [F.when(hit, F.col(c)).otherwise(F.col(f"_old_{c}")).alias(c) for c in UPDATABLE]
    return j.select(*KEYS, *cols, F.coalesce("created_at", now).alias("created_at"),
                    F.when(hit, now).otherwise(F.col("updated_at")).alias("updated_at")).select(*REGISTRY_COLUMNS)


def seed(registry: DataFrame, mapping: DataFrame, schema: str, project: str, dataset: str, now: Column) -> DataFrame:
    """Rows for mapping keys not yet registered, as ``ready``; existing rows untouched.

    ``mapping`` is ``(source_table, target_table)``.
    """
    m = mapping.select(F.lit(schema).alias("source_schema"), "source_table", F.lit(project).alias("target_project"),
                       F.lit(dataset).alias("target_dataset"), "target_table")
    fresh = new_rows(m, now, status="ready").join(registry.select(*KEYS), KEYS, "left_anti")
    return registry.unionByName(fresh)


def ensure_pending(registry: DataFrame, tables: DataFrame, now: Column) -> DataFrame:
    """Add a ``pending`` row for every ``(source_schema, source_table)`` not registered."""
    missing = _norm_keys(tables.select(*KEYS)).distinct().join(registry.select(*KEYS), KEYS, "left_anti")
    return registry.unionByName(new_rows(missing, now))


def is_ready(r: str = "") -> Column:
    """T5: status ready, a target table, both sides reachable."""
    c = lambda n: F.col(f"{r}{n}")
    return ((c("status") == "ready") & (F.coalesce(c("target_table"), F.lit("")) != "")
            & c("source_reachable") & c("target_reachable"))


def mapping_of(registry: DataFrame) -> DataFrame:
    """T5: ``(source_table, target_table)`` of ready rows."""
    return registry.where(is_ready()).select("source_table", "target_table")


def update_reachability(registry: DataFrame, observations: DataFrame, now: Column, recheck: bool = False) -> DataFrame:
    """Apply probe results ``(source_schema, source_table, source_probe, target_probe)``.

    A NULL probe leaves that side unchanged. Unregistered keys are first added as
    pending (as the reference does). Sticky: ``reachable = cached OR probe``.
    """
    obs = _norm_keys(observations.select(*KEYS, "source_probe", "target_probe"))
    reg = ensure_pending(registry, obs, now)
    j = reg.join(obs, KEYS, "left")
    seen = F.col("source_probe").isNotNull() | F.col("target_probe").isNotNull()

    def side(flag: str, probe: str, at: str) -> tuple[Column, Column]:
        new = F.col(probe) if recheck else (F.col(flag) | F.col(probe))
        value = F.when(F.col(probe).isNotNull(), new).otherwise(F.col(flag))
        stamp = F.when(F.col(probe).isNotNull(), now).otherwise(F.col(at))
        return value.alias(flag), stamp.alias(at)

    sr, sa = side("source_reachable", "source_probe", "source_checked_at")
    tr, ta = side("target_reachable", "target_probe", "target_checked_at")
    j = j.select(*[c for c in REGISTRY_COLUMNS if c not in ("source_reachable", "source_checked_at",
                                                          "target_reachable", "target_checked_at")],
                 sr, sa, tr, ta, "source_probe", "target_probe")
    both = (F.coalesce(F.col("target_table"), F.lit("")) != "") & F.col("source_reachable") & F.col("target_reachable")
    status = F.when(~seen, F.col("status")).when(both, "ready").when(F.col("status") == "ready", "blocked").otherwise(
        F.col("status"))
    return j.withColumn("status", status).withColumn(
        "updated_at", F.when(seen, now).otherwise(F.col("updated_at"))).select(*REGISTRY_COLUMNS)


def layered_mapping(layers: list[tuple[str, DataFrame]]) -> DataFrame:
    """Merge ``(source_table, target_table)`` layers; a later layer wins.

    ``(source_table, target_table, layer)``; one ``max_by`` per source table,
    partially aggregated before the shuffle.
    """
    parts = [df.select("source_table", "target_table", F.lit(i).alias("_p"), F.lit(name).alias("layer"))
             for i, (name, df) in enumerate(layers)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    w = u.groupBy("source_table").agg(F.max_by(F.struct("target_table", "layer"), "_p").alias("_w"))
    return w.select("source_table", F.col("_w.target_table").alias("target_table"), F.col("_w.layer").alias("layer"))


def lookup(keys: DataFrame, registry: DataFrame) -> DataFrame:
    """The registry row (or NULLs) for each requested key."""
    return _norm_keys(keys.select(*KEYS)).join(registry, KEYS, "left")


def replace_columns(columns: DataFrame, new_columns: DataFrame) -> DataFrame:
    """Drop all column rows of the tables present in ``new_columns``, then add the new rows."""
    tables = new_columns.select(*KEYS).distinct()
    return columns.join(tables, KEYS, "left_anti").unionByName(new_columns.select(*columns.columns))


def column_rows(report: DataFrame, source_schema: str, now: Column, project: str = "", dataset: str = "") -> DataFrame:
    """A4 → T6: column-registry rows from a column audit report.

    The registry keeps the family-only status of the readiness check:
    ``compatible_with_warnings`` is stored as ``compatible``. Feed the result to
    ``replace_columns``, then to ``readiness``.
    """
    status = F.when(F.col("status") == "compatible_with_warnings", F.lit("compatible")).otherwise(F.col("status"))
    return report.select(
        F.lit(source_schema.lower()).alias("source_schema"), F.lower("source_table").alias("source_table"),
        F.col("column_key").alias("source_column"), F.coalesce("source_raw_type", F.lit("")).alias("source_type"),
        F.lit(project).alias("target_project"), F.lit(dataset).alias("target_dataset"),
        F.lower("target_table").alias("target_table"),
        F.when(F.col("target_present"), F.col("column_key")).otherwise(F.lit("")).alias("target_column"),
        F.coalesce("target_raw_type", F.lit("")).alias("target_type"), "source_present", "target_present",
        status.alias("compatibility_status"), now.alias("checked_at"), F.coalesce("notes", F.lit("")).alias("notes"))


def _truthy(c: Column) -> Column:
    return F.lower(strip_ws(F.coalesce(c.cast("string"), F.lit("")))).isin(*TRUTHY)


def import_rows(raw: DataFrame) -> DataFrame:
    """Normalise raw text rows (reference or our header names) into registry columns.

    Rows without a schema or table are skipped; text is trimmed; keys, target
    table and status lower-cased; blank status is ``pending``; flags are true for
    1/true/yes/y. ``created_at``/``updated_at`` are left to ``upsert``.
    """
    renamed = raw.withColumnsRenamed({k: v for k, v in CSV_TO_REGISTRY.items() if k in raw.columns})
    missing = [c for c in KEYS if c not in renamed.columns]
    if missing:
        raise ValueError(f"the registry file has no column: {', '.join(missing)}")

    def txt(c: str) -> Column:
        return strip_ws(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in renamed.columns else F.lit("")

    kept = renamed.where((F.coalesce(F.col("source_schema"), F.lit("")) != "")
                         & (F.coalesce(F.col("source_table"), F.lit("")) != ""))
    status = F.lower(txt("status"))
    return kept.select(
        F.lower(txt("source_schema")).alias("source_schema"), F.lower(txt("source_table")).alias("source_table"),
        txt("target_project").alias("target_project"), txt("target_dataset").alias("target_dataset"),
        F.lower(txt("target_table")).alias("target_table"),
        F.when(status == "", F.lit("pending")).otherwise(status).alias("status"),
        (_truthy(F.col("source_reachable")) if "source_reachable" in renamed.columns else F.lit(False)).alias("source_reachable"),
        txt("source_checked_at").alias("source_checked_at"),
        (_truthy(F.col("target_reachable")) if "target_reachable" in renamed.columns else F.lit(False)).alias("target_reachable"),
        txt("target_checked_at").alias("target_checked_at"), txt("notes").alias("notes"))


def import_csv(spark, path: str) -> DataFrame:
    """Read a registry CSV (header required, BOM tolerated, all text) and normalise it."""
    raw = spark.read.options(**CSV_READ).csv(path)
    raw = raw.withColumnsRenamed({c: c.lstrip("﻿") for c in raw.columns if c.startswith("﻿")})
    return import_rows(raw)


def export_frame(registry: DataFrame) -> DataFrame:
    """Rows in the reference's CSV layout, sorted by key, flags as lower-case text."""
    back = {v: k for k, v in CSV_TO_REGISTRY.items()}
    cols = []
    for ours in CSV_TO_REGISTRY.values():
        c = F.col(ours)
        if ours.endswith("_reachable"):
            c = F.when(c, "true").otherwise("false")
        cols.append(c.alias(back[ours]))
    return registry.orderBy(*KEYS).select(*cols)


# An example row for a template to fill in; the keys are the file's header.
TEMPLATE_ROW = {"oracle_schema": "sales", "oracle_table": "invoices", "bigquery_project": "my-project",
                "bigquery_dataset": "landing", "bigquery_table": "invoices_raw", "status": "pending",
                "oracle_reachable": "false", "oracle_checked_at": "", "bigquery_reachable": "false",
                "bigquery_checked_at": "", "notes": "an example: overwrite this line"}


def template_frame(spark) -> DataFrame:
    """The CSV template (header plus one example row), all text."""
    return spark.createDataFrame([tuple(TEMPLATE_ROW[c] for c in CSV_COLUMNS)],
                                 ", ".join(f"{c} string" for c in CSV_COLUMNS))


def export_csv(registry: DataFrame, path: str) -> None:
    """Write the registry as CSV with the reference's header (one file per partition, sorted)."""
    export_frame(registry).write.mode("overwrite").options(**CSV_WRITE).csv(path)


def readiness(required: DataFrame, registry: DataFrame, column_registry: DataFrame | None = None) -> DataFrame:
    """A10: one verdict row per required ``(source_schema, source_table)``.

    ``verdict``: ``unknown`` (no row or no target), ``blocked`` (not ready),
    ``schema_blocked`` (a column row not ``compatible``), else ``ready``;
    ``can_run`` (same on every row) is true only when all are ``ready``. All
    three checks are reported for every table (the reference skips the schema
    check once a table is unknown or blocked; ``can_run`` is the same).
    """
    req = _norm_keys(required.select(*KEYS)).distinct()
    j = req.join(registry.select(*KEYS, "target_table", "status", "source_reachable", "target_reachable"), KEYS, "left")
    registered = F.col("status").isNotNull()
    if column_registry is not None:
        bad = column_registry.where(F.col("compatibility_status") != "compatible").groupBy(*KEYS).agg(
            F.count(F.lit(1)).alias("incompatible_columns"))
        j = j.join(bad, KEYS, "left")
    else:
        j = j.withColumn("incompatible_columns", F.lit(None).cast("long"))
    inc = F.coalesce(F.col("incompatible_columns"), F.lit(0))
    verdict = (F.when(~registered | (F.coalesce(F.col("target_table"), F.lit("")) == ""), "unknown")
               .when(~F.coalesce(is_ready(), F.lit(False)), "blocked")
               .when(inc > 0, "schema_blocked").otherwise("ready"))
    out = j.select(*KEYS, registered.alias("registered"), F.coalesce(is_ready(), F.lit(False)).alias("ready"),
                   inc.alias("incompatible_columns"), verdict.alias("verdict"))
    # One global flag as a scalar subquery (computed once), not a single-partition window.
    all_ready = out.agg(F.coalesce(F.min(F.col("verdict") == "ready"), F.lit(True))).scalar()
    return out.withColumn("can_run", all_ready)
