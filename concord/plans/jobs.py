"""End-to-end jobs built from the operators: what a user runs instead of the reference's entry points.

* ``run_audit``: correspondence file → column report + table summary (+ files);
* ``reconcile_catalog``: every mapped table pair → differences + verdicts.

Table names are resolved by ``resolve`` (default ``spark.table``: any catalog,
including 3-part ``catalog.db.table`` names). The list of pairs is a catalog
listing, one row per table, and is the only thing brought to the driver.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from concord.operators import fingerprint as fp
from concord.operators import schema_audit as sa
from concord.sources.files import load_table_pairs, write_report

Resolver = Callable[[str], DataFrame]


def _names(row) -> tuple[str, str]:
    source = f"{row.oracle_schema}.{row.oracle_table}"
    target = f"{row.bigquery_project}.{row.bigquery_dataset}.{row.bigquery_table}"
    return source, target


def run_audit(spark: SparkSession, pairs_path: str, out_dir: str | None = None, resolve: Resolver | None = None,
              sample_rows: int = 0, case_sensitive: bool = False,
              fmt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Audit every correspondence in ``pairs_path``: ``(column report, table summary)``.

    With ``sample_rows`` > 0, each side's first ``sample_rows`` rows (ordered by
    all its columns, for reproducibility) add sample evidence. With ``out_dir``
    both frames are written as CSV and JSON.
    """
    resolve = resolve or spark.table
    rows = load_table_pairs(spark, pairs_path, fmt).collect()  # one row per table pair
    pairs = []
    for r in rows:
        s, t = _names(r)
        pairs.append(sa.AuditPair(s, t, (lambda n=s: resolve(n)), (lambda n=t: resolve(n))))
    meta, errors = sa.column_metadata(spark, pairs)
    report = sa.compare_columns(meta, errors, case_sensitive)
    if sample_rows > 0:
        ok = {(p.source_table, p.target_table) for p in pairs} - {(e.source_table, e.target_table)
                                                                  for e in errors.collect()}
        src, tgt = [], []
        for p in pairs:
            if (p.source_table, p.target_table) in ok:
                s_df, t_df = p.source(), p.target()
                src.append(sa.pair_samples(s_df, p.source_table, p.target_table, s_df.columns, sample_rows))
                tgt.append(sa.pair_samples(t_df, p.source_table, p.target_table, t_df.columns, sample_rows))
        report = sa.attach_samples(report, *[fp.balanced_union(x) if x else None for x in (src, tgt)])
    pair_frame = spark.createDataFrame([(p.source_table, p.target_table) for p in pairs],
                                       "source_table string, target_table string")
    summary = sa.summarize_tables(report, pair_frame)
    if out_dir:
        for name, df in (("column_report", report), ("table_summary", summary)):
            write_report(df, posixpath.join(out_dir, f"{name}_csv"), "csv")
            write_report(df, posixpath.join(out_dir, f"{name}_json"), "json")
    return report, summary


def reconcile_catalog(spark: SparkSession, mapping: DataFrame, resolve: Resolver | None = None,
                      keys: Sequence[str] | None = None, tolerance: float = fp.DEFAULT_TOLERANCE,
                      group_tolerance: float = 0.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """R1 + R9 over ``mapping(source_table, target_table)``: ``(parity, differences, verdict)``.

    All pairs are planned together: one plan per output, scans and aggregates on
    the cluster, only the small reports returned.
    """
    resolve = resolve or spark.table
    pairs = [fp.Pair(r.source_table, r.target_table, resolve(r.source_table), resolve(r.target_table))
             for r in mapping.select("source_table", "target_table").collect()]  # one row per table pair
    diffs = fp.reconcile(pairs, keys, tolerance, group_tolerance)
    return fp.rowcount_parity(pairs), diffs, fp.verdict(pairs, diffs)


def cost_audit(spark: SparkSession, path: str, fmt: str = "run_report",
               price_per_tib: float | None = None) -> tuple[DataFrame, DataFrame]:
    """C1-C5/G7 from statement files: ``(ranked estimates, totals)``.

    ``fmt='run_report'``: run reports with ``units[].bq_sql`` (script id from
    the report); ``fmt='json'``: a list of ``{id, order, statement_type, sql}``
    (script id = file name). Blank statements are left out.
    """
    from pyspark.sql import functions as F

    from concord.operators import cost as cst

    raw = spark.read.option("multiLine", True).json(path)
    if fmt == "run_report":
        units = raw.select(F.coalesce(F.col("script_id"), F.col("_metadata.file_name")).alias("script_id"),
                           F.explode("units").alias("u")).select(
            "script_id", F.col("u.id").cast("long").alias("query_id"), F.col("u.order").cast("long").alias("unit_order"),
            F.col("u.statement_type").alias("statement_type"), F.col("u.bq_sql").alias("sql"))
    else:
        units = raw.select(F.col("_metadata.file_name").alias("script_id"), F.col("id").cast("long").alias("query_id"),
                           F.col("order").cast("long").alias("unit_order"), "statement_type", "sql")
    units = units.where(cst.non_blank(F.col("sql")))
    price = cst.PRICE_PER_TIB_USD if price_per_tib is None else price_per_tib
    b = cst.text_bytes(F.col("sql"))
    est = units.select("script_id", "query_id", "unit_order", "statement_type", b.alias("estimated_bytes"),
                       cst.cost_usd(b, price).alias("estimated_cost_usd"), cst.preview(F.col("sql")).alias("sql_preview"),
                       F.lit("").alias("error"))
    return cst.rank_costs(est), cst.cost_totals(est, price_per_tib=price)


def preflight(spark: SparkSession, scripts: DataFrame, registry: DataFrame, available: DataFrame,
              schema: str, now: str, legacy_mapping: DataFrame | None = None, project: str = "",
              dataset: str = "", column_registry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """A10 end to end: ``(new registry version, verdict per required table)``.

    ``scripts`` is ``(script_id, sql)`` (pure SQL); the required tables are the
    sources no statement produces (J6). The registry is seeded from
    ``legacy_mapping(source_table, target_table)`` (T2), unknown tables are
    added as pending (T3), and mapped tables are probed against ``available``
    (``table_name``: e.g. ``tables.catalog_listing``) with sticky reachability
    (T4/T8). ``verdict.can_run`` is the go/no-go.
    """
    from pyspark.sql import functions as F

    from concord.operators import lineage as lin
    from concord.operators import registry as reg
    from concord.operators import scripts as scr

    stamp = F.lit(now)
    units = scr.build_units(scripts).select(F.concat_ws(":", "script_id", F.col("unit_id").cast("string"))
                                            .alias("unit_id"), F.col("unit_id").cast("long").alias("unit_order"),
                                            "sources", "targets")
    required = lin.external_roots(units).select(F.lit(schema).alias("source_schema"),
                                                F.col("table_name").alias("source_table"))
    r = registry
    if legacy_mapping is not None:
        r = reg.seed(r, legacy_mapping, schema, project, dataset, stamp)
    r = reg.ensure_pending(r, required, stamp)
    names = available.select(F.lower("table_name").alias("table_name")).distinct().withColumn("_ok", F.lit(True))
    mapped = (r.join(required, reg.KEYS, "left_semi").where(F.col("target_table") != "")
              .select(*reg.KEYS, "target_table"))
    obs = (mapped.join(names.withColumnRenamed("table_name", "source_table").withColumnRenamed("_ok", "source_probe"),
                       "source_table", "left")
           .join(names.withColumnRenamed("table_name", "target_table").withColumnRenamed("_ok", "target_probe"),
                 "target_table", "left")
           .select(*reg.KEYS, F.coalesce("source_probe", F.lit(False)).alias("source_probe"),
                   F.coalesce("target_probe", F.lit(False)).alias("target_probe")))
    r = reg.update_reachability(r, obs, stamp)
    return r, reg.readiness(required, r, column_registry)


def validate_units(spark: SparkSession, units: list[tuple[str, str, str]], source_frames: dict[str, DataFrame],
                   target_frames: dict[str, DataFrame], keys: Sequence[str] | None = None,
                   tolerance: float = fp.DEFAULT_TOLERANCE) -> tuple[DataFrame, DataFrame]:
    """R7/R9 per statement: run each ``(unit_id, source_sql, target_sql)`` on its side and
    compare the two results' fingerprints: ``(differences, verdict)``.

    ``{name}`` placeholders in the SQL bind the given frames (one dict per side).
    Each result stays a distributed DataFrame; the loop is over statements (the
    units of a script), and ``verdict.status`` is ``validated`` or ``flagged``
    per unit, ``batch_status`` for the whole script.
    """
    pairs = [fp.Pair(uid, uid, spark.sql(s_sql, **source_frames), spark.sql(t_sql, **target_frames))
             for uid, s_sql, t_sql in units]
    diffs = fp.reconcile(pairs, keys, tolerance)
    return diffs, fp.verdict(pairs, diffs)


def run_catalog_audit(pairs: DataFrame, source_columns: DataFrame, target_columns: DataFrame,
                      out_dir: str | None = None, case_sensitive: bool = False,
                      readable: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Audit from catalog rows (no schema resolution on the driver): ``(column report, table summary)``.

    ``pairs``: ``(source_table, target_table)`` (e.g. from ``load_table_pairs``,
    names joined with dots); ``*_columns``: INFORMATION_SCHEMA-style rows, see
    ``schema_audit.declared_metadata``. A pair whose tables have no rows on a
    side yields missing/extra columns, as an empty table would; with ``readable``
    (``table_ref`` of the tables that can be read), a pair with a table outside it
    is one ``metadata_error`` row instead.
    """
    errors = None
    if readable is not None:
        from pyspark.sql import functions as F

        known = readable.select("table_ref").distinct()
        marked = pairs.select("source_table", "target_table")
        for side in ("source", "target"):
            marked = marked.join(known.select(F.col("table_ref").alias(f"{side}_table"), F.lit(side).alias(f"_{side}")),
                                 f"{side}_table", "left")
        lost = F.concat_ws(", ", *[F.when(F.col(f"_{s}").isNull(), F.lit(s)) for s in ("source", "target")])
        marked = marked.select("source_table", "target_table", lost.alias("_lost"))
        errors = marked.where("_lost <> ''").select(
            "source_table", "target_table", F.concat(F.lit("not in the catalog: "), F.col("_lost")).alias("notes"))
        good = marked.where("_lost = ''").drop("_lost")
    else:
        good = pairs
    meta = sa.declared_metadata(source_columns, good, "source").unionByName(
        sa.declared_metadata(target_columns, good, "target"))
    report = sa.compare_columns(meta, errors, case_sensitive)
    summary = sa.summarize_tables(report, pairs)
    if out_dir:
        for name, df in (("column_report", report), ("table_summary", summary)):
            write_report(df, posixpath.join(out_dir, f"{name}_csv"), "csv")
            write_report(df, posixpath.join(out_dir, f"{name}_json"), "json")
    return report, summary


def resolve_variables(spark: SparkSession, scripts: DataFrame, text: str = "sql",
                      resolve: Resolver | None = None) -> tuple[DataFrame, DataFrame]:
    """X5 end to end: ``(pure scripts, resolved variables)``.

    Every ``SELECT expr INTO var FROM table tail;`` becomes the variable's literal (ISO dates as ``DATE '…'``), and the
    PL/SQL blocks are dropped. Assignments are resolved by template, not one by one: a tail's literals are lifted out of it
    (``scripts.lift_literals``), and all assignments of one expression, table, template and literal types are one query that
    joins the table with their distinct literals on the template's condition; equalities in it make that an equal join. The literals keep
    the types they have in the statement, so the engine compares as if they stood there. Tails that are more than conditions
    are run as they are, once per distinct text. Expressions that are no aggregate take the first value by order, as a single
    row would give. Variables: ``script_id, var_name, value``; where no row qualifies, what the expression gives for no rows (NULL, 0 for a count).
    """
    from pyspark.sql import functions as F

    from concord.functions.stored import stored, stored_path
    from concord.operators import scripts as scr

    resolve = resolve or spark.table
    template, kinds, literals = scr.lift_literals(F.col("tail"))
    form = ["expr", "table_name", "template", "kinds"]
    found = stored(scr.select_into(scripts, text).select("script_id", "var_name", "expr", "table_name", template.alias("template"),
                                                         kinds.alias("kinds"), literals.alias("literals")), "variables")
    path = stored_path(spark, "resolved")
    schema = "expr string, table_name string, template string, kinds array<string>, literals array<string>, value string"
    for s in found.select(*form).distinct().toLocalIterator():
        aggregate = scr.is_aggregate(s.expr)
        value = f"CAST({s.expr} AS STRING)" if aggregate else f"CAST(min_by({s.expr}, {s.expr}) AS STRING)"
        table, name = resolve(s.table_name), s.table_name.rsplit(".", 1)[-1]
        if s.kinds:
            pieces = s.template.split(scr.HOLE)
            holes = [f"CAST(_literals[{i}] AS {k})" for i, k in enumerate(s.kinds)]
            condition = "".join(a + b for a, b in zip(pieces, [*holes, ""]))[len("WHERE"):]
            mine = (F.col("expr") == s.expr) & (F.col("table_name") == s.table_name) & (F.col("template") == s.template) & (F.col("kinds") == F.lit(s.kinds))
            wanted = stored(found.where(mine).select(F.col("literals").alias("_literals")).distinct(), "literals")
            hits = spark.sql(f"SELECT _literals AS _found, {value} AS value FROM {{p}} JOIN {{t}} AS `{name}` ON {condition} GROUP BY _literals", p=wanted, t=table)
            none = spark.sql(f"SELECT {value} AS value FROM {{t}} AS `{name}` WHERE false", t=table).first()[0]
            got = wanted.join(hits, F.col("_literals") == F.col("_found"), "left").select(
                F.col("_literals").alias("literals"), F.when(F.col("_found").isNull(), F.lit(none).cast("string")).otherwise(F.col("value")).alias("value"))
        else:
            got = spark.sql(f"SELECT {value} AS value FROM {{t}} AS `{name}` {s.template}", t=table).limit(1).select(
                F.array().cast("array<string>").alias("literals"), "value")
        got.select(*[F.lit(getattr(s, c)).cast("array<string>" if c == "kinds" else "string").alias(c) for c in form], "literals", "value").write.mode(
            "append").parquet(path)
    if not found.limit(1).count():
        spark.createDataFrame([], schema).write.parquet(path)
    resolved = spark.read.schema(schema).parquet(path)
    variables = found.join(resolved.hint("merge"), [*form, "literals"], "left").select("script_id", "var_name", "value")
    return scr.materialize_variables(scripts, variables, text), variables
