"""File sources and sinks.

All reads are distributed Spark reads; the only driver-side results are small
counts or a raised error naming bad input.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from concord.functions.stored import stored
from concord.functions.text import strip_ws

PAIR_FIELDS = ["oracle_schema", "oracle_table", "bigquery_project", "bigquery_dataset", "bigquery_table"]
# CSV as other programs write it: quotes doubled inside quotes, line breaks inside quotes, no trimming.
CSV_READ = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "encoding": "UTF-8",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "", "escapeQuotes": "true",
             "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
BOM = "﻿"


def _strip_bom(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: c.lstrip(BOM) for c in df.columns if c.startswith(BOM)})


def load_table_pairs(spark: SparkSession, path: str, fmt: str | None = None,
                     columns: Mapping[str, str] | None = None, strict: bool = True) -> DataFrame:
    """Correspondence rows from CSV (header, BOM tolerated) or JSON (a list, or ``{"tables": [...]}``).

    ``columns`` renames input headers to the five required fields; values are
    trimmed text. With ``strict`` a row missing a field raises ``ValueError``
    (one small count); otherwise such rows are dropped.
    """
    fmt = (fmt or path.rsplit(".", 1)[-1]).lower()
    if fmt == "csv":
        raw = _strip_bom(spark.read.options(**CSV_READ).csv(path))
    elif fmt == "json":
        raw = spark.read.option("multiLine", True).json(path)
        if "tables" in raw.columns and isinstance(raw.schema["tables"].dataType, ArrayType):
            raw = raw.select(F.explode("tables").alias("t")).select("t.*")
    else:
        raise ValueError(f"Unsupported input format: {fmt}")
    inverse = {src: field for field, src in (columns or {}).items()}
    raw = raw.withColumnsRenamed({c: inverse[c] for c in raw.columns if c in inverse})
    vals = [strip_ws(F.coalesce(F.col(f).cast("string"), F.lit(""))).alias(f) if f in raw.columns
            else F.lit("").alias(f) for f in PAIR_FIELDS]
    pairs = raw.select(*vals)
    complete = F.lit(True)
    for f in PAIR_FIELDS:
        complete = complete & (F.col(f) != "")
    if strict:
        bad = pairs.where(~complete).limit(1).collect()
        if bad:
            missing = [f for f in PAIR_FIELDS if not bad[0][f]]
            raise ValueError(f"a table pair lacks a value for: {', '.join(missing)}")
        return pairs
    return pairs.where(complete)


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a report frame as CSV (with header) or JSON lines."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.options(**CSV_WRITE).csv(path)
    else:
        w.json(path)


def ingest_prefix(spark: SparkSession, uri: str) -> DataFrame:
    """Every object under a prefix, recursively: ``(relative_path, length, modification_time, content)``.

    Directory markers (names ending in '/') are skipped; ``count()`` of the
    result is the number of objects ingested.
    """
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(uri)
    # Compare paths without their scheme ('file:/x' and 'file:///x' are the same place).
    scheme = r"^[A-Za-z][A-Za-z0-9+.-]*:/+"
    base = re.sub(scheme, "/", uri).rstrip("/") + "/"
    path = F.regexp_replace(F.col("path"), scheme, "/")
    rel = F.when(path.startswith(base), F.substring(path, len(base) + 1, 1 << 30)).otherwise(
        F.regexp_extract(path, r"[^/]+$", 0))
    return df.where(~F.col("path").endswith("/")).select(
        rel.alias("relative_path"), "length", F.col("modificationTime").alias("modification_time"), "content")


def list_sql_scripts(spark: SparkSession, directory: str) -> DataFrame:
    """``*.sql`` files directly in ``directory`` (suffix case-insensitive), whole text each,
    ``(script_id, file_name, sql)`` sorted by file name.

    Files of other suffixes are not opened, and each script is opened once: the texts are stored before they are sorted and counted.
    """
    df = spark.read.option("wholetext", True).option("recursiveFileLookup", False).option("pathGlobFilter", "*.[sS][qQ][lL]").text(directory)
    texts = stored(df.select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("sql")), "scripts")
    return texts.select(F.regexp_replace("file_name", r"(?i)\.sql$", "").alias("script_id"), "file_name", "sql").orderBy("file_name")


def run_reports(spark: SparkSession, root: str, pattern: str = "*_bq/run_report_*.json", lines: bool = False) -> DataFrame:
    """Run reports under ``root``, newest first by (modification time, name), with a ``recency`` rank.

    A file is one report, or with ``lines`` a report a line. Files are ranked by range partitions of the time, each counted from
    the numbers of those before it, so no task ranks them all.
    """
    df = spark.read.option("multiLine", not lines).json(f"{root.rstrip('/')}/{pattern}")
    meta = df.select("*", F.col("_metadata.file_path").alias("report_path"), F.col("_metadata.file_name").alias("report_name"),
                     F.col("_metadata.file_modification_time").alias("report_mtime"))
    # only a path, a name and a time per file are ranked; the reports themselves stay where they are
    files = meta.select("report_path", "report_name", "report_mtime").distinct()
    order = [F.desc("report_mtime"), F.desc("report_name"), F.desc("report_path")]
    placed = stored(files.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "reports")
    within = placed.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    # one number a partition
    sums = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranked = within.join(before, "_part").select("report_path", (F.col("_n") + F.col("_before")).cast("int").alias("recency"))
    return meta.join(ranked, "report_path")


def report_units(reports: DataFrame) -> DataFrame:
    """One row per unit of each report (``explode(units)``)."""
    return reports.select("report_path", "recency", "script_id", F.explode("units").alias("u")).select(
        "report_path", "recency", "script_id", "u.*")


def latest_by(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` tuple per key.

    ``max_by`` over a struct, so the choice is partially aggregated before the
    shuffle: a key holding a third of the rows does not land in one task.
    """
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return picked.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])
