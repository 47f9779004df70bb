"""Table sources and sinks.

Reads are lazy DataFrames; Catalyst prunes columns and pushes filters into the
scan. Writes go through ``DataFrameWriter`` so they are distributed and retried
per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from concord.functions.concurrent import AT_ONCE, reason, run_all

# The driver-generated tables available under every sf directory.
DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of an sf directory."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_any(spark: SparkSession, ref: str, fmt: str = "parquet", options: Mapping[str, str] | None = None) -> DataFrame:
    """A catalog table (``fmt='table'``), a JDBC table (``fmt='jdbc'``) or a path.

    For JDBC pass ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions`` in ``options`` so the table is read by parallel range
    queries instead of one connection.
    """
    if fmt == "table":
        return spark.table(ref)
    reader = spark.read.options(**dict(options or {}))
    if fmt == "jdbc":
        return reader.format("jdbc").option("dbtable", ref).load()
    return reader.format(fmt).load(ref)


def run_query(spark: SparkSession, sql: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """A parameterised query; values keep their Python type (named ``:markers``)."""
    return spark.sql(sql, args=dict(params or {}))


def table_schema(spark: SparkSession, ref: str, fmt: str = "table") -> StructType:
    """The live schema of a table, without reading rows."""
    return read_any(spark, ref, fmt).schema


def materialize(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Create-or-replace a table from a query, then read it back.

    The write replaces the whole output; never point ``path`` at an input of ``df``.
    """
    df.write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def load(df: DataFrame, path: str, disposition: str = "append", fmt: str = "parquet") -> int:
    """Bulk load (append by default, or truncate); returns rows written.

    The count is taken by an ``Observation`` during the write, so the data is
    scanned once. An empty input writes nothing and returns 0.
    """
    mode = {"append": "append", "WRITE_APPEND": "append", "truncate": "overwrite",
            "WRITE_TRUNCATE": "overwrite", "overwrite": "overwrite"}[disposition]
    if df.isEmpty():  # a LIMIT 1 probe, not a scan
        return 0
    obs = Observation("concord_load")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    observed.write.mode(mode).format(fmt).save(path)
    return int(obs.get.get("rows", 0) or 0)


def replicate(spark: SparkSession, source: str, target_path: str, fmt: str = "parquet") -> int:
    """Copy a catalog table to a target location (``INSERT INTO t SELECT * FROM s``)."""
    return load(spark.table(source), target_path, "append", fmt)


def execute_script(spark: SparkSession, script: str, **frames: DataFrame) -> DataFrame:
    """S3: run a multi-statement script in order, as one SQL script (``BEGIN … END``).

    Statements run one after another on the cluster; variables are
    ``DECLARE``d inside the script; ``{name}`` placeholders bind ``frames``.
    The result is the last statement's result set, which Spark returns through
    the driver: end a script with a report, or with a table write when the
    output is data-sized.
    """
    body = script.strip().rstrip(";").strip()
    return spark.sql(f"BEGIN\n{body};\nEND", **frames)


def reachable(spark: SparkSession, ref: str, fmt: str = "table") -> bool:
    """Q4: can the table be resolved and read? A ``LIMIT 1`` probe; any error means no."""
    try:
        read_any(spark, ref, fmt).limit(1).collect()
        return True
    except Exception:  # noqa: BLE001 - unreachable for any reason
        return False


def readable(spark: SparkSession, refs: Sequence[str], fmt: str = "table", at_once: int = AT_ONCE) -> DataFrame:
    """Q4 for many tables: ``(table_name, readable, error)``, each by a ``LIMIT 1`` probe, ``at_once`` probes at the same time."""
    refs = list(refs)
    found = run_all(spark, [lambda r=r: read_any(spark, r, fmt).limit(1).collect() for r in refs], at_once) if refs else []
    rows = [(r, not isinstance(x, Exception), reason(x) if isinstance(x, Exception) else None) for r, x in zip(refs, found)]
    return spark.createDataFrame(rows, "table_name string, readable boolean, error string")


def catalog_listing(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Q4 at scale: the tables a catalog namespace holds, ``(table_name)`` lower-cased.

    Join required tables against it instead of probing them one by one.
    """
    shown = spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")
    return shown.select(F.lower("tableName").alias("table_name")).distinct()


def where_equals(df: DataFrame, **conditions: Any) -> DataFrame:
    """Q6: AND of ``column = value`` for every condition whose value is not None."""
    preds = [F.col(c) == F.lit(v) for c, v in conditions.items() if v is not None]
    if not preds:
        return df
    cond = preds[0]
    for p in preds[1:]:
        cond = cond & p
    return df.where(cond)
