"""Tables written once below the session's checkpoint folder and read back."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from concord.session import ensure_checkpoint_dir


def stored_path(spark: SparkSession, label: str) -> str:
    """A new path below the session's checkpoint folder."""
    return posixpath.join(ensure_checkpoint_dir(spark), "concord", f"{label}-{uuid.uuid4().hex}")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, re-read (not recomputed) after an executor loss."""
    spark = df.sparkSession
    path = stored_path(spark, label)
    df.write.parquet(path)
    schema = StructType([StructField(f.name, f.dataType) for f in df.schema.fields])
    return spark.read.schema(schema).parquet(path)


#: Rows of a large table that a shuffle partition holds at most, about.
PARTITION_ROWS = 500_000


def roomy(spark: SparkSession, rows: int) -> SparkSession:
    """``spark``, or for more rows than its shuffle partitions should hold a session with its settings in which shuffles start from more
    partitions, to be coalesced by their measured sizes: a task's share stays the same however many rows there are.

    The caller's settings stay as they are. A join runs in its left side's session.
    """
    wanted = -(-rows // PARTITION_ROWS)
    if wanted <= int(spark.conf.get("spark.sql.shuffle.partitions")):
        return spark
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", wanted)
    return own


def roomier(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in the session that :func:`roomy` gives for ``rows``: the right side of a union whose left side, in that session, is empty."""
    own = roomy(df.sparkSession, rows)
    if own is df.sparkSession:
        return df
    return own.range(0).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]).unionByName(df)
