"""Incremental fingerprints with Structured Streaming.

The reference reconciles batch tables only. When a source keeps growing by
new files, its group fingerprint (R5: per key count and exact sums) can be
kept up to date by a streaming aggregation instead of re-scanning the whole
table for every check: the per-key state lives in the state store and each
micro-batch folds in only the new files.

Output is in *update* mode: a micro-batch carries only the keys whose
aggregate changed, with their new totals. ``foreachBatch`` merges them into
the previous version (keys replaced by an anti-join, then a union) and writes a new
version in a folder of its own. A version is published by a one-line file of its
epoch that names the folder, written after the folder is complete; there is no
pointer shared by epochs that could be lost half written. Batch ``n`` is built on
the newest published version below ``n``: a retried or replayed batch starts from
the same predecessor and replaces only its own line, and a failing read raises
instead of passing for "no version yet". A reconciliation compares two
persisted fingerprints with ``fingerprint.compare_fingerprints``.

Checkpoints go under the session's ``spark.checkpoint.dir`` (a shared folder
on a cluster) unless a location is given, so a restarted query resumes.
Older versions can be removed by the caller's retention job.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from concord.functions.keys import split_keys
from concord.operators.fingerprint import group_fingerprint
from concord.session import ensure_checkpoint_dir

PUBLISHED = "published"


def stream_fingerprint(stream: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """R5 on a streaming DataFrame: a running ``(split keys…, keys…, n, _s<i>, _x<i>)`` aggregation."""
    return group_fingerprint(stream, list(keys), list(columns))


def latest_version(spark: SparkSession, output_path: str, below: int | None = None) -> tuple[int, str] | None:
    """``(epoch, folder)`` of the newest published version (below ``below``), or None if none is published.

    Only a path that does not exist means None; any other error is raised.
    """
    try:
        lines = (spark.read.option("recursiveFileLookup", "true").text(posixpath.join(output_path, PUBLISHED))
                 .select(F.split_part("value", F.lit(" "), F.lit(1)).cast("long").alias("epoch"), F.substring_index("value", " ", -1).alias("folder")))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = (lines if below is None else lines.where(F.col("epoch") < below)).agg(F.max(F.struct("epoch", "folder")).alias("v")).first().v
    return tuple(newest) if newest else None


def read_fingerprint(spark: SparkSession, output_path: str) -> DataFrame:
    """The newest published fingerprint version."""
    version = latest_version(spark, output_path)
    if version is None:
        raise FileNotFoundError(f"no fingerprint published under {output_path}")
    return spark.read.parquet(posixpath.join(output_path, version[1]))


def maintain_fingerprint(spark: SparkSession, source_dir: str, schema: StructType, keys: Sequence[str],
                         columns: Sequence[str], output_path: str, name: str,
                         checkpoint_location: str | None = None, available_now: bool = True,
                         file_format: str = "parquet", reader_options: dict[str, str] | None = None) -> StreamingQuery:
    """Keep the newest version under ``output_path`` equal to the group fingerprint of all files in ``source_dir``.

    Runs with ``availableNow`` (process what is there, then stop) by default;
    pass ``available_now=False`` for a continuously running query.
    """
    location = checkpoint_location or posixpath.join(ensure_checkpoint_dir(spark), "streams", name)
    stream = spark.readStream.schema(schema).options(**(reader_options or {})).format(file_format).load(source_dir)
    fp = stream_fingerprint(stream, keys, columns)
    _, key_names = split_keys(stream, list(keys))

    def publish(changed: DataFrame, epoch: int) -> None:
        session = changed.sparkSession
        before = latest_version(session, output_path, below=epoch)
        merged = changed
        if before is not None:
            old = session.read.parquet(posixpath.join(output_path, before[1]))
            merged = old.join(changed.select(*key_names).hint("merge"), key_names, "left_anti").unionByName(changed)
        folder = f"versions/{epoch}-{uuid.uuid4().hex}"
        merged.write.parquet(posixpath.join(output_path, folder))
        session.createDataFrame([(f"{epoch} {folder}",)], "value string").coalesce(1).write.mode("overwrite").text(
            posixpath.join(output_path, PUBLISHED, str(epoch)))

    writer = fp.writeStream.outputMode("update").foreachBatch(publish).option("checkpointLocation", location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.queryName(name).start()
