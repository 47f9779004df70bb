"""Token counts of flat token files without an index: a vectorised separator scan, stitched by a prefix scan."""

from __future__ import annotations

import re
import urllib.parse
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.llm.common import lean, spread, written
from concord.llm.tokens import byte_bpe, encoder
from concord.session import ensure_checkpoint_dir

#: Blocks whose summaries one task scans.
GROUP = 1024


def _opened(path: str):
    """File system and path of a file for Arrow; ``file:/x`` and ``file:///x`` are the same place."""
    from pyarrow import fs

    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", path)
    return fs.FileSystem.from_uri(urllib.parse.quote(path, safe=":/@"))


def token_files(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 50256, width: int = 2,
                ranks: str | None = None) -> DataFrame:
    """Write documents as flat token files below ``folder``; returns their ids: ``file`` (name), ``part``, ``document``, ``doc``.

    Each input partition becomes one file: the ids of its texts as little-endian integers of ``width`` bytes, each text
    ended by ``end_id``, which no text holds. The file has no index. The ids list which document is which of its file
    (``document``, from 0), without any position or length. Every attempt of a task writes a file of its own name, and only files of
    attempts that Spark committed are in the list, so a lost executor or a repeated task leaves at most an unlisted file.
    """
    ranks = ranks or byte_bpe()
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, part = encoder(ranks).ids, TaskContext.get().partitionId()
        name, out, done = f"part-{part:05d}-{uuid.uuid4().hex}", None, 0
        end = np.array([end_id], f"<u{width}").tobytes()
        try:
            for batch in batches:
                if out is None and batch.num_rows:
                    system, place = _opened(f"{folder}/{name}")
                    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    out = system.open_output_stream(place, compression=None, buffer_size=1 << 20)
                for text in batch.column(1):
                    out.write(np.asarray(encode(text.as_py())).astype(f"<u{width}").tobytes() + end)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array([part] * n, pa.int64()),
                                                  pa.array(range(done, done + n), pa.int64()), batch.column(0)], ["file", "part", "document", "doc"])
                done += n
        finally:
            if out is not None:
                out.close()

    ids = docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(lean(run), f"file string, part long, document long, doc {id_type}")
    return written(ids, "token-ids")


def read_flat(spark: SparkSession, path: str, width: int = 2, block_tokens: int = 1 << 18) -> DataFrame:
    """Blocks of the raw token files below ``path``, found by their sizes alone: ``file``, ``block``, ``at`` (byte), ``n_bytes``.

    Every file is cut into ranges of ``block_tokens`` tokens and a shorter last one, whatever its size; nothing is read yet.
    :func:`separators` opens a file at a range's start, so no task holds a file. A file whose size is no multiple of ``width``
    is an error; an empty one has no blocks. The file system must be one that Arrow opens too (local or shared folders,
    HDFS, S3, GCS).
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    odd = listed.where(F.col("length") % width != 0).limit(1).collect()
    if odd:
        raise ValueError(f"{odd[0][0]}: {odd[0][1]} bytes are no multiple of {width}")
    step = block_tokens * width
    ranges = listed.where("length > 0").select(F.col("path").alias("file"), "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("length") - 1) / step))).alias("block"))
    at = F.col("block") * step
    return spread(ranges.select("file", "block", at.alias("at"), F.least(F.lit(step), F.col("length") - at).alias("n_bytes")))


def separators(blocks: DataFrame, end_id: int = 50256, width: int = 2) -> DataFrame:
    """Per block: ``n_tokens`` and ``ends`` (places of the separators in the block), found by one vector comparison."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, block, at, size in zip(*(c.to_pylist() for c in batch.columns)):
                system, place = _opened(file)
                with system.open_input_file(place) as f:
                    data = f.read_at(size, at)
                if len(data) != size:
                    raise EOFError(f"{file}: {len(data)} of {size} bytes at {at}")
                tokens = np.frombuffer(data, f"<u{width}")
                yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block], pa.int64()), pa.array([len(tokens)], pa.int64()),
                                                  pa.array([np.flatnonzero(tokens == end_id)], pa.list_(pa.int64()))],
                                                 ["file", "block", "n_tokens", "ends"])

    return blocks.select("file", "block", "at", "n_bytes").mapInArrow(lean(run), "file string, block long, n_tokens long, ends array<long>")


def count_documents(blocks: DataFrame, end_id: int = 50256, width: int = 2) -> DataFrame:
    """Documents of flat token files: ``file``, ``document`` (from 0), ``start`` (token), ``n_tokens`` (without the
    separator) and ``ended``.

    Each block is searched on its own. A prefix scan over the blocks' sums, in two levels of ``GROUP`` blocks, gives
    each block its first token's place, its first document's number and the last separator before it, by which
    documents that cross blocks are stitched. Tokens after a file's last separator are a document with ``ended`` =
    false. Empty documents have 0 tokens; files and blocks without tokens give no rows.
    """
    found = written(separators(blocks, end_id, width).where("n_tokens > 0"), "separators")
    sums = found.select("file", "block", F.floor(F.col("block") / GROUP).alias("g"), "n_tokens", F.size("ends").cast("long").alias("n_ends"),
                        F.expr("try_element_at(ends, -1)").alias("last"))
    tops = sums.groupBy("file", "g").agg(F.sum("n_tokens").alias("gt"), F.sum("n_ends").alias("ge"))
    above = Window.partitionBy("file").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("file", "g", F.coalesce(F.sum("gt").over(above), F.lit(0)).alias("gt"),
                       F.coalesce(F.sum("ge").over(above), F.lit(0)).alias("ge"))
    before = Window.partitionBy("file", "g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.join(tops, ["file", "g"]).select(
        "file", "g", "block", "n_tokens", "last",
        (F.col("gt") + F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).alias("base"),
        (F.col("ge") + F.coalesce(F.sum("n_ends").over(before), F.lit(0))).alias("first_doc"))
    placed = placed.withColumn("last", F.col("base") + F.col("last"))
    # the last separator before a block: of its group, else of the groups before
    tails = placed.groupBy("file", "g").agg(F.max("last").alias("tail")).withColumn("tail", F.max("tail").over(above))
    placed = placed.join(tails, ["file", "g"]).withColumn(
        "since", F.coalesce(F.max("last").over(before), F.col("tail"), F.lit(-1)) + 1)
    stitched = found.join(placed.select("file", "block", "base", "first_doc", "since"), ["file", "block"])
    ends = stitched.select("*", F.posexplode("ends").alias("k", "end")).select(
        "file", (F.col("first_doc") + F.col("k")).alias("document"),
        F.when(F.col("k") == 0, F.col("since")).otherwise(F.col("base") + F.get("ends", F.col("k") - 1) + 1).alias("start"),
        (F.col("base") + F.col("end")).alias("stop"), F.lit(True).alias("ended"))
    open_ = placed.groupBy("file").agg(F.max(F.col("base") + F.col("n_tokens")).alias("stop"),
                                       F.coalesce(F.max("last") + 1, F.lit(0)).alias("start"))
    numbers = sums.groupBy("file").agg(F.sum("n_ends").alias("document"))
    open_ = open_.where("stop > start").join(numbers, "file").select("file", "document", "start", "stop", F.lit(False).alias("ended"))
    return ends.unionByName(open_).select("file", "document", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "ended")


def count_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token counts of whole texts by way of flat token files in the shared folder: the id, ``file`` (the number of the input
    partition), ``document``, ``start``, ``n_tokens``. The files are scanned as any others would be; ids are joined to the
    documents found by file and number. Null texts count as empty (0 tokens); null and repeated ids are rows of their own."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/llm/tokens-{uuid.uuid4().hex}"
    ids = token_files(docs, folder, id_col, text_col)
    if ids.isEmpty():
        return ids.select(F.col("doc").alias(id_col), F.col("part").alias("file"), "document", F.lit(0).cast("long").alias("start"),
                          F.lit(0).cast("long").alias("n_tokens"))
    name = F.regexp_extract("file", "[^/]+$", 0)
    blocks = read_flat(spark, folder).withColumn("_name", name).join(ids.select(F.col("file").alias("_name")).distinct(), "_name", "left_semi")
    found = count_documents(blocks).where("ended").withColumn("file", name)
    return ids.join(found, ["file", "document"]).select(F.col("doc").alias(id_col), F.col("part").alias("file"), "document", "start", "n_tokens")
