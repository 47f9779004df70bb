"""X1 over S11: the statements of script files of any size, a big file split by many tasks.

A file is read as the fragments between its semicolons, so Spark cuts it into byte ranges like any text. Whether a
semicolon separates statements hangs on the quotes before it: the state is two-valued (outside or inside quotes), a
fragment with an odd number of quotes toggles it, and toggles compose. So each chunk of fragments is summed up once for
either state at its start, a prefix scan over the chunks of a byte range and over the byte ranges of a file gives each
chunk its true state and its first statement's number, and only statements that hold quoted semicolons are put together
from several fragments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.functions.stored import stored
from concord.functions.text import strip_ws
from concord.operators.scripts import describe_units

CHUNK_BITS = 12  # 4096 fragments are scanned in one window
BROADCAST_CHUNKS = 200_000  # a path and five numbers each
PLACE = ["path", "block", "chunk"]


def fragments(spark: SparkSession, directory: str, suffix: str = ".sql") -> DataFrame:
    """``(path, file_name, size, block, chunk, row, part)``: what stands between the semicolons of the files directly in
    ``directory`` whose names end in ``suffix`` (in either case). ``block`` is the byte range's start, ``row`` ascends in it."""
    raw = spark.read.option("lineSep", ";").option("recursiveFileLookup", False).text(directory)
    meta = raw.select(F.col("value").alias("part"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"),
                      F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_block_start").alias("block"))
    rows = meta.where(F.lower("file_name").endswith(suffix.lower())).withColumn("row", F.monotonically_increasing_id())
    return rows.withColumn("chunk", F.shiftright("row", CHUNK_BITS))


def _before(c: str, w: Window) -> Column:
    return F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _scan(sums: DataFrame, within: list[str], by: str) -> DataFrame:
    """Prefix scan of ``(odd, n_even, n_odd)`` in the order of ``by`` for either state at the start of a group ``within``:
    ``flips`` (the state before, had the group begun outside) and the statements ended before, ``done_even`` and ``done_odd``."""
    w = Window.partitionBy(*within).orderBy(by)
    state = sums.withColumn("flips", _before("odd", w) % 2)
    state = state.withColumn("_e", F.when(F.col("flips") == 0, F.col("n_even")).otherwise(F.col("n_odd"))).withColumn(
        "_o", F.when(F.col("flips") == 0, F.col("n_odd")).otherwise(F.col("n_even")))
    return state.withColumn("done_even", _before("_e", w)).withColumn("done_odd", _before("_o", w))


def _total(scanned: DataFrame, keys: list[str]) -> DataFrame:
    """The sums of whole groups, again for either state at their start."""
    return scanned.groupBy(*keys).agg((F.sum("odd") % 2).alias("odd"), F.sum("_e").alias("n_even"), F.sum("_o").alias("n_odd"),
                                      F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.max("size").alias("size"))


def split_files(spark: SparkSession, directory: str, suffix: str = ".sql") -> DataFrame:
    """``(script_id, file_name, unit_id, statement)`` of all script files, as :func:`scripts.split_units` gives them for
    whole texts. A byte order mark at a file's start is dropped; empty files give no rows.

    Windows hold at most 4096 fragments, the chunks of one byte range, and the byte ranges of one file. A statement is one
    value, so one with an unterminated quote holds the rest of its file, as its definition says.
    """
    f = fragments(spark, directory, suffix)
    quotes = F.length("part") - F.length(F.replace("part", F.lit("'"), F.lit("")))
    in_chunk = Window.partitionBy(*PLACE).orderBy("row")
    local = f.select("*", (quotes % 2).cast("long").alias("odd"), (F.length(strip_ws(F.col("part"))) > 0).alias("filled"))
    local = local.withColumn("begun", _before("odd", in_chunk) % 2)
    # ends a statement that is kept, had the chunk begun outside (even) or inside quotes (odd)
    ends = (F.col("begun") + F.col("odd")) % 2
    local = local.withColumn("end_even", ((ends == 0) & ((F.col("begun") == 1) | F.col("filled"))).cast("long")).withColumn(
        "end_odd", ((ends == 1) & ((F.col("begun") == 0) | F.col("filled"))).cast("long"))
    local = stored(local.withColumn("kept_even", _before("end_even", in_chunk)).withColumn("kept_odd", _before("end_odd", in_chunk)), "fragments")

    chunks = local.groupBy(*PLACE).agg((F.sum("odd") % 2).alias("odd"), F.sum("end_even").alias("n_even"), F.sum("end_odd").alias("n_odd"),
                                       F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("part")).alias("bytes"), F.max("size").alias("size"))
    in_block = _scan(chunks, ["path", "block"], "chunk")
    blocks = _scan(_total(in_block, ["path", "block"]), ["path"], "block")
    whole = _total(blocks, ["path"])
    # the last semicolon leaves no fragment; it is text where a quote stays open
    left = F.col("size") - F.col("bytes") - F.col("n") + 1
    tails = whole.select("path", F.when((F.col("odd") == 1) & left.isin(1, 4), F.lit(";")).otherwise(F.lit("")).alias("tail"))
    outer = blocks.select("path", "block", F.col("flips").alias("outer_flips"), F.col("done_even").alias("outer_done")).join(tails, "path")
    inside = F.col("outer_flips") == 1
    placed = stored(in_block.join(outer, ["path", "block"]).select(
        *PLACE, "tail", ((F.col("outer_flips") + F.col("flips")) % 2).alias("state"),
        (F.col("outer_done") + F.when(inside, F.col("done_odd")).otherwise(F.col("done_even"))).alias("done")), "chunks")

    side = F.broadcast(placed) if placed.count() <= BROADCAST_CHUNKS else placed
    state = (F.col("state") + F.col("begun")) % 2
    parts = local.join(side, PLACE).select(
        "path", "file_name", "block", "row", "part", "filled", "tail", state.alias("from"), ((state + F.col("odd")) % 2).alias("to"),
        (F.col("done") + F.when(F.col("state") == 1, F.col("kept_odd")).otherwise(F.col("kept_even")) + 1).cast("int").alias("unit_id"))
    alone = (F.col("from") == 0) & (F.col("to") == 0)
    single = parts.where(alone & F.col("filled")).select("path", "file_name", "unit_id", F.col("part").alias("text"))
    several = parts.where(~alone).groupBy("path", "file_name", "unit_id").agg(
        F.array_sort(F.collect_list(F.struct("block", "row", "part"))).alias("p"), F.max("tail").alias("tail"), F.sum(
            F.when(F.col("from") != F.col("to"), 1).otherwise(0)).alias("turns")).select(
        "path", "file_name", "unit_id", F.concat(F.array_join(F.col("p.part"), ";"), F.when(F.col("turns") % 2 == 1, F.col("tail")).otherwise(F.lit(""))).alias("text"))
    return single.unionByName(several).select(
        F.substring("file_name", F.lit(1), F.length("file_name") - len(suffix)).alias("script_id"), "file_name", "unit_id", strip_ws(F.col("text")).alias("statement"))


def build_file_units(spark: SparkSession, directory: str, suffix: str = ".sql") -> DataFrame:
    """X1-X3 of script files: ``(script_id, file_name, unit_id, statement, statement_type, sources, targets)``."""
    return describe_units(split_files(spark, directory, suffix))
