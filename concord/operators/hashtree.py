"""A hash tree over key ranges, kept on disk, with leaves per file (R5, R10): only what changed is read again.

A table of Parquet files is summed once into *leaves*: per file and range of the key the number of rows and two
sums of 64-bit row hashes. Sums add up, so leaves give the sums of a range over all files, and ranges those of the
ranges that hold them: a tree whose nodes each cover ``FAN`` ranges below.

* **Refreshing** lists the files (names, sizes, times; no contents). Leaves of files that did not change are taken over;
  only new and changed files are read.
* **Comparing** two trees starts at the top and goes down where the sums differ, reading of each level's table only what lies
  below differing nodes. Equal tables are told from two rows.
* **Differences**: rows are read only from files that have rows in differing ranges, with the ranges' bounds pushed to the
  scan where the key is a number, and compared by the flat operators of ``rowdiff``.

The depth follows the data: the leaves' width from the number of rows and the span of the key; ranges with many more rows than
a leaf should have are kept ``2 ** SPLIT`` times finer.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from concord.functions.canonical import common_kind, hashable, with_row_hash
from concord.operators.chains import BROADCAST_ROWS
from concord.operators.rowdiff import direct_key_diff, row_multiset_diff

#: Bits by which a level is coarser than the one below, and by which a dense range is split.
FAN_BITS, SPLIT = 4, 8
#: Intervals of the key that are pushed to a scan; beyond them, the least and the greatest bound.
INTERVALS = 64
SUMS = ("n", "c1", "c2")
EVERY = -1  # the depth of a range that is not split


@dataclass(frozen=True)
class HashTree:
    """One version of a table's tree. ``kinds``: the form in which each column is hashed; ``shift``: a leaf covers 2 ** shift places of the
    key; ``files_read``, ``rows_read``: what this version read of the table."""

    table: str
    folder: str
    key: str
    kinds: Mapping[str, str]
    shift: int
    levels: int
    files_read: int
    rows_read: int
    spark: SparkSession

    @property
    def leaves(self) -> DataFrame:
        """``file``, ``size``, ``changed``, ``range`` (null: rows without a key), ``part`` (of a split range, else -1), ``n``, ``c1``, ``c2``."""
        return self.spark.read.parquet(posixpath.join(self.folder, "leaves"))

    @property
    def nodes(self) -> DataFrame:
        """``level`` (1 and up), ``node``, and the sums of all leaves below; the top level has one node for each sign and the null key."""
        return self.spark.read.parquet(posixpath.join(self.folder, "nodes"))


def _place(key: str, dtype: DataType, kind: str) -> Column:
    """A long by which keys of one kind are ordered: their value or seconds, else a hash; null for a null key."""
    if kind == "integer":
        return F.col(key).cast("long")
    if kind == "time":
        return F.unix_timestamp(F.col(key).cast("timestamp_ntz").cast("timestamp"))
    return F.when(F.col(key).isNotNull(), F.xxhash64(*hashable(F.col(key), dtype, kind)))


def files_of(spark: SparkSession, table: str) -> DataFrame:
    """``file``, ``size``, ``changed`` of every Parquet file below a folder; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(table)
            .select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed")))


def _read(spark: SparkSession, table: str, schema: StructType, files: Sequence[str] | None) -> DataFrame:
    reader = spark.read.schema(schema).option("basePath", table)
    return reader.parquet(table) if files is None else reader.parquet(*files)


def _hashed(df: DataFrame, key: str, kinds: Mapping[str, str]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    return with_row_hash(df, sorted(kinds), kinds).withColumn("_place", _place(key, types[key], kinds[key]))


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(F.col(f"_h{i}").cast("decimal(20,0)")).cast("decimal(38,0)").alias(f"c{i}") for i in (1, 2)]]


def _added(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.sum("n").alias("n"), *[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("c1", "c2")])


def _count_in(df: DataFrame) -> tuple[int, int | None, int | None]:
    return df.agg(F.count(F.lit(1)), F.min("_place"), F.max("_place")).first()


def build(spark: SparkSession, table: str, folder: str, key: str, columns: Sequence[str] | None = None,
          other: Mapping[str, DataType] | None = None, like: HashTree | None = None, leaf_rows: int = 1 << 14) -> HashTree:
    """The first version of the tree of the Parquet files below ``table``, stored below ``folder``.

    ``columns`` (default: all) are hashed, with the key, in the common kind of their type and of the same column's type in
    ``other`` (the schema of the table to compare with, where it is typed otherwise). ``like``: a tree to be compared with,
    whose columns, kinds and width are taken; else the width is chosen for about ``leaf_rows`` rows a leaf.
    """
    schema = spark.read.parquet(table).schema
    types = {f.name: f.dataType for f in schema.fields}
    if like is not None:
        names = {c.lower(): c for c in types}
        kinds = {names[c.lower()]: k for c, k in like.kinds.items()}
        key = names[like.key.lower()]
    else:
        there = {c.lower(): t for c, t in (other or types).items()}
        kinds = {c: common_kind(types[c], there[c.lower()]) for c in types if c == key or columns is None or c in columns}
    own = {c: common_kind(types[c], types[c]) for c in kinds}
    wrong = [c for c, k in kinds.items() if k is None or own[c] != k and not (k == "number" and own[c] in ("integer", "double"))]
    if wrong:
        raise ValueError(f"no common type: {wrong}")
    if like is not None:
        shift, levels = like.shift, like.levels
    else:
        n, low, high = _count_in(_read(spark, table, schema, None).select(_place(key, types[key], kinds[key]).alias("_place")))
        span = max(1, (high or 0) - (low or 0) + 1)
        shift = min(62, (span * leaf_rows // max(n, 1) + 1).bit_length() - 1)
        bits = max(abs(low or 0), abs(high or 0)).bit_length() - shift
        levels = min(15, max(1, -(-bits // FAN_BITS)))
    tree = HashTree(table, posixpath.join(folder, uuid.uuid4().hex), key, kinds, shift, levels, 0, 0, spark)
    return _written(tree, schema, None, leaf_rows)


def refresh(tree: HashTree, leaf_rows: int = 1 << 14) -> HashTree:
    """A new version of the tree. Leaves of files whose size and time did not change are taken over without reading the files."""
    schema = tree.spark.read.parquet(tree.table).schema
    return _written(tree, schema, tree.leaves, leaf_rows)


def _written(tree: HashTree, schema: StructType, old: DataFrame | None, leaf_rows: int) -> HashTree:
    spark, folder = tree.spark, posixpath.join(posixpath.dirname(tree.folder), uuid.uuid4().hex)
    listed, stamp = files_of(spark, tree.table), ["file", "size", "changed"]
    if old is not None:
        known = old.select(*stamp).distinct()
        listed_path = posixpath.join(folder, "files")
        listed.write.parquet(listed_path)
        listed = spark.read.parquet(listed_path)
        # names come to the driver, which lists a table's files for every scan
        fresh = [r[0] for r in listed.join(known, stamp, "left_anti").select("file").collect()]
        kept = old.join(listed, stamp, "left_semi")
    else:
        fresh, kept = None, None
    parts = []
    if fresh is None or fresh:
        rows = _hashed(_read(spark, tree.table, schema, fresh).select(
            *[F.col(c) for c in schema.fieldNames()], F.col("_metadata.file_path").alias("_file")), tree.key, tree.kinds)
        name = F.url_decode(F.replace(F.col("_file"), F.lit("+"), F.lit("%2B")))
        fine = max(0, tree.shift - SPLIT)
        cut = (rows.withColumn("range", F.shiftright("_place", tree.shift))
               .withColumn("part", F.coalesce(F.shiftright("_place", fine).bitwiseAND((1 << (tree.shift - fine)) - 1).cast("int"), F.lit(EVERY)))
               .groupBy("_file", "range", "part").agg(*_sums()))
        cut_path = posixpath.join(folder, "cut")
        cut.withColumn("file", name).drop("_file").write.parquet(cut_path)
        cut = spark.read.parquet(cut_path)
        # ranges with rows for eight leaves and more, over these files, stay split
        dense = cut.groupBy("range").agg(F.sum("n").alias("_rows")).where(F.col("_rows") >= 8 * leaf_rows).select("range", F.lit(True).alias("_dense"))
        new = cut.join(dense, "range", "left").withColumn("part", F.when(F.col("_dense") & F.col("range").isNotNull(), F.col("part")).otherwise(EVERY))
        parts.append(_added(new, "file", "range", "part").join(listed, "file", "left").select(*stamp, "range", "part", *SUMS))
    if kept is not None:
        parts.append(kept.select(*stamp, "range", "part", *SUMS))
    leaves = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    path = posixpath.join(folder, "leaves")
    leaves.repartitionByRange("range", "part").sortWithinPartitions("range", "part").write.parquet(path)
    leaves = spark.read.parquet(path)
    at = F.explode(F.sequence(F.lit(1), F.lit(tree.levels)))
    base = _added(leaves, "range").withColumn("level", at)
    nodes = _added(base.withColumn("node", F.expr(f"shiftright(range, {FAN_BITS} * level)")), "level", "node")
    nodes.repartitionByRange("level", "node").sortWithinPartitions("level", "node").write.parquet(posixpath.join(folder, "nodes"))
    if fresh is None:
        n_files, n_rows = leaves.agg(F.count_distinct("file"), F.sum("n")).first()
    elif fresh:
        n_files, n_rows = len(fresh), spark.read.parquet(cut_path).agg(F.sum("n")).first()[0]
    else:
        n_files = n_rows = 0
    return replace(tree, folder=folder, files_read=n_files or 0, rows_read=n_rows or 0)


def _unlike(a: DataFrame, b: DataFrame, *by: str) -> DataFrame:
    """The values of ``by`` whose sums differ between two frames or that one lacks."""
    x, y = _added(a, *by).alias("a"), _added(b, *by).alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by]
    on = same[0]
    for s in same[1:]:
        on = on & s
    differ = " OR ".join(f"NOT (a.{c} <=> b.{c})" for c in SUMS)
    return x.join(y, on, "full_outer").where(differ).select(*[F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in by])


def _below(df: DataFrame, column: str, parent: Column, bad: DataFrame, n: int) -> DataFrame:
    bad = F.broadcast(bad) if n <= BROADCAST_ROWS else bad
    return df.join(bad.withColumnRenamed(column, "_up"), parent.eqNullSafe(F.col("_up")), "left_semi")


def differing_ranges(source: HashTree, target: HashTree) -> tuple[DataFrame, int]:
    """``range`` and ``part`` (null: all parts) in which the two tables differ, and their number.

    Level after level from the top, only below nodes that differ; the tables of the levels are sorted by node, so a scan skips the rest.
    """
    alike = (source.shift, source.levels, sorted(k for k in source.kinds.values()))
    if alike != (target.shift, target.levels, sorted(k for k in target.kinds.values())):
        raise ValueError("trees of unlike shape: build one with like= the other")
    spark, folder = source.spark, posixpath.join(source.folder, f"compared-{uuid.uuid4().hex}")

    def kept(df: DataFrame, level: int) -> tuple[DataFrame, int]:
        df.write.parquet(f"{folder}/{level}")
        out = spark.read.schema(df.schema).parquet(f"{folder}/{level}")
        return out, out.count()

    bad, n = None, 0
    for level in range(source.levels, 0, -1):
        sides = [t.nodes.where(F.col("level") == level) for t in (source, target)]
        if bad is not None:
            sides = [_below(s, "node", F.shiftright("node", FAN_BITS), bad, n) for s in sides]
        bad, n = kept(_unlike(*sides, "node"), level)
        if not n:
            return bad.select(F.col("node").alias("range"), F.lit(None).cast("int").alias("part")), 0
    sides = [_below(t.leaves, "node", F.shiftright("range", FAN_BITS), bad, n) for t in (source, target)]
    ranges, n = kept(_unlike(*sides, "range"), 0)
    # parts tell more where both sides have split the range
    inner = [s.join(F.broadcast(ranges) if n <= BROADCAST_ROWS else ranges, "range", "left_semi") for s in sides]
    whole = inner[0].where(F.col("part") == EVERY).select("range").unionByName(inner[1].where(F.col("part") == EVERY).select("range")).distinct()
    split = [s.join(whole, "range", "left_anti") for s in inner]
    parts = _unlike(*split, "range", "part")
    return kept(ranges.join(parts, "range", "left").select("range", "part"), -1)


def narrowed(tree: HashTree, bad: DataFrame, n: int) -> tuple[DataFrame, int]:
    """The table's rows in the ranges ``bad``, read from the files that have such rows; the number of those files."""
    spark = tree.spark
    schema = spark.read.parquet(tree.table).schema
    small = F.broadcast(bad) if n <= BROADCAST_ROWS else bad
    hit = (F.col("b.range").eqNullSafe(F.col("l.range"))) & (F.col("b.part").isNull() | (F.col("l.part") == EVERY) | (F.col("b.part") == F.col("l.part")))
    files = [r[0] for r in tree.leaves.alias("l").join(small.alias("b"), hit, "left_semi").select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], schema), 0
    df = _read(spark, tree.table, schema, files)
    kind, dtype = tree.kinds[tree.key], schema[tree.key].dataType
    if kind == "integer":
        bounds = bad.agg(F.min("range"), F.max("range"), F.bool_or(F.col("range").isNull())).first()
        spans = ([r[0] for r in bad.where("range IS NOT NULL").select("range").distinct().orderBy("range").collect()]
                 if n <= INTERVALS else [bounds[0], bounds[1]])
        test = F.col(tree.key).isNull() if bounds[2] else F.lit(False)
        pairs = [(r, r) for r in spans] if n <= INTERVALS else [tuple(spans)]
        for a, b in pairs:
            if a is not None:
                test = test | F.col(tree.key).between(a << tree.shift, min(((b + 1) << tree.shift) - 1, (1 << 63) - 1))
        df = df.where(test)
    fine = max(0, tree.shift - SPLIT)
    place = _place(tree.key, dtype, kind)
    rows = df.withColumn("_range", F.shiftright(place, tree.shift)).withColumn(
        "_part", F.shiftright(place, fine).bitwiseAND((1 << (tree.shift - fine)) - 1).cast("int"))
    inside = F.col("_range").eqNullSafe(F.col("b.range")) & (F.col("b.part").isNull() | F.col("b.part").eqNullSafe(F.col("_part")))
    return rows.join(small.alias("b"), inside, "left_semi").select(*schema.fieldNames()), len(files)


def row_diff(source: HashTree, target: HashTree) -> DataFrame:
    """Rows whose multiplicity differs, as ``rowdiff.row_multiset_diff`` gives them, over the trees' columns."""
    bad, n = differing_ranges(source, target)
    s, t = narrowed(source, bad, n)[0], narrowed(target, bad, n)[0]
    return row_multiset_diff(s, t, list(source.kinds))


def key_diff(source: HashTree, target: HashTree, columns: Sequence[str] | None = None) -> DataFrame:
    """Differences per key, as ``rowdiff.direct_key_diff`` gives them."""
    bad, n = differing_ranges(source, target)
    return direct_key_diff(narrowed(source, bad, n)[0], narrowed(target, bad, n)[0], source.key, columns)
