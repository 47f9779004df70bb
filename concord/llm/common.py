"""Helpers shared by the operators: written tables, sized joins, prefix scans and connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.session import ensure_checkpoint_dir

#: A table is broadcast only when it was counted and holds at most this many narrow rows.
BROADCAST_ROWS = 200_000

_SHIPPED: set[str] = set()


#: Bytes of an Arrow batch on its way to and from a Python worker, set where the session has Spark's default of 64 MB.
BATCH_BYTES = "4m"


def _release() -> None:
    """Give memory that Arrow and the C library keep for later back to the system: a worker stays for other steps."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        import ctypes

        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


def lean(run: Callable) -> Callable:
    """``run``, a function over Arrow batches, that releases unused memory every few batches and at the end."""
    def over_batches(batches: Iterator) -> Iterator:
        for n, out in enumerate(run(batches)):
            yield out
            if n % 8 == 7:
                _release()
        _release()

    return over_batches


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers (once per application), so that they need no install, and
    bound their Arrow batches."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="concord-ship-"), "concord_package.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(top)))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size) in ("67108864", "67108864b", "64m", "64MB"):
        spark.conf.set(size, BATCH_BYTES)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The ``documents`` table of a data folder, pruned to ``columns``."""
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """``df`` written once as Parquet below ``spark.checkpoint.dir`` and read back.

    The table cuts the lineage: a lost executor costs a re-read, not the work before it, and the rows stay the
    same for every later reader. Unlike ``checkpoint()`` it computes the plan once.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt over the session's shuffle partitions, for a narrow table whose next step is heavy."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys) if keys else df.repartition(n)


def lookup(big: DataFrame, table: DataFrame, key: str, how: str = "inner", floor: int = 20_000, share: int = 200) -> DataFrame:
    """Join ``big`` to ``table`` (unique in ``key``, with ``n_rows`` = rows of ``big`` per key) without a hot task.

    Keys with more than ``max(floor, rows / share)`` rows are at most ``share`` by counting: their lines of
    ``table`` are broadcast, and the rest is joined by a shuffle. Both frames should be written tables.
    """
    total = table.agg(F.sum("n_rows")).first()[0] or 0
    limit = max(floor, total // share)
    hot = [r[0] for r in table.where(F.col("n_rows") > limit).select(key).limit(share + 1).collect()]
    slim = table.drop("n_rows")
    if not hot:
        return big.join(slim, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return big.where(is_hot).join(F.broadcast(slim.where(is_hot)), key, how).unionByName(
        big.where(~is_hot).join(slim.where(~is_hot), key, how))


def text_key(text: Column) -> Column:
    """128 bits of a text as hex; a null text counts as empty."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return F.concat(F.hex(F.xxhash64(t)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), t)))


def boxed(docs: DataFrame) -> DataFrame:
    """All columns in one struct ``_doc``, so that columns added beside it cannot clash with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))


def keep_ids(docs: DataFrame, ids: DataFrame, key: str, rows: int, how: str) -> DataFrame:
    """Semi or anti join of wide rows with a counted id table: broadcast up to ``BROADCAST_ROWS``, else shuffled."""
    return docs.join(F.broadcast(ids) if rows <= BROADCAST_ROWS else ids, key, how)


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """Connected components of undirected ``edges`` (a long, b long): ``node``, ``component`` (smallest node).

    Alternating large-star and small-star rounds on a written edge table. Only nodes with an edge appear. Each
    round joins the edges to one minimum per node; hubs are looked up by :func:`lookup`.
    """
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not mark[0] or tuple(mark) == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = tuple(mark)
        # large star: every larger neighbour of b moves to the smallest node around b
        up = e.select(F.col("a").alias("b"), F.col("b").alias("m"), F.lit(0).alias("n_rows")).unionByName(
            e.select("b", F.col("b").alias("m"), F.lit(1).alias("n_rows")))
        low = written(up.groupBy("b").agg(F.min("m").alias("m"), F.sum("n_rows").alias("n_rows")).where("n_rows > 0"), "low")
        e = written(lookup(e, low, "b").select("a", F.col("m").alias("b")).distinct(), "large")
        # small star: a and its smaller neighbours move to the smallest of them
        low = written(e.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n_rows")), "low")
        e = written(lookup(e, low, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct(), "small")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def chunks(n: int, size: int) -> Iterable[tuple[int, int]]:
    """Bounds of consecutive slices of ``n`` rows."""
    return ((i, min(n, i + size)) for i in range(0, n, size))
