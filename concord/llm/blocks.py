"""Comparing all members of a group with each other, block against block, in tasks of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.common import BROADCAST_ROWS, written


def block_tasks(members: DataFrame, group: str, key: str, size: int) -> DataFrame:
    """``members`` (a written table) with columns ``own`` (block of the row), ``i`` <= ``j`` (blocks of the task).

    A group of up to ``size`` rows is one task (0, 0). A larger one is cut into blocks by the hash of ``key``; each
    row is sent to one task for every block of its group, so that any two rows meet in exactly one task (``i``, ``j``)
    of their blocks, besides which rows of a block meet in (``i``, ``i``).
    """
    sizes = written(members.groupBy(group).agg(F.ceil(F.count("*") / size).cast("int").alias("_blocks"))
                    .where("_blocks > 1"), "sizes")
    n = sizes.count()
    if n:
        members = members.join(F.broadcast(sizes) if n <= BROADCAST_ROWS else sizes, group, "left")
    else:
        members = members.withColumn("_blocks", F.lit(None).cast("int"))
    blocks = F.coalesce("_blocks", F.lit(1))
    own = F.pmod(F.xxhash64(key), blocks).cast("int")
    return (members.withColumn("own", own).withColumn("_with", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("i", F.least("own", "_with")).withColumn("j", F.greatest("own", "_with")).drop("_blocks", "_with"))
