"""Contraction of chains by pointer doubling.

A *single* table has one source. Singles hang below their first ancestor that is not single (their *top*) in chains,
however long; each round of :func:`ascend` doubles the distance that a table's pointer spans, so a chain of n tables
takes log2(n) rounds instead of n.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions.stored import stored

BROADCAST_ROWS = 200_000  # a few short values each


def sized(df: DataFrame) -> DataFrame:
    """``df`` (a stored table) to be joined: broadcast when counted small, else by a merge join, which splits hot keys."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.hint("merge")


@dataclass
class Chains:
    """``tops`` (table_name, up: the top, dist: the distance to it); ``levels``: of each round the tables whose 2^k-th ancestor ``up`` is
    single; ``circular`` (table_name, low), None if there are none: the tables on rings of singles with the ring's smallest name."""

    tops: DataFrame
    levels: list[DataFrame]
    circular: DataFrame | None


def ascend(singles: DataFrame) -> Chains:
    """Tops of all ``singles`` (``table_name``, ``up``, ``dist``), one row a table. A table that is on or below a ring of singles has none."""
    names = singles.select(F.col("table_name").alias("up"), F.lit(False).alias("_top"))
    state = stored(singles.join(sized(names), "up", "left").select(
        "table_name", "up", "dist", F.col("table_name").alias("low"), F.coalesce("_top", F.lit(True)).alias("done")), "chain")
    total = state.count()
    done, active, levels, span = [state.where("done")], state.where("NOT done"), [], 1
    while True:
        n = active.count()
        if not n or span > total:
            break
        levels.append(active)
        known = active
        for d in done:
            known = known.unionByName(d)
        above = known.select(F.col("table_name").alias("up"), F.col("up").alias("_up"), F.col("dist").alias("_dist"),
                             F.col("low").alias("_low"), F.col("done").alias("_done"))
        above = F.broadcast(above) if total <= BROADCAST_ROWS else above.hint("merge")
        state = stored(active.join(above, "up").select(
            "table_name", F.col("_up").alias("up"), (F.col("dist") + F.col("_dist")).alias("dist"),
            F.least("low", "_low").alias("low"), F.col("_done").alias("done")), "chain")
        done.append(state.where("done"))
        active, span = state.where("NOT done"), 2 * span
    tops = done[0]
    for d in done[1:]:
        tops = tops.unionByName(d)
    # after as many steps as there are singles, every table of a ring is where some pointer ends
    circular = active.join(active.select(F.col("up").alias("table_name")).distinct().hint("merge"), "table_name", "left_semi").select(
        "table_name", "low") if n else None
    return Chains(tops.select("table_name", "up", "dist"), levels, circular)


def ancestors(chains: Chains, marked: DataFrame) -> DataFrame:
    """All singles above the ``marked`` ones (``table_name``, ``mark``), and these: each distance is a sum of spans, taken largest first."""
    for level in reversed(chains.levels):
        step = marked.join(level.select("table_name", "up").hint("merge"), "table_name").select(F.col("up").alias("table_name"), "mark")
        marked = stored(marked.unionByName(step).distinct(), "marked")
    return marked
