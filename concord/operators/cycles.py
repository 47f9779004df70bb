"""Strongly connected components of a lineage graph: which tables feed each other.

Only tables that the stages left open get here, each with a source that is open too. Chains are contracted first
(:mod:`concord.operators.chains`), so the rounds below depend on the tables with several open sources. Of those

1. tables without an edge in or out are trimmed, again and again;
2. every table takes the smallest name that reaches it as its colour; the table of that name is the colour's root;
3. tables of a colour that reach its root are its component. They leave, and the rest starts again.

A chain is on a cycle if its two ends are of one component; rings of chains alone are found by the contraction itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions.stored import stored
from concord.operators.chains import ancestors, ascend, sized

#: Rounds of trimming before the colours; what is left untrimmed costs time, not results.
TRIMS = 8


def _semi(edges: DataFrame, column: str, names: DataFrame) -> DataFrame:
    return edges.join(names.select(F.col("table_name").alias(column)).hint("merge"), column, "left_semi")


def _trimmed(edges: DataFrame) -> tuple[DataFrame, int]:
    """``edges`` (source, table_name) less those of tables without an edge in or without one out; their number."""
    n = edges.count()
    for _ in range(TRIMS):
        if not n:
            break
        fed, feeding = edges.select("table_name").distinct(), edges.select(F.col("source").alias("table_name")).distinct()
        less = stored(_semi(_semi(edges, "source", fed), "table_name", feeding), "trimmed")
        left = less.count()
        if left == n:
            break
        edges, n = less, left
    return edges, n


def _reaching_names(edges: DataFrame) -> DataFrame:
    """``table_name``, ``colour``: the smallest name that reaches the table, itself included."""
    ends = edges.select("table_name").unionByName(edges.select(F.col("source").alias("table_name"))).distinct()
    colour = stored(ends.withColumn("colour", F.col("table_name")), "colour")
    fresh = colour
    while fresh.limit(1).count():
        # only colours that changed are passed on
        passed = edges.join(sized(fresh.select(F.col("table_name").alias("source"), "colour")), "source").groupBy("table_name").agg(
            F.min("colour").alias("_new"))
        both = stored(colour.join(passed.hint("merge"), "table_name", "left").select(
            "table_name", F.least("colour", "_new").alias("colour"), F.coalesce(F.col("_new") < F.col("colour"), F.lit(False)).alias("_less")), "colour")
        colour, fresh = both.drop("_less"), both.where("_less").drop("_less")
    return colour


def _components(edges: DataFrame) -> DataFrame | None:
    """``table_name``, ``component`` of the tables in components of two and more; None without any."""
    found = None
    edges, n = _trimmed(edges)
    while n:
        colour = _reaching_names(edges)
        own = stored(edges.join(colour.hint("merge"), "table_name").join(
            colour.select(F.col("table_name").alias("source"), F.col("colour").alias("_c")).hint("merge"), "source")
            .where("colour = _c").select("source", "table_name", "colour"), "inner")
        # backwards from each root along edges of its colour
        reached = stored(colour.where("table_name = colour"), "reached")
        fresh = reached
        while fresh.limit(1).count():
            back = own.join(sized(fresh.select("table_name")), "table_name").select(F.col("source").alias("table_name"), "colour").distinct()
            fresh = stored(back.join(reached.select("table_name").hint("merge"), "table_name", "left_anti"), "fresh")
            reached = stored(reached.unionByName(fresh), "reached")
        many = reached.groupBy("colour").agg(F.count("*").alias("n")).where("n > 1").select("colour")
        more = stored(reached.join(many.hint("merge"), "colour", "left_semi").select("table_name", F.col("colour").alias("component")), "component")
        found = more if found is None else found.unionByName(more)
        gone = reached.select("table_name")
        rest = edges.join(gone.hint("merge"), "table_name", "left_anti").join(
            gone.select(F.col("table_name").alias("source")).hint("merge"), "source", "left_anti")
        edges, n = _trimmed(stored(rest, "rest"))
    return found


def strong_components(edges: DataFrame) -> DataFrame:
    """``table_name``, ``cycle`` (the smallest name of its component) of all tables on cycles.

    ``edges`` (``source``, ``table_name``): distinct, without self-loops, every source also a table with a source.
    """
    spark = edges.sparkSession
    fed = edges.groupBy("table_name").agg(F.count("*").alias("n"), F.min("source").alias("up"))
    fed = stored(fed, "fed")
    chains = ascend(fed.where("n = 1").select("table_name", "up", F.lit(1).cast("long").alias("dist")))
    out = [] if chains.circular is None else [chains.circular.select("table_name", F.col("low").alias("cycle"))]
    # edges into tables with several sources, from the top of the chain that feeds them; a ring of singles has no way back in
    joint = edges.join(fed.where("n > 1").select("table_name").hint("merge"), "table_name", "left_semi")
    singles = fed.where("n = 1").select(F.col("table_name").alias("source"), F.lit(True).alias("_single"))
    tops = chains.tops.select(F.col("table_name").alias("source"), F.col("up").alias("top"))
    bent = stored(joint.join(singles.hint("merge"), "source", "left").join(tops.hint("merge"), "source", "left")
                  .where("_single IS NULL OR top IS NOT NULL").select(
                      "table_name", F.when(F.col("_single"), F.col("source")).alias("last"), F.coalesce("top", "source").alias("source")), "bent")
    inner = _components(stored(bent.where("source <> table_name").select("source", "table_name").distinct(), "contracted"))
    if inner is None:
        inner = spark.createDataFrame([], "table_name string, component string")
    # both ends in one component, or a chain from a table back to itself
    name = lambda c: inner.select(F.col("table_name").alias(c), F.col("component").alias(f"_{c}")).hint("merge")
    closed = stored(bent.join(name("table_name"), "table_name", "left").join(name("source"), "source", "left").select(
        "table_name", "last", F.coalesce("_table_name", "table_name").alias("mark"), F.coalesce("_source", "source").alias("_s"))
        .where("mark = _s").drop("_s"), "closed")
    members = closed.select("table_name", "mark").distinct()
    onto = closed.where("last IS NOT NULL").select(F.col("last").alias("table_name"), "mark").distinct()
    members = stored(members.unionByName(ancestors(chains, stored(onto, "onto"))).distinct(), "members")
    least = members.groupBy("mark").agg(F.min("table_name").alias("cycle"))
    out.append(members.join(least.hint("merge"), "mark").select("table_name", "cycle"))
    return out[0].unionByName(out[1]) if len(out) > 1 else out[0]
