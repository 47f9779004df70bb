"""Table lineage over a units frame.

A *unit* is one statement: ``(unit_id string, unit_order long, sources
array<string>, targets array<string>)``. Every function here is a DataFrame
transformation of that frame, so graphs with millions of units stay on the
cluster.

Stages (L2): a table never produced by a unit is stage 0; a produced table is
``1 + max(stage of the sources feeding its producers)``, 1 when it has no
source; a table feeding itself does not count. Tables that feed each other (a cycle) share a
stage: one more than the greatest of the sources outside the cycle. Tables behind a
cycle follow as usual. See ``compute_stages`` for how stages are found and what that costs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions.stored import roomy, stored, stored_path
from concord.operators.chains import BROADCAST_ROWS, ascend, sized
from concord.operators.cycles import strong_components
from concord.session import ensure_checkpoint_dir

UNITS_SCHEMA = "unit_id string, unit_order long, sources array<string>, targets array<string>"


def build_edges(units: DataFrame) -> DataFrame:
    """L1: distinct ``(source, target, unit_id, unit_order)`` edges."""
    return (units.select("unit_id", "unit_order", F.explode("targets").alias("target"), "sources")
            .select(F.explode("sources").alias("source"), "target", "unit_id", "unit_order")
            .dropDuplicates(["source", "target", "unit_id"]))


def all_tables(units: DataFrame) -> DataFrame:
    """Every table named as a source or a target."""
    s = units.select(F.explode("sources").alias("table_name"))
    t = units.select(F.explode("targets").alias("table_name"))
    return s.union(t).distinct()


def produced_tables(units: DataFrame) -> DataFrame:
    return units.select(F.explode("targets").alias("table_name")).distinct()


def external_roots(units: DataFrame) -> DataFrame:
    """Sources that no unit produces."""
    src = units.select(F.explode("sources").alias("table_name")).distinct()
    return src.join(produced_tables(units).hint("merge"), "table_name", "left_anti")  # data-sized


def unmapped_sources(units: DataFrame, mapping: DataFrame, key: str = "source_table") -> DataFrame:
    """External roots without a correspondence in ``mapping``; empty means all mapped."""
    return external_roots(units).join(mapping.select(F.col(key).alias("table_name")), "table_name", "left_anti")


def _kept_partitioned(df: DataFrame, *keys: str) -> DataFrame:
    """A reliable checkpoint of ``df`` hash-partitioned by ``keys`` that joins on them need not shuffle again.

    A checkpoint taken under adaptive execution forgets its partitioning, so it is taken without, in a session of its own:
    the caller's settings stay as they are for every other query. Join it from the right: a join runs in its left side's session.
    """
    own = df.sparkSession.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    path, n = stored_path(own, "kept"), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.write.parquet(path)
    return own.read.schema(df.schema).parquet(path).repartition(n, *keys).checkpoint()


def _frontier_rounds(edges: DataFrame, start: DataFrame, hot_share: int, salts: int) -> DataFrame:
    """``table_name``, ``stage`` of all that resolves from ``start`` (the same columns) over ``edges`` (source, table_name, w), distinct.

    ``needs`` counts each table's sources; a round counts the edges that leave the tables resolved in the round before (the frontier)
    per target, adds them to what the target had before, and the targets that reach their count are the next frontier. A round
    scans the edge table, which stays partitioned by (source, salt), and ``needs``, which stays partitioned by table, both
    without an exchange; it shuffles its hits and the partly resolved tables (``waiting``). A frontier or ``waiting`` counted under
    ``BROADCAST_ROWS`` is broadcast, a larger one merge-joined. Resolved rows are appended to one table.
    """
    # Skew: sources with more than 1/hot_share of all edges (at most hot_share of them: a proven bound, broadcast) spread their
    # edges over `salts` sub-keys; their frontier rows are replicated once per sub-key.
    degree = stored(edges.groupBy("source").agg(F.count(F.lit(1)).alias("d")), "degree")
    total = degree.agg(F.sum("d")).first()[0] or 0
    hot = F.broadcast(degree.where(F.col("d") > F.lit(max(total // hot_share, 1))).select("source")
                      .withColumn("_hot", F.lit(True)))
    needs = _kept_partitioned(edges.groupBy("table_name").agg(F.count("source").alias("needs")), "table_name")
    edges = _kept_partitioned(
        edges.join(hot, "source", "left")
        .withColumn("salt", F.when(F.col("_hot"), F.pmod(F.xxhash64("table_name"), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
        .drop("_hot"), "source", "salt")

    def salted(front: DataFrame) -> DataFrame:
        f = front.select(F.col("table_name").alias("source"), "stage").join(hot, "source", "left")
        fan = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        return f.select("source", "stage", F.explode(fan).alias("salt"))

    path = stored_path(start.sparkSession, "stages")
    frontier = start.select("table_name", F.col("stage").cast("long").alias("stage"))
    frontier.write.mode("append").parquet(path)
    waiting = None
    while True:
        n = frontier.count()
        if not n:
            break
        front = salted(frontier).hint("broadcast" if n <= BROADCAST_ROWS else "merge")
        hits = (front.join(edges, ["source", "salt"]).groupBy("table_name")
                .agg(F.count(F.lit(1)).alias("hit"), F.max(F.col("stage") + F.col("w")).alias("stage")))
        if waiting is not None:
            hits = hits.unionByName(waiting).groupBy("table_name").agg(F.sum("hit").alias("hit"), F.max("stage").alias("stage"))
        state = stored(sized(stored(hits, "hits")).join(needs, "table_name"), "reached")
        frontier = state.where("hit = needs").select("table_name", "stage")
        waiting = state.where("hit < needs").select("table_name", "hit", "stage")
        frontier.write.mode("append").parquet(path)
    return start.sparkSession.read.schema("table_name string, stage long").parquet(path)


def longest_paths(edges: DataFrame, start: DataFrame, hot_share: int = 1000, salts: int = 32) -> DataFrame:
    """``table_name``, ``stage``: the greatest ``stage + w ...`` over all ways from ``start`` (table_name, stage) along ``edges`` (source,
    table_name, w: stored, distinct by source and table), for every table all of whose ways lead back to ``start``.

    Tables with one source are contracted first: each takes its chain's top and the distance to it in log2(length) rounds. What is
    left, tables with several sources fed by tops, is contracted again while that removes an eighth of them (a row of diamonds
    becomes a chain), and else resolved in rounds.
    """
    fed = stored(edges.groupBy("table_name").agg(F.count("*").alias("n"), F.max("source").alias("up"), F.max("w").alias("dist")), "fed")
    total, single = fed.agg(F.count("*"), F.count_if(F.col("n") == 1)).first()
    if single * 8 < max(total, 1):
        return _frontier_rounds(edges, start, hot_share, salts)
    chains = ascend(fed.where("n = 1").drop("n"))
    tops = chains.tops.withColumnRenamed("up", "top")
    joint = edges.join(fed.where("n > 1").select("table_name").hint("merge"), "table_name", "left_semi")
    bent = joint.join(tops.select(F.col("table_name").alias("source"), "top", "dist").hint("merge"), "source", "left").groupBy(
        "table_name", F.coalesce("top", "source").alias("source")).agg(F.max(F.col("w") + F.coalesce("dist", F.lit(0))).alias("w"))
    above = start if total == single else longest_paths(stored(bent, "contracted"), start, hot_share, salts)
    above = stored(above, "above")
    below = tops.join(sized(above.withColumnRenamed("table_name", "top")), "top").select("table_name", (F.col("stage") + F.col("dist")).alias("stage"))
    return above.unionByName(below)


def compute_stages(units: DataFrame, hot_share: int = 1000, salts: int = 32) -> DataFrame:
    """L2: ``(table_name, stage, in_cycle)`` for every table; ``in_cycle`` marks the tables that feed each other.

    Tables that feed nothing, or only such, are taken away level by level first (:func:`_peeled`) and get their stages by one join a level.
    In what is left, stages are longest paths from the tables that nothing feeds (:func:`longest_paths`): rounds are logarithmic in the length of
    chains and grow with the depth of what joins several sources. What does not resolve is on or behind a cycle: the strongly
    connected components of that rest (:mod:`concord.operators.cycles`) become one table each, whose graph has no cycle, and
    the stages go on from those known. Sources with more than ``1/hot_share`` of all edges are salted over ``salts`` sub-keys.
    """
    return staged(units, hot_share, salts).select("table_name", "stage", "in_cycle")


def staged(units: DataFrame, hot_share: int = 1000, salts: int = 32) -> DataFrame:
    """The columns of :func:`compute_stages` and ``cycle``: the smallest name of the cycle a table is on, else NULL."""
    ensure_checkpoint_dir(units.sparkSession)
    # (produced table, source); NULL source = produced without a source or only from itself
    path = stored_path(units.sparkSession, "deps")
    deps = (units.select(F.explode("targets").alias("table_name"), "sources")
            .select("table_name", F.explode_outer("sources").alias("source"))
            .select("table_name", F.when(F.col("source") != F.col("table_name"), F.col("source")).alias("source")))
    deps.write.parquet(path)
    deps = units.sparkSession.read.schema(deps.schema).parquet(path)
    # shuffles by the number of edges: the frames below come from this one, so they run in its session
    deps = roomy(deps.sparkSession, deps.count()).read.schema(deps.schema).parquet(path)
    every = deps.where(F.col("source").isNotNull())
    feeders = stored(every.select(F.col("source").alias("table_name")).distinct(), "feeders")
    edges, outer = _peeled(every, feeders)
    edges = stored(edges.distinct().withColumn("w", F.lit(1).cast("long")), "edges")
    # a table without any source has only NULL ones
    bare = deps.where(F.col("source").isNull()).select("table_name").distinct()
    bare = stored(bare.join(every.select("table_name").hint("merge"), "table_name", "left_anti"), "bare")
    # a table that feeds others is produced by an edge that is kept or peeled, or without a source
    fed = edges.select("table_name").unionByName(bare)
    for level in outer:
        fed = fed.unionByName(level.where("feeds").select("table_name"))
    roots = feeders.join(fed.distinct().hint("merge"), "table_name", "left_anti").withColumn("stage", F.lit(0).cast("long"))
    start = stored(roots.unionByName(bare.withColumn("stage", F.lit(1).cast("long"))), "start")
    known = stored(_inner_stages(edges, start, hot_share, salts), "inner")
    for level in reversed(outer):
        known = known.unionByName(_next_level(level, known))
    return known.withColumn("in_cycle", F.col("cycle").isNotNull()).select("table_name", F.col("stage").cast("int").alias("stage"), "in_cycle", "cycle")


def _peeled(edges: DataFrame, feeders: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``edges`` (source, table_name; a stored table, rows may repeat) less those into tables that feed nothing, and less those into
    tables that feed only such, and so on; and the edges taken away, one stored frame a level (``feeds``: whether the table
    feeds one of the levels before).

    A table that feeds nothing that is left is on no cycle, and its stage is one more than its sources' greatest. Levels are taken while each
    holds an eighth of the edges that are left.
    """
    levels, n = [], edges.count()
    inner = feeders
    while n:
        split = stored(edges.join(inner.withColumn("_on", F.lit(True)).hint("merge"), "table_name", "left").select(
            "source", "table_name", F.col("_on").isNotNull().alias("_on")), "split")
        less = split.where("_on").drop("_on")
        left = less.count()
        if (n - left) * 8 < n:
            break
        levels.append(split.where("NOT _on").select("source", "table_name", F.lit(bool(levels)).alias("feeds")))
        edges, n = less, left
        inner = stored(edges.select(F.col("source").alias("table_name")).distinct(), "inner-feeders")
    return edges, levels


def _next_level(level: DataFrame, known: DataFrame) -> DataFrame:
    """The columns of ``known`` (table_name, stage, cycle) for the tables of a peeled level, all of whose sources are known."""
    above = known.select(F.col("table_name").alias("source"), "stage").hint("merge")
    return stored(level.join(above, "source").groupBy("table_name").agg((F.max("stage") + 1).alias("stage")).select(
        "table_name", "stage", F.lit(None).cast("string").alias("cycle")), "level")


def _inner_stages(edges: DataFrame, start: DataFrame, hot_share: int, salts: int) -> DataFrame:
    """``table_name``, ``stage``, ``cycle`` of the tables of ``edges`` (distinct, stored) and ``start``, cycles included."""
    produced = stored(edges.select("table_name").distinct(), "produced")
    if not produced.limit(1).count():
        return start.select("table_name", "stage", F.lit(None).cast("string").alias("cycle"))
    known = stored(longest_paths(edges, start, hot_share, salts), "known")
    shape = lambda df, cycle: df.select("table_name", "stage", cycle.cast("string").alias("cycle"))
    plain = shape(known, F.lit(None))
    left = stored(produced.select("table_name").join(known.select("table_name").hint("merge"), "table_name", "left_anti"), "left")
    if not left.limit(1).count():
        return plain
    into = edges.join(left.hint("merge"), "table_name", "left_semi")
    inner = into.join(left.select(F.col("table_name").alias("source")).hint("merge"), "source", "left_semi")
    cycles = stored(strong_components(stored(inner.select("source", "table_name"), "open")), "cycles")
    # one node a cycle, under its smallest name; sources with a stage are where ways start
    called = lambda c: cycles.select(F.col("table_name").alias(c), F.col("cycle").alias(f"_{c}")).hint("merge")
    bent = into.join(called("table_name"), "table_name", "left").join(called("source"), "source", "left").select(
        F.coalesce("_table_name", "table_name").alias("table_name"), F.coalesce("_source", "source").alias("source"), "w").where("table_name <> source")
    bent = stored(bent.distinct(), "condensed")
    nodes = cycles.select(F.col("cycle").alias("table_name")).distinct()
    sourceless = nodes.join(bent.select("table_name").hint("merge"), "table_name", "left_anti").withColumn("stage", F.lit(1).cast("long"))
    begin = stored(known.join(bent.select(F.col("source").alias("table_name")).distinct().hint("merge"), "table_name", "left_semi")
                   .unionByName(sourceless), "begin")
    rest = stored(longest_paths(bent, begin, hot_share, salts), "rest")
    named = left.join(cycles.hint("merge"), "table_name", "left").withColumn("node", F.coalesce("cycle", "table_name"))
    behind = named.join(rest.select(F.col("table_name").alias("node"), "stage").hint("merge"), "node")
    return plain.unionByName(shape(behind, F.col("cycle")))


def tables_by_stage(stages: DataFrame) -> DataFrame:
    """L3: per stage the number of tables and the first/last name (no unbounded lists)."""
    return stages.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n_tables"), F.min("table_name").alias("first_table"),
        F.max("table_name").alias("last_table"))


def stage_listing(units: DataFrame) -> DataFrame:
    """L3: ``(stage, table_name, source, unit_id)``: every table of a stage with each source and unit that feeds it
    (NULLs for a table nothing feeds), one row each."""
    edges = build_edges(units).select(F.col("target").alias("table_name"), "source", "unit_id")
    return compute_stages(units).join(edges.hint("merge"), "table_name", "left").select("stage", "table_name", "source", "unit_id")


def incoming(units: DataFrame) -> DataFrame:
    """The incoming ``(target, source, unit_id)`` edges, one row each, sorted.

    Kept as rows rather than one list per table: a table fed by millions of
    units would otherwise be one unbounded value.
    """
    return build_edges(units).select("target", "source", "unit_id").orderBy("target", "source", "unit_id")
