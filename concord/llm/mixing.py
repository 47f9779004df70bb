"""Mixing sources to target weights: budgets down a domain-language-source tree, seeded token prefixes of its leaves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.llm.common import BROADCAST_ROWS, written

#: Words as tokens: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Buckets into which an epoch's order is cut to find where a prefix ends.
BUCKETS = 4096


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(seed: int, epoch: Column, key: Column) -> Column:
    """Place of a row in an epoch's seeded order: 60 bits of MD5, the same in any engine."""
    text = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def share_out(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Budgets of siblings: columns ``parent``, ``child``, ``weight``, ``capacity``, ``total`` (the parent's budget)
    to ``budget``.

    Every child gets level x weight, at most its capacity, with the level at which the parent's budget is used up:
    the shortage of full children goes to their siblings by weight. In the order of capacity / weight, the level
    is the largest of (budget - capacities before) / (weights from here on). A child of weight 0 gets nothing.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    rows = children.where("weight > 0 and capacity > 0").withColumn("_ratio", F.col("capacity") / F.col("weight"))
    order = by.orderBy("_ratio", child)
    full = F.coalesce(F.sum("capacity").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("_level", (F.least("total", F.sum("capacity").over(by)) - full) / open_weight)
    level = F.max("_level").over(by)
    return rows.withColumn("budget", F.least("capacity", F.floor(F.col("weight") * level + 1e-6))).drop("_ratio", "_level")


def plan(leaves: DataFrame, levels: list[str], weights: dict[str, dict[str, int]], share: float, max_epochs: int) -> DataFrame:
    """Budget of every leaf: ``leaves`` has the columns ``levels`` (never null) and ``supply``.

    The root's budget is ``share`` of all tokens. It is shared out level by level; a node's capacity is that of all
    leaves below it, ``max_epochs`` times their supply, so a shortage is met by siblings as far as they reach and
    only then by the siblings of the ancestors. ``weights`` gives each level's weights by value, 1 where none is given.
    """
    nodes = leaves.withColumn("capacity", F.col("supply") * max_epochs)
    total = nodes.agg(F.floor(F.sum("supply") * F.lit(share)).cast("long").alias("total"))
    for k, level in enumerate(levels):
        given = weights.get(level, {})
        weight = F.coalesce(F.create_map(*[F.lit(x) for kv in given.items() for x in kv])[F.col(level)], F.lit(1)) if given else F.lit(1)
        children = nodes.groupBy(*levels[:k + 1]).agg(F.sum("capacity").alias("capacity")).withColumn("weight", weight.cast("long"))
        children = children.join(total, levels[:k]) if k else children.crossJoin(F.broadcast(total))  # one row
        total = share_out(children, levels[:k], level).select(*levels[:k + 1], F.col("budget").alias("total"))
    return leaves.join(total, levels).withColumnRenamed("total", "budget")


def cuts(rows: DataFrame, leaves: DataFrame, levels: list[str], seed: int) -> DataFrame:
    """Where each leaf's token prefix ends: ``epochs`` taken whole, then all rows of the next epoch's order whose
    place is below ``cut``, and of the rows at ``cut`` (``held`` tokens) the share that gives ``rest`` tokens.

    The order is first cut into ``BUCKETS`` ranges whose sums show in which the prefix ends; only the rows of that
    range are sorted, one in ``BUCKETS`` of a leaf.
    """
    leaves = leaves.withColumn("epochs", F.floor(F.col("budget") / F.col("supply")).cast("int")).withColumn(
        "more", F.col("budget") % F.col("supply"))
    small = leaves.count() <= BROADCAST_ROWS
    ends = leaves.where("more > 0").select(*levels, "epochs", "more")
    placed = rows.join(F.broadcast(ends) if small else ends, levels).withColumn(
        "place", order_key(seed, F.col("epochs"), F.col("key"))).withColumn("bucket", F.shiftright("place", 48).cast("int"))
    sums = placed.groupBy(*levels, "more", "bucket").agg(F.sum("tokens").alias("tokens"))
    before = Window.partitionBy(*levels).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    at = sums.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))).where(
        "base < more and base + tokens >= more").select(*levels, "bucket", "base")
    units = placed.join(F.broadcast(at) if small else at, [*levels, "bucket"]).groupBy(*levels, "more", "base", "place").agg(
        F.sum("tokens").alias("held"))
    inside = Window.partitionBy(*levels).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    end = units.withColumn("base", F.col("base") + F.coalesce(F.sum("held").over(inside), F.lit(0))).where(
        "base < more and base + held >= more").select(*levels, F.col("place").alias("cut"), "held", (F.col("more") - F.col("base")).alias("rest"))
    return leaves.select(*levels, "epochs").join(end, levels, "left")


def mix(docs: DataFrame, levels: dict[str, Column], weights: dict[str, dict[str, int]], tokens: Column, key: str = "doc_id",
        share: float = 0.8, max_epochs: int = 4, seed: int = 42) -> DataFrame:
    """Rows of ``docs`` that the mixture takes, once for every epoch that takes them.

    ``levels`` names the tree's levels from the root on and the expressions of their values; a null value counts as
    the value ''. The budget, ``share`` of all tokens, goes down the tree by ``weights`` (:func:`plan`); each leaf is read
    in seeded epochs, each a new order of all its rows by ``key``, up to its budget. Added columns: the levels (as
    ``_<level>``), ``_epoch``, ``_tokens`` (of the row) and ``_take`` (tokens taken, fewer only for the row in which a prefix ends).

    Rows that share a key share a place; if a prefix ends there, each gives the same share of its tokens, rounded
    down. Rows without tokens are taken with their place, but not at the cut. A weight of 0 takes nothing. A null
    key is a key of its own; an empty table gives no rows; columns of ``docs`` named like an added one are replaced. Only narrow rows are shuffled: texts are filtered where
    they are, by one line per leaf that is broadcast when counted small, else joined.
    """
    names = [f"_{n}" for n in levels]
    parts = {f"_{n}": F.coalesce(c.cast("string"), F.lit("")) for n, c in levels.items()}
    box = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.select(*[c.alias(n) for n, c in parts.items()], tokens.alias("_tokens"), F.col(key).alias("_key"), box.alias("_doc"))
    narrow = written(named.select(*names, F.col("_key").alias("key"), F.col("_tokens").alias("tokens")), "lengths")
    supply = narrow.groupBy(*names).agg(F.sum("tokens").alias("supply")).where("supply > 0")
    leaves = written(plan(supply, names, {f"_{k}": v for k, v in weights.items()}, share, max_epochs), "leaves")
    ends = written(cuts(narrow, leaves, names, seed), "ends")
    joined = named.join(F.broadcast(ends) if ends.count() <= BROADCAST_ROWS else ends, names)
    place = order_key(seed, F.col("epochs"), F.col("_key"))
    part = F.floor(F.col("_tokens") * F.col("rest") / F.col("held"))
    last = F.when(place < F.col("cut"), F.col("_tokens")).when((place == F.col("cut")) & (part > 0), part)
    added = [*names, "_epoch", "_tokens", "_take"]
    return joined.withColumn("_last", last).withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.col("epochs")))).where(
        "_epoch < epochs or _last is not null").withColumn(
        "_take", F.when(F.col("_epoch") < F.col("epochs"), F.col("_tokens")).otherwise(F.col("_last"))).select(
        *[F.col("_doc")[c].alias(c) for c in docs.columns if c not in added], *added)


def domain(source: Column) -> Column:
    """A stand-in domain for tables that have none: three groups of sources by the first hex digit of their MD5."""
    digit = F.substring(F.md5(F.coalesce(source, F.lit("")).cast("binary")), 1, 1)
    return F.when(digit < "6", F.lit("web")).when(digit < "b", F.lit("books")).otherwise(F.lit("code"))


#: Target weights of the registered query and of the pipeline.
WEIGHTS = {"domain": {"web": 3, "books": 2, "code": 1}, "lang": {"en": 3, "de": 2, "fr": 2, "es": 2}}


def tree() -> dict[str, Column]:
    return {"domain": domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


def first_words(text: Column, count: Column) -> Column:
    """The text up to the end of its ``count``-th word and the white space after it."""
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(text.rlike(r"^[\x20\x09-\x0D]"), F.lit(1)).otherwise(F.lit(0))
    return F.array_join(F.slice(pieces, F.lit(1), (count + lead).cast("int")), "")
