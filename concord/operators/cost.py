"""Statement cost estimates and optimisation-history analysis.

Cost estimates are column expressions over a statements frame; ranking is a
window per script (ties keep input order). The optimisation loop's decision
rules are replayed over a recorded history frame with windows instead of a
driver loop, one row per (query, iteration):

* the current cost before iteration ``i`` is the running minimum over earlier
  successful iterations (accept iff cheaper makes it so);
* ``marginal_improvement_pct`` is measured against that current cost;
* a run of ``streak`` consecutive iterations under ``min_improvement_pct``
  stops with ``diminishing_returns`` (gaps-and-islands: ``i`` minus the last
  iteration that was not flat);
* the first failed iteration stops with its reason; rows after a stop are
  dropped; a failed baseline stops at once (``baseline_execution_failed``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, ByteType, DataType, DateType, DecimalType,
                               FloatType, IntegerType, MapType, ShortType, StringType, StructType)

from concord.functions.text import strip_ws
from concord.operators.fingerprint import balanced_union
from concord.session import ensure_checkpoint_dir

# Fixed values (defaults of the reference).
BYTES_PER_TIB = 2 ** 40
PRICE_PER_TIB_USD = 6.25
BYTES_PER_CHAR = 1024
PREVIEW_CHARS = 80
MAX_ITERATIONS = 5
MIN_IMPROVEMENT_PCT = 2.0
DIMINISHING_STREAK = 2
# Python's str.split() whitespace, written out (valid for Java and RE2 regexes).
PY_WHITESPACE = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def text_bytes(sql: Column, bytes_per_char: int = BYTES_PER_CHAR) -> Column:
    """UTF-8 length of the whole statement times a factor."""
    return F.octet_length(sql).cast("long") * F.lit(bytes_per_char)


def cost_usd(bytes_col: Column, price_per_tib: float = PRICE_PER_TIB_USD) -> Column:
    """Bytes / 2^40 × price."""
    return bytes_col.cast("double") / F.lit(float(BYTES_PER_TIB)) * F.lit(float(price_per_tib))


def preview(sql: Column, limit: int = PREVIEW_CHARS) -> Column:
    """Whitespace collapsed, first ``limit`` characters plus '…' when longer, '|' escaped."""
    collapsed = F.regexp_replace(F.regexp_replace(sql, rf"^{PY_WHITESPACE}+|{PY_WHITESPACE}+$", ""),
                                 rf"{PY_WHITESPACE}+", " ")
    cut = F.concat(F.substring(collapsed, 1, limit), F.when(F.length(collapsed) > limit, F.lit("…")).otherwise(F.lit("")))
    return F.replace(cut, F.lit("|"), F.lit("\\|"))


def non_blank(sql: Column) -> Column:
    """Q7: the statement has non-whitespace text."""
    return F.length(strip_ws(F.coalesce(sql, F.lit("")))) > 0


def value_bytes(c: Column, dtype: DataType) -> Column:
    """Bytes of a value: the encoded text, or the width of a fixed type; 0 for NULL. Nested values count as JSON."""
    if isinstance(dtype, (StringType, BinaryType)):
        size = F.octet_length(c)
    elif isinstance(dtype, (ArrayType, MapType, StructType)):
        size = F.octet_length(F.to_json(c))
    else:
        width = {BooleanType: 1, ByteType: 1, ShortType: 2, IntegerType: 4, FloatType: 4, DateType: 4, DecimalType: 16}
        size = F.when(c.isNotNull(), F.lit(width.get(type(dtype), 8)))
    return F.coalesce(size, F.lit(0)).cast("long")


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: the sum over its columns."""
    total = F.lit(0).cast("long")
    for f in df.schema.fields:
        total = total + value_bytes(F.col(f"`{f.name}`"), f.dataType)
    return total


def table_sizes(frames: dict[str, DataFrame]) -> DataFrame:
    """Per table ``(table_name, size_bytes)``: the bytes of all its values, measured in one scan per table.

    A scan estimate that does not depend on file encoding or compression.
    """
    return balanced_union([df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("size_bytes"))
                           .select(F.lit(name.lower()).alias("table_name"), "size_bytes") for name, df in frames.items()])


def listed_sizes(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """C2 without reading a table: ``(table_name, size_bytes)`` of every table stored below ``root``, from one listing of its files.

    A table is a folder directly below ``root``; files at any depth below it that match ``pattern`` count as they are stored, compressed.
    Neither contents nor footers are read. Use ``table_sizes`` to spot-check what the values of a table amount to.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "length")
    plain = lambda c: F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.-]*:/+", "/")  # noqa: E731  # 'file:/x' and 'file:///x' are the same place
    below = F.substring(plain(F.col("path")), F.length(plain(F.lit(root.rstrip("/")))) + 2, F.lit(1 << 30))
    return listed.groupBy(F.lower(F.regexp_extract(below, "^([^/]+)/", 1)).alias("table_name")).agg(F.sum("length").alias("size_bytes")).where("table_name <> ''")


def scan_estimate(units: DataFrame, sizes: DataFrame, keys: tuple[str, ...] = ("script_id", "unit_id"),
                  price_per_tib: float = PRICE_PER_TIB_USD) -> DataFrame:
    """Bytes a statement would scan = sum of its distinct source tables' sizes.

    An upper bound (pruning ignored). A source with no known size makes the
    estimate fail: ``error`` names the unknown tables and the bytes count as 0.
    """
    refs = units.select(*keys, F.explode_outer("sources").alias("table_name"))
    j = refs.join(sizes, "table_name", "left")
    g = j.groupBy(*keys).agg(
        F.sum(F.coalesce("size_bytes", F.lit(0))).cast("long").alias("_b"),
        F.array_sort(F.collect_set(F.when(F.col("table_name").isNotNull() & F.col("size_bytes").isNull(),
                                          F.col("table_name")))).alias("_unknown"))
    failed = F.size("_unknown") > 0
    bytes_ = F.when(failed, F.lit(0).cast("long")).otherwise(F.col("_b"))
    return g.select(*keys, bytes_.alias("estimated_bytes"), cost_usd(bytes_, price_per_tib).alias("estimated_cost_usd"),
                    F.when(failed, F.concat(F.lit("unknown table: "), F.array_join("_unknown", ", ")))
                    .otherwise(F.lit("")).alias("error"))


def rank_costs(est: DataFrame, script: str = "script_id", order: str = "unit_order") -> DataFrame:
    """``rank`` per script by cost, most expensive first; ties keep input order.

    A window per script. Use it when a script's statements come from one script
    text (one input row), so a window partition is never larger than a row one
    task already held; for groupings that can hold a large share of all rows use
    ``rank_costs_distributed``.
    """
    w = Window.partitionBy(script).orderBy(F.desc("estimated_cost_usd"), F.asc(order))
    return est.withColumn("rank", F.row_number().over(w))


def rank_costs_distributed(est: DataFrame, script: str = "script_id", order: str = "unit_order",
                           partitions: int | None = None) -> DataFrame:
    """W1/C4 for arbitrarily large groups: the same ranks as ``rank_costs``.

    Skew-safe: rows are range-partitioned on ``(script, cost desc, order)``, so
    a script holding a third of all statements spans many partitions. Each
    partition numbers its rows per script; the rank adds the row counts of the
    same script in earlier partitions (a small ``(partition, script)`` frame).
    The partitioned rows are checkpointed once (an eager step).
    """
    spark = est.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(script), F.desc("estimated_cost_usd"), F.asc(order)]
    # Materialised once (reliable checkpoint): range bounds come from a sample, so
    # the two uses below must read the very same partitions.
    ranged = est.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()).checkpoint()
    local = ranged.withColumn("_local", F.row_number().over(
        Window.partitionBy("_pid", script).orderBy(F.desc("estimated_cost_usd"), F.asc(order))))
    counts = ranged.groupBy("_pid", script).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(script).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", script, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return local.join(offsets, ["_pid", script]).withColumn(
        "rank", (F.col("_off") + F.col("_local")).cast("int")).drop("_pid", "_local", "_off")


def cost_totals(est: DataFrame, script: str = "script_id", price_per_tib: float = PRICE_PER_TIB_USD) -> DataFrame:
    """Per script statement count, failed count, total bytes and cost.

    The total cost is priced from the exact byte total (equal to the sum of the
    per-statement costs, without float summation order).
    """
    g = est.groupBy(script).agg(
        F.count(F.lit(1)).alias("n_queries"),
        F.count_if(F.coalesce(F.col("error"), F.lit("")) != "").alias("n_failed"),
        F.sum("estimated_bytes").cast("long").alias("total_bytes"))
    return g.withColumn("total_cost_usd", cost_usd(F.col("total_bytes"), price_per_tib))


def replay_history(history: DataFrame, max_iterations: int = MAX_ITERATIONS,
                   min_improvement_pct: float = MIN_IMPROVEMENT_PCT, streak: int = DIMINISHING_STREAK,
                   price_per_tib: float = PRICE_PER_TIB_USD) -> DataFrame:
    """C6/C7 over ``history(query_id, iteration, estimated_bytes, outcome)``.

    ``outcome`` is ``ok`` or a failure (``llm_error``, ``estimate_failed``,
    ``execution_failed``, ``validation_failed``). Returns the kept iterations
    with ``accepted``, ``validation_matched``, ``marginal_improvement_pct``,
    ``current_bytes`` (after the iteration), ``stop_iteration``, ``stop_reason``
    and ``note`` (baseline / accepted / no_cost_improvement / the failure).
    """
    h = history.where(F.col("iteration") <= max_iterations)
    # The baseline (iteration 0) stops the loop only when its execution failed; a
    # failed baseline estimate is recorded as 0 bytes and the loop goes on.
    ok = (F.col("outcome") == "ok") | ((F.col("iteration") == 0) & (F.col("outcome") != "execution_failed"))
    # A failed estimate (or no candidate at all) counts as 0 bytes, as recorded.
    zeroed = (F.col("outcome") == "estimate_failed") | ((F.col("outcome") == "llm_error") & (F.col("iteration") > 0))
    h = h.withColumn("estimated_bytes", F.when(zeroed, F.lit(0).cast("long")).otherwise(F.col("estimated_bytes")))
    good_bytes = F.when(ok, F.col("estimated_bytes"))
    by_q = Window.partitionBy("query_id").orderBy("iteration")
    before = by_q.rowsBetween(Window.unboundedPreceding, -1)
    cur_before = F.min(good_bytes).over(before)
    h = h.withColumn("_cur", cur_before)
    marginal = F.when(ok & (F.col("iteration") > 0),
                      F.when(F.col("_cur") > 0, (F.col("_cur") - F.col("estimated_bytes")).cast("double")
                             / F.col("_cur").cast("double") * F.lit(100.0)).otherwise(F.lit(0.0)))
    h = h.withColumn("_m", marginal)
    flat = F.col("_m") < F.lit(float(min_improvement_pct))
    h = h.withColumn("_last_steep", F.max(F.when(~flat | (F.col("iteration") == 0), F.col("iteration")))
                     .over(by_q.rowsBetween(Window.unboundedPreceding, 0)))
    reason = (F.when((F.col("iteration") == 0) & ~ok, F.lit("baseline_execution_failed"))
              .when((F.col("iteration") > 0) & ~ok, F.col("outcome"))
              .when(flat & (F.col("iteration") - F.col("_last_steep") >= streak), F.lit("diminishing_returns")))
    h = h.withColumn("_reason", reason)
    per_q = Window.partitionBy("query_id")
    stop_it = F.min(F.when(F.col("_reason").isNotNull(), F.col("iteration"))).over(per_q)
    h = h.withColumn("stop_iteration", F.coalesce(stop_it, F.max("iteration").over(per_q)))
    stop_reason = F.max(F.when(F.col("iteration") == F.col("stop_iteration"), F.col("_reason"))).over(per_q)
    h = h.withColumn("stop_reason", F.coalesce(stop_reason, F.lit("max_iterations")))
    h = h.where(F.col("iteration") <= F.col("stop_iteration"))
    accepted = F.when(F.col("iteration") == 0, F.lit(True)).otherwise(ok & (F.col("estimated_bytes") < F.col("_cur")))
    validated = (F.when(F.col("iteration") == 0, F.lit(None).cast("boolean"))
                 .when(ok, F.lit(True)).when(F.col("outcome") == "validation_failed", F.lit(False))
                 .otherwise(F.lit(None).cast("boolean")))
    current_after = F.least(F.col("_cur"), good_bytes)  # least() skips NULLs
    bytes_recorded = F.col("estimated_bytes")
    note = (F.when(F.col("iteration") == 0, F.when(ok, F.lit("baseline")).otherwise(F.lit("baseline_execution_failed")))
            .when(~ok, F.col("outcome")).when(F.col("estimated_bytes") < F.col("_cur"), F.lit("accepted"))
            .otherwise(F.lit("no_cost_improvement")))
    return h.select(
        "query_id", "iteration", bytes_recorded.alias("estimated_bytes"),
        cost_usd(bytes_recorded, price_per_tib).alias("estimated_cost_usd"), accepted.alias("accepted"),
        validated.alias("validation_matched"), F.round("_m", 4).alias("marginal_improvement_pct"),
        F.when(F.col("iteration") == 0, F.col("estimated_bytes")).otherwise(current_after).alias("current_bytes"),
        "stop_iteration", "stop_reason", note.alias("note"))


def history_summary(replayed: DataFrame, price_per_tib: float = PRICE_PER_TIB_USD) -> DataFrame:
    """Per query baseline and final bytes and cost, total improvement % (0 when the baseline is 0)."""
    g = replayed.groupBy("query_id").agg(
        F.min_by("estimated_bytes", "iteration").alias("baseline_bytes"),
        F.max_by("current_bytes", "iteration").alias("final_bytes"),
        F.count(F.lit(1)).alias("n_iterations"), F.first("stop_reason").alias("stop_reason"))
    return g.select("query_id", "baseline_bytes", "final_bytes",
                    cost_usd(F.col("baseline_bytes"), price_per_tib).alias("baseline_cost_usd"),
                    cost_usd(F.col("final_bytes"), price_per_tib).alias("final_cost_usd"),
                    F.round(_pct(F.col("baseline_bytes"), F.col("final_bytes")), 4).alias("total_improvement_pct"),
                    "stop_reason", "n_iterations")


def _pct(base: Column, final: Column) -> Column:
    return F.when(base > 0, (base - final).cast("double") / base.cast("double") * F.lit(100.0)).otherwise(F.lit(0.0))


def history_totals(summary: DataFrame, price_per_tib: float = PRICE_PER_TIB_USD) -> DataFrame:
    """Total baseline and final cost over all queries and the overall % (guarded).

    Totals are summed as exact bytes, then priced.
    """
    g = summary.agg(F.count(F.lit(1)).alias("n_queries"),
                    F.sum("baseline_bytes").cast("long").alias("baseline_bytes"),
                    F.sum("final_bytes").cast("long").alias("final_bytes"))
    return g.select("n_queries", cost_usd(F.col("baseline_bytes"), price_per_tib).alias("total_baseline_cost_usd"),
                    cost_usd(F.col("final_bytes"), price_per_tib).alias("total_final_cost_usd"),
                    F.round(_pct(F.col("baseline_bytes"), F.col("final_bytes")), 2).alias("overall_improvement_pct"))
