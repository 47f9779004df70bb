"""Cost estimates, ranking and optimisation-history replay (C1-C8) on the reference's fixtures."""

from pyspark.sql import functions as F

from concord.operators import cost as cst


def history(spark, costs, outcomes=None):
    outcomes = outcomes or ["ok"] * len(costs)
    rows = [(1, i, c, o) for i, (c, o) in enumerate(zip(costs, outcomes))]
    return spark.createDataFrame(rows, "query_id long, iteration int, estimated_bytes long, outcome string")


def replay(spark, costs, outcomes=None, **kw):
    r = cst.replay_history(history(spark, costs, outcomes), **kw)
    s = cst.history_summary(r).first()
    return r.orderBy("iteration").collect(), s


def test_diminishing_returns_stops_at_iteration_3(spark):
    rows, s = replay(spark, [100, 90, 89, 88, 87, 86], min_improvement_pct=5.0, streak=2)
    assert len(rows) == 4 and s.stop_reason == "diminishing_returns" and s.final_bytes == 88
    assert [r.accepted for r in rows] == [True, True, True, True]
    assert [r.marginal_improvement_pct for r in rows] == [None, 10.0, 1.1111, 1.1236]


def test_cap_reached(spark):
    rows, s = replay(spark, [100, 50, 25, 12, 6], max_iterations=3, min_improvement_pct=1.0)
    assert len(rows) == 4 and s.stop_reason == "max_iterations" and s.final_bytes == 12
    assert s.total_improvement_pct == 88.0


def test_validation_failure_keeps_baseline(spark):
    rows, s = replay(spark, [100, 50], ["ok", "validation_failed"])
    assert s.stop_reason == "validation_failed" and s.final_bytes == 100
    assert rows[1].validation_matched is False and rows[1].accepted is False


def test_worse_candidates_are_rejected(spark):
    rows, s = replay(spark, [100, 120, 130, 140], min_improvement_pct=2.0, streak=2)
    assert [r.accepted for r in rows] == [True, False, False]
    assert s.stop_reason == "diminishing_returns" and s.final_bytes == 100 and s.total_improvement_pct == 0.0


def test_failures_and_disabled_loop(spark):
    _, s = replay(spark, [100, 90], ["execution_failed", "ok"])
    assert s.stop_reason == "baseline_execution_failed" and s.n_iterations == 1
    rows, s = replay(spark, [100, 0], ["ok", "estimate_failed"])
    assert s.stop_reason == "estimate_failed" and rows[1].estimated_bytes == 0
    _, s = replay(spark, [100, 90], max_iterations=0)
    assert s.stop_reason == "max_iterations" and s.n_iterations == 1
    _, s = replay(spark, [0, 0])  # zero baseline: improvement 0, not a division error
    assert s.total_improvement_pct == 0.0


def test_rank_blank_exclusion_and_totals(spark):
    st = spark.createDataFrame([
        ("run", 1, "DDL", "CREATE OR REPLACE TABLE t AS SELECT * FROM raw_sales_orders"),
        ("run", 2, "DML", "SELECT customer_id FROM raw_sales_orders WHERE amount > 0"),
        ("run", 3, "DML", "  \n ")], "script_id string, unit_order int, statement_type string, sql string")
    kept = st.where(cst.non_blank(F.col("sql")))
    b = cst.text_bytes(F.col("sql"))
    est = kept.select("script_id", "unit_order", b.alias("estimated_bytes"), cst.cost_usd(b).alias("estimated_cost_usd"),
                      F.lit("").alias("error"))
    ranked = {r.unit_order: r.rank for r in cst.rank_costs(est).collect()}
    assert ranked == {1: 1, 2: 2}
    tot = cst.cost_totals(est).first()
    assert tot.n_queries == 2 and tot.n_failed == 0
    assert tot.total_bytes == (len("CREATE OR REPLACE TABLE t AS SELECT * FROM raw_sales_orders")
                               + len("SELECT customer_id FROM raw_sales_orders WHERE amount > 0")) * 1024
    assert abs(tot.total_cost_usd - tot.total_bytes / 2 ** 40 * 6.25) < 1e-15


def test_ties_keep_input_order(spark):
    est = spark.createDataFrame([("s", 2, 10, 1.0), ("s", 1, 10, 1.0)],
                                "script_id string, unit_order int, estimated_bytes long, estimated_cost_usd double")
    assert {r.unit_order: r.rank for r in cst.rank_costs(est).collect()} == {1: 1, 2: 2}


def test_preview(spark):
    long_sql = "SELECT  a,\n\tb | c FROM " + "x" * 100
    r = spark.createDataFrame([(long_sql,), ("SELECT 1",)], "s string").select(cst.preview(F.col("s")).alias("p")).collect()
    collapsed = " ".join(long_sql.split())
    assert r[0].p == (collapsed[:80] + "…").replace("|", "\\|")
    assert r[1].p == "SELECT 1"


def test_scan_estimate_unknown_table_fails_with_zero_bytes(spark):
    units = spark.createDataFrame([("s", 1, ["a", "b"]), ("s", 2, ["a", "nope"]), ("s", 3, [])],
                                  "script_id string, unit_id int, sources array<string>")
    sizes = spark.createDataFrame([("a", 100), ("b", 10)], "table_name string, size_bytes long")
    got = {r.unit_id: (r.estimated_bytes, r.error) for r in cst.scan_estimate(units, sizes).collect()}
    assert got == {1: (110, ""), 2: (0, "unknown table: nope"), 3: (0, "")}


def test_distributed_rank_matches_a_window_on_a_skewed_script(spark):
    from pyspark.sql import Window
    rows = [("big", i, (i * 37) % 101, 0.0) for i in range(400)] + [("small", i, i % 3, 0.0) for i in range(5)]
    est = spark.createDataFrame(rows, "script_id string, unit_order int, estimated_bytes long, estimated_cost_usd double")
    est = est.withColumn("estimated_cost_usd", F.col("estimated_bytes").cast("double"))
    got = {(r.script_id, r.unit_order): r.rank for r in cst.rank_costs_distributed(est, partitions=7).collect()}
    w = Window.partitionBy("script_id").orderBy(F.desc("estimated_cost_usd"), F.asc("unit_order"))
    want = {(r.script_id, r.unit_order): r.rank for r in est.withColumn("rank", F.row_number().over(w)).collect()}
    assert got == want


def test_failed_baseline_estimate_counts_zero_and_continues(spark):
    rows, s = replay(spark, [100, 90, 80], ["estimate_failed", "ok", "ok"], min_improvement_pct=2.0, streak=2)
    assert rows[0].estimated_bytes == 0 and s.baseline_bytes == 0
    assert s.stop_reason == "diminishing_returns" and s.final_bytes == 0 and s.total_improvement_pct == 0.0


def test_iteration_notes(spark):
    rows, _ = replay(spark, [100, 90, 95, 50], ["ok", "ok", "ok", "validation_failed"], min_improvement_pct=1.0)
    assert [r.note for r in rows] == ["baseline", "accepted", "no_cost_improvement", "validation_failed"]


def test_ranks_take_their_partitions_from_the_number_of_orders(spark, monkeypatch):
    from concord.functions import stored
    from concord.plans import catalog

    monkeypatch.setattr(stored, "PARTITION_ROWS", 4)
    ranked = catalog.QUERIES["cost_rank"](spark, "/root/testdata/sf0.001")
    n = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    assert int(ranked.sparkSession.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) == n
    assert ranked.count() == 3 * n
