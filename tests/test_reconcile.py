"""Fingerprint reconciliation (R1-R9) and row-level checks (R10) on small fixtures."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from concord.operators import fingerprint as fp
from concord.operators import rowdiff
from concord.plans import drift, workload
from concord.sources.tables import read_table

SF001 = "/root/testdata/sf0.001"


def diffs(df):
    return sorted(((r.check, r.column_name, r.group_key) for r in df.collect()), key=repr)


def test_demo_workload_matches_reference_fixture(spark):
    # sales_orders / customer_segments of the reference's demo, renamed to the order schema.
    d18, d20 = dt.datetime(2026, 6, 18), dt.datetime(2026, 6, 20)
    orders = spark.createDataFrame(
        [(1, 101, d18, 120.0), (2, 102, d18, 90.5), (3, 101, d20, 140.0), (4, 103, d20, 220.0),
         (5, 104, d20, None), (6, 102, d20, 70.25)],
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice double")
    customer = spark.createDataFrame([(101, "enterprise"), (102, "starter"), (103, "enterprise"), (104, "trial")],
                                     "c_custkey long, c_mktsegment string")
    stage1 = workload.daily_revenue(orders, customer, workload.last_load_day(orders))
    assert stage1.count() == 4
    out = {r.segment: (r.revenue, r.order_count) for r in workload.segment_revenue_last_day(orders, customer).collect()}
    assert out == {"enterprise": (Decimal("360.000000"), 2), "starter": (Decimal("70.250000"), 1),
                   "trial": (Decimal("0E-6"), 1)}


def test_key_and_numeric_column_rules(spark):
    df = spark.createDataFrame([(1, True, Decimal("1.5"), "a")], "id int, flag boolean, amt decimal(10,2), name string")
    assert fp.numeric_columns(df) == ["id", "amt"]  # booleans are not numeric, decimals are
    assert fp.key_column(df) == "flag"              # first non-numeric column
    only_numbers = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert fp.key_column(only_numbers) == "a"        # else the first column


def test_identical_tables_match(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 2.0), (None, 3.0)], "k string, v double")
    assert fp.compare(fp.Pair("a", "b", df, df)).count() == 0


def test_sum_tolerance_vs_exact_group_check(spark):
    a = spark.createDataFrame([("x", 100000.0)], "k string, v double")
    b = spark.createDataFrame([("x", 100000.001)], "k string, v double")  # 1e-8 relative drift
    got = diffs(fp.compare(fp.Pair("a", "b", a, b)))
    assert got == [("group_sum", "v", "x")]          # totals within 1e-4, groups exact
    assert fp.compare(fp.Pair("a", "b", a, b), group_tolerance=1e-4).count() == 0


def test_null_key_is_its_own_group_and_does_not_collide_with_text_none(spark):
    a = spark.createDataFrame([(None, 1.0), ("None", 2.0)], "k string, v double")
    b = spark.createDataFrame([("None", 1.0), (None, 2.0)], "k string, v double")
    got = diffs(fp.compare(fp.Pair("a", "b", a, b)))
    assert ("group_sum", "v", None) in got and ("group_sum", "v", "None") in got
    assert all(c != "count" and c != "sum" for c, _, _ in got)


def test_target_only_numeric_column_is_reported(spark):
    a = spark.createDataFrame([("x", 1.0)], "k string, v double")
    b = spark.createDataFrame([("x", 1.0, 5)], "k string, v double, extra int")
    got = diffs(fp.compare(fp.Pair("a", "b", a, b)))
    assert ("sum", "extra", None) in got and ("group_sum", "extra", "x") in got


def test_empty_sides(spark):
    empty = spark.createDataFrame([], "k string, v double")
    full = spark.createDataFrame([("x", 1.0)], "k string, v double")
    assert fp.compare(fp.Pair("a", "b", empty, empty)).count() == 0
    got = diffs(fp.compare(fp.Pair("a", "b", empty, full)))
    assert ("count", None, None) in got and ("group_count", None, "x") in got
    assert fp.fingerprint_long(empty).count() == 0


def test_decimal_sums_are_exact(spark):
    rows = [("k", Decimal("0.1"))] * 10
    a = spark.createDataFrame(rows, "k string, v decimal(10,1)")
    r = fp.fingerprint_long(a).where(F.col("column_name") == "v").first()
    assert r.value_sum == Decimal("1.000000") and r.row_count == 10


def test_rowcount_parity_reports_all_and_raises_on_request(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(1,)], "x int")
    rep = fp.rowcount_parity([fp.Pair("a", "b", a, b), fp.Pair("a", "a", a, a)])
    assert sorted((r.source, r.target, r.matched) for r in rep.collect()) == [("a", "a", True), ("a", "b", False)]
    with pytest.raises(ValueError, match="row-count mismatch for a"):
        fp.assert_parity(rep)


def test_batch_verdict(spark):
    a = spark.createDataFrame([("x", 1.0)], "k string, v double")
    b = spark.createDataFrame([("x", 2.0)], "k string, v double")
    pairs = [fp.Pair("a", "a2", a, a), fp.Pair("a", "b", a, b)]
    v = {(r.source, r.target): (r.status, r.batch_status) for r in fp.verdict(pairs, fp.reconcile(pairs)).collect()}
    assert v == {("a", "a2"): ("validated", "flagged"), ("a", "b"): ("flagged", "flagged")}


def test_row_diff_counts_duplicates_and_nulls(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "")], "id int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (3, None)], "id int, s string")
    got = sorted(((r.id, r.s, r.source_count, r.target_count) for r in rowdiff.row_multiset_diff(a, b).collect()),
                 key=repr)
    assert got == sorted([(1, "x", 2, 1), (3, None, 0, 1), (3, "", 1, 0)], key=repr)  # NULL differs from ''


def test_compensating_drift_is_invisible_to_groups_but_not_rows(spark):
    orders = read_table(spark, SF001, "orders")
    comp = drift.orders_comp(orders)
    assert fp.compare(fp.Pair("o", "c", orders, comp)).count() == 0
    assert rowdiff.row_multiset_diff(orders, comp).count() == 12  # 6 changed rows, both sides


def test_drift_counts_match_fixture_table(spark):
    orders = read_table(spark, SF001, "orders")
    d = rowdiff.row_multiset_diff(orders, drift.orders_tgt(orders))
    tot = d.agg(F.sum(F.greatest(F.col("source_count") - F.col("target_count"), F.lit(0))).alias("s"),
                F.sum(F.greatest(F.col("target_count") - F.col("source_count"), F.lit(0))).alias("t")).first()
    assert (tot.s, tot.t) == (43, 42)  # FIXTURES.md, sf0.001
    assert drift.orders_tgt(orders).count() == 1499


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_bucket_drilldown_equals_direct_per_key_diff(spark, buckets):
    orders = read_table(spark, SF001, "orders")
    tgt = drift.orders_tgt(orders)
    cols = ["o_orderkey", "o_totalprice"]
    got = sorted(tuple(r) for r in rowdiff.bucket_drilldown(orders, tgt, "o_custkey", cols, buckets).collect())
    want = sorted(tuple(r) for r in rowdiff.direct_key_diff(orders, tgt, "o_custkey", cols).collect())
    assert got == want and len(got) > 0


def test_bucket_drilldown_catches_compensation_inside_a_bucket(spark):
    # Two keys in one bucket (buckets=1) drift by +10 / -10: bucket sums agree, weighted sums do not.
    a = spark.createDataFrame([(1, 100.0), (2, 200.0)], "k long, v double")
    b = spark.createDataFrame([(1, 110.0), (2, 190.0)], "k long, v double")
    got = rowdiff.bucket_drilldown(a, b, "k", ["v"], buckets=1).collect()
    assert sorted(r.k for r in got) == [1, 2]


def test_row_hash_edge_cases(spark):
    from concord.functions.canonical import with_row_hash
    a = spark.createDataFrame([(None, "x"), ("x", None), ("", None)], "p string, q string")
    hashes = {(r.p, r.q): (r._h1, r._h2) for r in with_row_hash(a).collect()}
    assert len(set(hashes.values())) == 3  # NULL placement and NULL vs '' matter
    z = spark.createDataFrame([(0.0, float("nan")), (-0.0, float("nan"))], "d double, e double")
    assert with_row_hash(z).select("_h1", "_h2").distinct().count() == 1
    i = spark.createDataFrame([(1, 2)], "x int, y int")
    l = spark.createDataFrame([(1, 2)], "x bigint, y bigint")
    assert with_row_hash(i).select("_h1", "_h2").first() == with_row_hash(l).select("_h1", "_h2").first()
    m = spark.createDataFrame([({"a": 1, "b": 2},)], "m map<string,int>")
    assert with_row_hash(m).first()._h1 is not None


def test_all_null_numeric_column_is_flagged(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("b", None, 2.0)], "k string, empty double, v double")
    got = {r.column_name: (r.non_null, r.all_null) for r in fp.numeric_sums(df).collect()}
    assert got == {"empty": (0, True), "v": (2, False)}


def test_one_shared_key_choice_for_both_sides(spark):
    # The target gains a leading text column; each side picking its own first
    # non-numeric column would group differently and report spurious differences.
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "k string, v double")
    b = spark.createDataFrame([("note", "x", 1.0), ("note", "y", 2.0)], "label string, k string, v double")
    assert fp.key_column(b) == "label"
    assert fp.compare(fp.Pair("a", "b", a, b)).count() == 0


NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("left,right,check", [
    ([NAN], [INF], "nan"), ([NAN], [None], "nan"), ([1e33], [0.0], "out_of_range"), ([1e33], [2e33], "out_of_range"),
    ([INF], [-INF], "negative_infinity"), ([1e22, 1.0], [1e22], "sum")])
def test_values_that_sums_cannot_hold_are_compared(spark, left, right, check):
    a, b = (spark.createDataFrame([("k", float(v) if v is not None else None) for v in side], "k string, v double") for side in (left, right))
    got = {r["check"] for r in fp.compare(fp.Pair("a", "b", a, b)).collect()}
    assert {check, "group_" + check} <= got
    assert fp.compare(fp.Pair("a", "a", a, a)).count() == 0
    drill = rowdiff.bucket_drilldown(a, b, "k", ["v"])
    assert "group_" + check in {r["check"] for r in drill.collect()}
    assert sorted(map(tuple, drill.collect()), key=repr) == sorted(map(tuple, rowdiff.direct_key_diff(a, b, "k", ["v"]).collect()), key=repr)


def test_large_sums_do_not_abort(spark):
    a = spark.createDataFrame([("k", 9e31)] * 20, "k string, v double")
    b = spark.createDataFrame([("k", 9e31)] * 19 + [("k", 8e31)], "k string, v double")
    assert fp.compare(fp.Pair("a", "a", a, a)).count() == 0
    assert {r["check"] for r in fp.compare(fp.Pair("a", "b", a, b)).collect()} == {"out_of_range", "group_out_of_range"}
    most = spark.createDataFrame([("k", Decimal("9" * 22))], "k string, v decimal(22,0)").selectExpr(
        "k", "v", "explode(sequence(1, 3)) as i").select("k", "v")
    assert fp.compare(fp.Pair("m", "m", most, most)).count() == 0


def test_drilldown_sees_large_ids(spark):
    a = spark.createDataFrame([(1, 20000000000000001), (2, 5)], "k long, v long")
    b = spark.createDataFrame([(1, 20000000000000009), (2, 5)], "k long, v long")
    got = [(r.k, r.check, int(r.source_value), int(r.target_value)) for r in rowdiff.bucket_drilldown(a, b, "k", ["v"]).collect()]
    assert got == [(1, "group_sum", 20000000000000001, 20000000000000009)]


def test_overflowing_sum_is_a_difference(spark):
    from concord.functions.numeric import exact_sum
    df = spark.createDataFrame([(Decimal("9" * 22),)], "v decimal(22,0)")
    big = df.selectExpr("explode(array_repeat(v, 20000)) as v").selectExpr("explode(array_repeat(v, 20000)) as v")
    assert big.selectExpr("v").limit(0).agg(exact_sum(F.col("v")).alias("s")).first().s == 0
    fake = spark.createDataFrame([("k", 1, None)], "k string, n long, _s0 decimal(38,6)").withColumn(
        "_x0", F.lit(None).cast(fp.SPECIAL_TYPE))
    got = {r["check"] for r in fp.compare_fingerprints(fake, fake, "a", "b", ["k"], ["v"]).collect()}
    assert got == {"sum", "group_sum"}  # an overflow on both sides is not agreement


@pytest.mark.parametrize("left,right", [
    ("bigint", "decimal(38,0)"), ("bigint", "int"), ("decimal(12,2)", "decimal(14,4)"), ("double", "decimal(20,3)"), ("float", "double"),
    ("bigint", "double")])
def test_row_diff_of_a_retyped_copy_is_empty(spark, left, right):
    a = spark.createDataFrame([(1, 5), (2, None), (3, 0), (3, 0), (4, -7)], "id int, v int").selectExpr("id", f"cast(v as {left}) as v")
    b = a.selectExpr("cast(id as bigint) as id", f"cast(v as {right}) as v")
    assert rowdiff.row_multiset_diff(a, b).count() == 0
    c = b.selectExpr("id", f"case when id = 4 then cast(6 as {right}) else v end as v")
    got = sorted((r.id, float(r.v), r.source_count, r.target_count) for r in rowdiff.row_multiset_diff(a, c).collect())
    assert got == [(4, -7.0, 1, 0), (4, 6.0, 0, 1)]


def test_row_diff_keeps_digits_that_a_double_loses(spark):
    a = spark.createDataFrame([(9007199254740993,)], "v bigint")
    b = a.selectExpr("cast(v as decimal(38,0)) as v")
    assert rowdiff.row_multiset_diff(a, b).count() == 0
    assert rowdiff.row_multiset_diff(a, a.selectExpr("cast(v as double) as v")).count() == 2
    wide = spark.sql("select cast('12345678901234567890123456789012.345' as decimal(38,3)) as v")
    other = spark.sql("select cast('12345678901234567890123456789012.3460' as decimal(36,4)) as v")
    assert rowdiff.row_multiset_diff(wide, other).count() == 2
    assert rowdiff.row_multiset_diff(wide, wide.selectExpr("v + 0 as v")).count() == 0


def test_row_diff_dates_against_timestamps(spark):
    a = spark.sql("select date'2024-02-29' as d union all select null")
    b = a.selectExpr("cast(d as timestamp_ntz) as d")
    assert rowdiff.row_multiset_diff(a, b).count() == 0
    assert rowdiff.row_multiset_diff(a, b.selectExpr("d + interval 1 second as d")).count() == 2


def test_columns_of_one_side_are_reported(spark):
    a = spark.createDataFrame([(1, "x", 2.0)], "id int, s string, v double")
    b = spark.createDataFrame([(1, 5, True)], "ID int, s int, w boolean")
    with pytest.raises(ValueError, match="v \\(missing_target\\)"):
        rowdiff.row_multiset_diff(a, b)
    got = sorted((r.difference, r.column_name) for r in rowdiff.row_report(a, b).collect())
    assert got == [("extra_target", "w"), ("missing_target", "v"), ("no_common_type", "s")]
    assert rowdiff.row_multiset_diff(a, b, ["id"]).count() == 0
    assert sorted(r.difference for r in rowdiff.row_report(a, b.withColumn("ID", F.lit(2))).collect())[-2:] == ["row", "row"]


def test_unusable_and_differently_spelled_keys(spark):
    a = spark.createDataFrame([("x", 1.0)], "k string, v double")
    upper = spark.createDataFrame([("x", 1.0)], "K string, V double")
    none = spark.createDataFrame([(1.0,)], "v double")
    pairs = [fp.Pair("a", "upper", a, upper), fp.Pair("a", "none", a, none), fp.Pair("a", "a", a, a)]
    assert fp.compare(pairs[0]).count() == 0
    for batch in (1, 32):
        d = fp.reconcile(pairs, batch=batch)
        assert [(r.target, r.check) for r in d.collect()] == [("none", "error")]
        assert {r.target: r.status for r in fp.verdict(pairs, d).collect()} == {"upper": "validated", "none": "flagged", "a": "validated"}


def test_two_keys_cannot_look_alike(spark):
    a = spark.createDataFrame([("a|b", "c", 1), ("a", "b|c", 2)], "p string, q string, v int")
    assert fp.fingerprint_long(a, ["p", "q"]).select("group_key").distinct().count() == 2


def test_no_full_row_is_shuffled(spark):
    """With no size-based broadcast, only hashes are exchanged before the differing rows are fetched."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = read_table(spark, SF001, "orders")
        d = rowdiff.row_multiset_diff(orders, drift.orders_tgt(orders))
        text = d._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert all("partial_first" in text for _ in [0])  # the only exchange of rows is after the join


def test_many_pairs_run_at_once_and_failures_stay_alone(spark):
    """Pairs that fail while they are read cost their own row only; plans stay small whatever the list."""
    good = spark.range(20).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").alias("v"))
    other = good.withColumn("v", F.col("v") + F.when(F.col("v") == 7, 1).otherwise(0))
    broken = good.withColumn("v", F.raise_error(F.lit("disk gone")).cast("long"))
    sides = {7: broken, 12: other}
    pairs = [fp.Pair(f"s{i:02}", f"t{i:02}", good, sides.get(i, good)) for i in range(30)]
    diffs = fp.reconcile(pairs, batch=8, at_once=4)
    got = {r.target: (r.status, r.n_diffs) for r in fp.verdict(pairs, diffs).collect()}
    assert {t for t, (s, _) in got.items() if s == "flagged"} == {"t07", "t12"} and got["t07"][1] == 1
    error = diffs.where("check = 'error'").collect()
    assert [r.target for r in error] == ["t07"] and "disk gone" in error[0].group_key
    lost = good.where(F.raise_error(F.lit("disk gone")).isNull())
    rows = {r.target: (r.target_rows, r.matched) for r in fp.rowcount_parity(
        [fp.Pair("a", f"t{i}", good, lost if i == 3 else good) for i in range(9)], batch=4).collect()}
    assert rows["t3"] == (None, False) and all(v == (20, True) for t, v in rows.items() if t != "t3")


def test_jobs_in_flight_keep_local_properties(spark):
    import threading

    from concord.functions.concurrent import run_all
    spark.sparkContext.setLocalProperty("concord.test", "here")
    meet = threading.Barrier(3, timeout=60)  # only passed if three are in flight

    def call(i):
        meet.wait()
        if i == 1:
            raise ValueError("one fails")
        return spark.sparkContext.getLocalProperty("concord.test"), spark.range(i).count()

    got = run_all(spark, [lambda i=i: call(i) for i in range(3)], 3)
    assert got[0] == ("here", 0) and got[2] == ("here", 2) and str(got[1]) == "one fails"
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_readable_tables(spark):
    from concord.sources.tables import readable
    spark.range(3).createOrReplaceTempView("there_is")
    spark.range(3).select(F.raise_error(F.lit("bad")).alias("x")).createOrReplaceTempView("fails")
    got = {r.table_name: r.readable for r in readable(spark, ["there_is", "nowhere", "fails"]).collect()}
    assert got == {"there_is": True, "nowhere": False, "fails": False}


@pytest.mark.parametrize("most_bits", [1 << 28, 1 << 6])
def test_only_rows_that_may_differ_are_joined_by_a_shuffle(spark, monkeypatch, most_bits):
    monkeypatch.setattr(rowdiff, "BROADCAST_HASHES", 5)
    monkeypatch.setattr(rowdiff, "BITMAP_BITS", most_bits)
    passed = []

    def seen(df, wanted, n, run=rowdiff.maybe_in):
        out = run(df, wanted, n)
        passed.append(out.count())
        return out

    monkeypatch.setattr(rowdiff, "maybe_in", seen)
    s = spark.range(20_000).withColumn("x", F.when(F.col("id") % 7 != 0, F.col("id") * 3))
    t = s.where("id % 211 <> 0").unionByName(s.where("id % 503 = 0"))
    got = {tuple(r) for r in rowdiff.row_multiset_diff(s, t).collect()}
    want = {(i, i * 3 if i % 7 else None, 1, (i % 211 != 0) + (i % 503 == 0)) for i in range(20_000)}
    assert got == {r for r in want if r[2] != r[3]}
    assert len(passed) == 2
    if most_bits > 1 << 20:
        assert max(passed) < 20_000 // 8  # before, all rows of both sides went into the exchange
