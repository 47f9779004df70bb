"""Plan shape checks: the scale properties the operators are built for."""

from concord.functions.canonical import with_row_hash
from concord.operators import fingerprint as fp
from concord.plans import drift, workload
from concord.sources.files import latest_by
from concord.sources.tables import read_table

SF001 = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fingerprint_join_reuses_the_aggregate_partitioning(spark):
    orders = read_table(spark, SF001, "orders")
    p = plan(fp.compare(fp.Pair("o", "t", orders, drift.orders_tgt(orders))))
    lines = p.splitlines()
    joins = [x for x in lines if "SortMergeJoin" in x]
    exchanges = [x for x in lines if "Exchange hashpartitioning" in x]
    # one join, on the aggregate's own grouping columns; every shuffle is an
    # aggregate's (the totals branch reuses them), none hashed on join expressions
    assert len(joins) == 1 and "[_kn0" in joins[0]
    assert exchanges and all("_groupingexpression" in x for x in exchanges)


def test_latest_by_is_a_partial_aggregate_not_a_window(spark):
    p = plan(latest_by(read_table(spark, SF001, "events"), ["user_id"], ["ts", "event_id"]))
    assert "Window" not in p and "partial_max_by" in p


def test_scans_are_pruned_and_filters_pushed(spark, capsys):
    orders, customer = read_table(spark, SF001, "orders"), read_table(spark, SF001, "customer")
    workload.segment_revenue_last_day(orders, customer).explain("formatted")
    text = capsys.readouterr().out
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text
    assert "EqualTo(o_orderdate,ScalarSubquery" in text


def test_row_hash_has_no_text_formatting(spark):
    p = plan(with_row_hash(read_table(spark, SF001, "lineitem")).select("_h1", "_h2"))
    assert "md5" not in p and "concat" not in p and "xxhash64" in p
