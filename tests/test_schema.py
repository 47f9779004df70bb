"""Schema audit (A1-A9), type families (A2) and conformance."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from concord.functions.types import family_of_type, numeric_shape_of_name, type_family
from concord.operators import conform as cf
from concord.operators import schema_audit as sa
from pyspark.sql.types import ArrayType, DayTimeIntervalType, IntegerType, StringType

CASES = [("VARCHAR2(20)", "text"), ("NUMBER(10,2)", "numeric"), ("TIMESTAMP(6)", "temporal"), ("DATE", "temporal"),
         ("BOOL", "boolean"), ("BYTES", "bytes"), ("RECORD", "complex"), ("JSON", "json"),
         # quirks of the ordered substring rule, kept on purpose
         ("INTERVAL DAY", "numeric"), ("POINT", "numeric"), ("ARRAY<STRING>", "text"), ("STRUCT<a INT64>", "numeric"),
         ("BINARY_DOUBLE", "numeric"), ("LONG", "long"), ("", "unknown"), ("  geography ", "geography"),
         ("\tgeography\r\n", "geography"), ("\u00a0\n", "unknown")]


@pytest.mark.parametrize("raw,family", CASES)
def test_type_family_rule(spark, raw, family):
    got = spark.createDataFrame([(raw,)], "t string").select(type_family(F.col("t")).alias("f")).first().f
    assert got == family


def test_structural_family_and_shapes():
    assert family_of_type(ArrayType(StringType())) == "complex"
    assert family_of_type(DayTimeIntervalType()) == "interval"
    assert family_of_type(IntegerType()) == "numeric"
    assert numeric_shape_of_name("numeric") == (38, 9)
    assert numeric_shape_of_name("BIGNUMERIC") == (76, 38)
    assert numeric_shape_of_name("INT64") == (19, 0)
    assert numeric_shape_of_name("FLOAT64") == (None, None)


def _audit(spark, pairs):
    meta, errors = sa.column_metadata(spark, pairs)
    return sa.compare_columns(meta, errors)


def test_column_statuses_and_table_verdict(spark):
    src = spark.createDataFrame([(1, dt.date(2026, 6, 20), Decimal("10"), "x")],
                                "order_id int, order_date date, amount decimal(38,9), legacy_only string")
    tgt = spark.createDataFrame([(1, "2026-06-20", Decimal("10"), "y")],
                                "order_id int, order_date string, amount decimal(38,9), target_only string")
    rep = _audit(spark, [sa.AuditPair("sales_orders", "raw_sales_orders", lambda: src, lambda: tgt)])
    status = {r.column_key: r.status for r in rep.collect()}
    assert status == {"order_id": "compatible", "amount": "compatible", "order_date": "type_mismatch",
                      "legacy_only": "missing_target", "target_only": "extra_target"}
    summary = sa.summarize_tables(rep).first()
    assert (summary.total_columns, summary.error_columns, summary.warning_columns, summary.status) == (5, 2, 1, "blocked")
    gate = sa.column_gate(rep).first()
    assert gate.blocking_columns == 3 and gate.can_run is False  # extra_target blocks the strict gate


def test_shape_warnings(spark):
    src = spark.createDataFrame([], "a decimal(20,4), b bigint, c string, d int")
    tgt = spark.createDataFrame([], "a decimal(12,2), b int, c string, d int")
    rep = {r.column_key: r for r in _audit(spark, [sa.AuditPair("s", "t", lambda: src, lambda: tgt)]).collect()}
    assert rep["a"].status == "compatible_with_warnings"
    assert rep["a"].notes == ("target precision 12 is lower than source precision 20; "
                              "target scale 2 is lower than source scale 4")
    assert rep["b"].status == "compatible_with_warnings"
    assert rep["c"].status == "compatible" and rep["d"].status == "compatible"


def test_case_insensitive_alignment(spark):
    src = spark.createDataFrame([], "Order_ID int")
    tgt = spark.createDataFrame([], "order_id int")
    rep = _audit(spark, [sa.AuditPair("s", "t", lambda: src, lambda: tgt)]).collect()
    assert [(r.column_key, r.status) for r in rep] == [("order_id", "compatible")]


def test_metadata_error_does_not_stop_other_pairs(spark):
    good = spark.createDataFrame([], "a int")

    def broken():
        return spark.read.parquet("/nonexistent/concord/table")

    rep = _audit(spark, [sa.AuditPair("ok", "ok", lambda: good, lambda: good),
                         sa.AuditPair("bad", "bad", broken, lambda: good)])
    rows = {r.source_table: r for r in rep.collect()}
    assert rows["ok"].status == "compatible"
    assert rows["bad"].status == "metadata_error" and rows["bad"].severity == "error" and rows["bad"].notes
    verdicts = {r.source_table: r.status for r in sa.summarize_tables(rep).collect()}
    assert verdicts == {"ok": "compatible", "bad": "blocked"}


def test_pair_without_columns_is_compatible(spark):
    rep = spark.createDataFrame([], sa.compare_columns(*sa.column_metadata(spark, [])).schema)
    pairs = spark.createDataFrame([("s", "t")], "source_table string, target_table string")
    assert sa.summarize_tables(rep, pairs).first().status == "compatible"


def test_sample_evidence_counts_and_first_distinct_values(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5.5, "a"), (3, None, "b"), (4, 7.0, "c"), (5, 1.0, "d")],
                               "id int, amount double, s string")
    ev = {r.column_key: (r.non_null, r.example_values) for r in sa.sample_evidence(df, ["id"], limit=4).collect()}
    assert ev["amount"] == (2, '["5.5","7.0"]')
    assert ev["s"] == (4, '["a","b","c"]')


def test_conform_coerces_and_drops(spark):
    df = spark.createDataFrame([(1, 1.5, 1.0, "x"), (2, 2.5, 0.0, "y")],
                               "id bigint, amount double, flag double, extra_col string")
    res = cf.conform(df, [("id", "INTEGER"), ("amount", "STRING"), ("flag", "BOOL")])
    assert res.ok is True
    assert res.frame.columns == ["id", "amount", "flag"]
    rows = res.frame.orderBy("id").collect()
    assert [r.amount for r in rows] == ["1.5", "2.5"] and [r.flag for r in rows] == [True, False]


def test_conform_flags_incompatible_type_and_keeps_column(spark):
    df = spark.createDataFrame([(1.1,), (2.2,)], "weird double")
    res = cf.conform(df, [("weird", "DATE")])
    assert res.ok is False and "weird" in res.frame.columns


def test_conform_lenient_datetime(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 1, 1),)], "snapshot_date timestamp_ntz")
    assert cf.conform(df, [("snapshot_date", "DATETIME")], lenient_datetime_columns=["snapshot_date"]).ok is True
    assert cf.conform(df, [("snapshot_date", "STRING")], lenient_datetime_columns=["snapshot_date"]).ok is False


def test_conform_bool_needs_zero_one_and_text_to_number_counts_failures(spark):
    df = spark.createDataFrame([(2.0, "7"), (0.0, "x"), (None, None)], "f double, n string")
    res = cf.conform(df, [("f", "BOOL"), ("n", "INT64"), ("missing", "STRING")], fill_missing=True)
    assert res.ok is False  # 2.0 is not 0/1
    rows = res.frame.collect()
    assert sorted([r.n for r in rows], key=repr) == sorted([7, None, None], key=repr)
    assert res.frame.columns == ["f", "n", "missing"]
    assert res.failure_counts() == {"n": 1}
    ok = cf.conform(spark.createDataFrame([(1.0,), (None,)], "f double"), [("f", "BOOL")])
    assert ok.ok and [r.f for r in ok.frame.collect()] == [True, False]  # NULL becomes false


def test_samples_attach_without_changing_status(spark):
    src = spark.createDataFrame([(1, Decimal("10"), "x")], "order_id int, amount decimal(38,9), legacy_only string")
    tgt = spark.createDataFrame([(1, Decimal("10"))], "order_id int, amount decimal(38,9)")
    rep = _audit(spark, [sa.AuditPair("s", "t", lambda: src, lambda: tgt)])
    full = sa.attach_samples(rep, sa.pair_samples(src, "s", "t", ["order_id"]), sa.pair_samples(tgt, "s", "t", ["order_id"]))
    rows = {r.column_key: r for r in full.collect()}
    assert rows["amount"].source_sample_non_null == 1 and rows["amount"].target_sample_non_null == 1
    assert rows["legacy_only"].target_sample_non_null is None and rows["legacy_only"].target_sample_values == ""
    assert {k: r.status for k, r in rows.items()} == {r.column_key: r.status for r in rep.collect()}


def test_gate_ignores_shape_warnings_but_blocks_extra_columns(spark):
    src = spark.createDataFrame([], "a decimal(20,4)")
    narrow = spark.createDataFrame([], "a decimal(12,2)")
    extra = spark.createDataFrame([], "a decimal(20,4), b int")
    rep = _audit(spark, [sa.AuditPair("s", "narrow", lambda: src, lambda: narrow),
                         sa.AuditPair("s", "extra", lambda: src, lambda: extra)])
    gate = {r.target_table: r.can_run for r in sa.column_gate(rep).collect()}
    assert gate == {"narrow": True, "extra": False}


def test_sample_values_render_like_python_str(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, flag boolean")
    ev = {r.column_key: r.example_values for r in sa.sample_evidence(df, ["id"]).collect()}
    assert ev["flag"] == '["True","False"]'


def test_declared_metadata_from_information_schema_rows(spark):
    cols_schema = ("table_ref string, column_name string, data_type string, is_nullable string, ordinal int, "
                   "length int, precision int, scale int")
    src_cols = spark.createDataFrame([
        ("DEMO.SALES", "AMOUNT", "NUMBER(20,4)", "Y", 1, None, None, None),
        ("DEMO.SALES", "NAME", "VARCHAR2(50)", "N", 2, 50, None, None)], cols_schema)
    tgt_cols = spark.createDataFrame([
        ("p.d.sales", "amount", "NUMERIC", "YES", 1, None, None, None),
        ("p.d.sales", "name", "STRING", "NO", 2, 20, None, None)], cols_schema)
    pairs = spark.createDataFrame([("DEMO.SALES", "p.d.sales")], "source_table string, target_table string")
    meta = sa.declared_metadata(src_cols, pairs, "source").unionByName(sa.declared_metadata(tgt_cols, pairs, "target"))
    rep = {r.column_key: r for r in sa.compare_columns(meta).collect()}
    assert (rep["amount"].source_precision, rep["amount"].target_precision, rep["amount"].target_scale) == (20, 38, 9)
    assert rep["amount"].status == "compatible"  # 38 >= 20 and scale 9 >= 4
    assert rep["name"].status == "compatible_with_warnings"
    assert rep["name"].notes == "target length 20 is lower than source length 50"


def test_fractions_are_not_truncated(spark):
    from concord.operators import conform as cf

    df = spark.createDataFrame([(1.0, 2.5), (1.7, 3.0), (None, 1e30), (float("nan"), -4.0)], "a double, b double")
    result = cf.conform(df, [("a", "INTEGER"), ("b", "INTEGER")])
    assert sorted(map(tuple, result.frame.collect()), key=repr) == sorted([(1, None), (None, 3), (None, None), (None, -4)], key=repr)
    assert result.failure_counts() == {"a": 2, "b": 2}
    audit = {r.column_name: (r.n_failed, r.table_ok) for r in cf.conformance_audit(df, [("a", "INTEGER"), ("b", "INTEGER")]).collect()}
    assert audit == {"a": (2, True), "b": (2, True)}


def test_pairs_outside_the_catalog_are_metadata_errors(spark):
    from concord.plans import jobs

    cols = "table_ref string, column_name string, data_type string, is_nullable string, ordinal int, length int, precision int, scale int"
    src = spark.createDataFrame([("a", "id", "INT", "NO", 1, None, None, None)], cols)
    pairs = spark.createDataFrame([("a", "b"), ("x", "b"), ("x", "y")], "source_table string, target_table string")
    report, summary = jobs.run_catalog_audit(pairs, src, src.withColumn("table_ref", F.lit("b")),
                                             readable=spark.createDataFrame([("a",), ("b",)], "table_ref string"))
    assert sorted((r.source_table, r.target_table, r.status, r.notes) for r in report.collect()) == [
        ("a", "b", "compatible", ""), ("x", "b", "metadata_error", "not in the catalog: source"),
        ("x", "y", "metadata_error", "not in the catalog: source, target")]
    assert {r.status for r in summary.where("source_table = 'x'").collect()} == {"blocked"}
