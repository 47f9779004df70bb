"""End-to-end jobs on the reference's audit fixture and on drifted driver tables."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from concord.plans import drift, jobs
from concord.sources.tables import read_table

SF001 = "/root/testdata/sf0.001"


def test_run_audit_from_a_correspondence_file(spark):
    src = spark.createDataFrame([(1, dt.date(2026, 6, 20), Decimal("10"), "x")],
                                "order_id int, order_date date, amount decimal(38,9), legacy_only string")
    tgt = spark.createDataFrame([(1, "2026-06-20", Decimal("10"), "y")],
                                "order_id int, order_date string, amount decimal(38,9), target_only string")
    tables = {"DEMO.sales_orders": src, "p.d.raw_sales_orders": tgt}
    d = tempfile.mkdtemp(prefix="concord-audit-", dir="/tmp")
    with open(os.path.join(d, "pairs.csv"), "w", encoding="utf-8-sig") as fh:
        fh.write("oracle_schema,oracle_table,bigquery_project,bigquery_dataset,bigquery_table\n")
        fh.write("DEMO,sales_orders,p,d,raw_sales_orders\nDEMO,missing,p,d,nowhere\n")

    def resolve(name):
        if name not in tables:
            raise LookupError(f"table not found: {name}")
        return tables[name]

    report, summary = jobs.run_audit(spark, os.path.join(d, "pairs.csv"), os.path.join(d, "out"), resolve,
                                     sample_rows=1000)
    status = {r.source_table: r.status for r in summary.collect()}
    assert status == {"DEMO.sales_orders": "blocked", "DEMO.missing": "blocked"}
    amount = report.where("column_key = 'amount'").first()
    assert amount.status == "compatible" and amount.source_sample_non_null == 1 and amount.target_sample_non_null == 1
    assert report.where("status = 'metadata_error'").count() == 1
    assert os.path.isdir(os.path.join(d, "out", "column_report_csv"))


def test_reconcile_catalog(spark):
    orders = read_table(spark, SF001, "orders")
    tables = {"orders": orders, "orders_tgt": drift.orders_tgt(orders), "orders_copy": orders}
    mapping = spark.createDataFrame([("orders", "orders_tgt"), ("orders", "orders_copy")],
                                    "source_table string, target_table string")
    parity, diffs, verdict = jobs.reconcile_catalog(spark, mapping, tables.__getitem__)
    assert {(r.target, r.matched) for r in parity.collect()} == {("orders_tgt", False), ("orders_copy", True)}
    assert {(r.target, r.status) for r in verdict.collect()} == {("orders_tgt", "flagged"), ("orders_copy", "validated")}
    assert diffs.where("target = 'orders_copy'").count() == 0


def test_cost_audit_from_a_run_report(spark):
    import json
    d = tempfile.mkdtemp(prefix="concord-cost-", dir="/tmp")
    report = {"script_id": "demo", "units": [
        {"id": 1, "order": 1, "statement_type": "DDL", "bq_sql": "CREATE OR REPLACE TABLE t AS SELECT * FROM raw_sales_orders"},
        {"id": 2, "order": 2, "statement_type": "DML", "bq_sql": "SELECT customer_id FROM raw_sales_orders WHERE amount > 0"},
        {"id": 3, "order": 3, "statement_type": "DML", "bq_sql": "   "}]}
    with open(os.path.join(d, "run_report_1.json"), "w") as fh:
        json.dump(report, fh)
    ranked, totals = jobs.cost_audit(spark, os.path.join(d, "run_report_1.json"))
    assert {r.query_id: r.rank for r in ranked.collect()} == {1: 1, 2: 2}
    assert totals.first().n_queries == 2


def _empty_registry(spark):
    from concord.operators import registry as reg
    return spark.createDataFrame([], reg.REGISTRY_SCHEMA)


def test_preflight_blocks_unknown_table_and_adds_pending_row(spark):
    scripts = spark.createDataFrame([("s", "SELECT * FROM missing_table;")], "script_id string, sql string")
    available = spark.createDataFrame([("sales_orders",)], "table_name string")
    reg_v2, verdict = jobs.preflight(spark, scripts, _empty_registry(spark), available, "demo", "2026-06-01")
    v = verdict.collect()
    assert [(r.source_table, r.verdict, r.can_run) for r in v] == [("missing_table", "unknown", False)]
    rows = reg_v2.where("source_table = 'missing_table'").collect()
    assert rows and rows[0].status == "pending"


def test_preflight_marks_seeded_tables_reachable(spark):
    sql = ("CREATE TABLE daily_revenue AS SELECT o.customer_id FROM sales_orders o "
           "JOIN customer_segments c ON c.customer_id = o.customer_id; SELECT * FROM daily_revenue;")
    scripts = spark.createDataFrame([("demo", sql)], "script_id string, sql string")
    legacy = spark.createDataFrame([("sales_orders", "raw_sales_orders"), ("customer_segments", "raw_customer_segments")],
                                   "source_table string, target_table string")
    available = spark.createDataFrame([(t,) for t in ["sales_orders", "customer_segments", "raw_sales_orders",
                                                      "raw_customer_segments"]], "table_name string")
    reg_v2, verdict = jobs.preflight(spark, scripts, _empty_registry(spark), available, "demo", "2026-06-01",
                                     legacy_mapping=legacy, project="p", dataset="d")
    got = {r.source_table: (r.verdict, r.can_run) for r in verdict.collect()}
    assert got == {"sales_orders": ("ready", True), "customer_segments": ("ready", True)}
    assert {r.source_table: r.status for r in reg_v2.collect()} == {"sales_orders": "ready", "customer_segments": "ready"}


def test_validate_units_flags_a_wrong_translation(spark):
    orders = read_table(spark, SF001, "orders")
    customer = read_table(spark, SF001, "customer")
    src = {"o": orders, "c": customer}
    tgt = {"o": orders.select("*"), "c": customer.select("*")}
    source_sql = ("SELECT c.c_mktsegment AS segment, SUM(NVL(o.o_totalprice, 0)) AS revenue, COUNT(*) AS n "
                  "FROM {o} o JOIN {c} c ON c.c_custkey = o.o_custkey GROUP BY c.c_mktsegment")
    good = source_sql.replace("NVL(", "COALESCE(")
    bad = good.replace("SUM(COALESCE(o.o_totalprice, 0))", "SUM(0)")
    diffs, verdict = jobs.validate_units(spark, [("1", source_sql, good), ("2", source_sql, bad)], src, tgt)
    got = {r.source: r.status for r in verdict.collect()}
    assert got == {"1": "validated", "2": "flagged"}
    assert {r.column_name for r in diffs.where("source = '2'").collect()} == {"revenue"}


def test_run_catalog_audit_from_rows(spark):
    cols_schema = ("table_ref string, column_name string, data_type string, is_nullable string, ordinal int, "
                   "length int, precision int, scale int")
    src = spark.createDataFrame([("S.T", "ID", "NUMBER(10)", "N", 1, None, None, None),
                                 ("S.T", "D", "DATE", "Y", 2, None, None, None),
                                 ("S.U", "X", "VARCHAR2(5)", "Y", 1, 5, None, None)], cols_schema)
    tgt = spark.createDataFrame([("p.d.t", "id", "INT64", "NO", 1, None, None, None),
                                 ("p.d.t", "d", "STRING", "YES", 2, None, None, None)], cols_schema)
    pairs = spark.createDataFrame([("S.T", "p.d.t"), ("S.U", "p.d.u")], "source_table string, target_table string")
    report, summary = jobs.run_catalog_audit(pairs, src, tgt)
    assert {r.column_key: r.status for r in report.where("source_table = 'S.T'").collect()} == \
        {"id": "compatible", "d": "type_mismatch"}
    assert {r.source_table: r.status for r in summary.collect()} == {"S.T": "blocked", "S.U": "blocked"}


def test_resolve_variables_by_form(spark):
    from test_scripts import DEMO
    spark.createDataFrame([(1, "2026-06-18", "x'y"), (2, "2026-06-20", "z")], "parcel_id int, picked_on string, tag string") \
        .createOrReplaceTempView("parcels")
    into = lambda what, tail: f"DECLARE v DATE; BEGIN SELECT {what} INTO v FROM parcels{tail}; END; /\nselect v from t"
    scripts = spark.createDataFrame([
        ("demo", DEMO), ("one", into("MAX(picked_on)", " WHERE parcel_id = 1")), ("two", into("MAX(picked_on)", " where parcel_id = 2")),
        ("none", into("MAX(picked_on)", " WHERE parcel_id = 9")), ("quoted", into("parcel_id", " WHERE tag = 'x''y'")),
        ("free", into("count(*)", " WHERE parcel_id > 0 AND tag <> 'q'"))], "script_id string, sql string")
    pure, variables = jobs.resolve_variables(spark, scripts)
    assert {(r.script_id, r.var_name): r.value for r in variables.collect()} == {
        ("demo", "v_cutoff"): "2026-06-18", ("one", "v"): "2026-06-18", ("two", "v"): "2026-06-20", ("none", "v"): None,
        ("quoted", "v"): "1", ("free", "v"): "2"}
    text = {r.script_id: r.sql for r in pure.collect()}
    assert "p.picked_on >= DATE '2026-06-18'" in text["demo"] and "DECLARE" not in text["demo"]
    assert text["none"].endswith("select NULL from t") and text["quoted"].endswith("select '1' from t")


def test_many_forms_have_no_cap(spark):
    spark.createDataFrame([(i, i % 3, f"n{i}") for i in range(9)], "a int, b int, s string").createOrReplaceTempView("small")
    tails = [f"{'(' * k}a >= {k}{')' * k} AND b = {k % 3} AND s <> 'n{k}'" for k in range(8)]
    scripts = spark.createDataFrame([(str(i), f"SELECT count(*) INTO v FROM small WHERE {t}; ") for i, t in enumerate(tails)], "script_id string, sql string")
    want = {str(i): str(spark.sql(f"SELECT count(*) FROM small WHERE {t}").first()[0]) for i, t in enumerate(tails)}
    assert {r.script_id: r.value for r in jobs.resolve_variables(spark, scripts)[1].collect()} == want


def test_literals_are_lifted(spark):
    from concord.operators.scripts import HOLE, lift_literals
    rows = ["WHERE a = 1 AND b <> 'it''s 5' OR c2 < 007.50", "where d >= DATE '2024-01-01' and x$3 = -2", "WHERE a = 1 ORDER BY 2", "",
            "WHERE t.k1 IN (3, 12345678901) AND n = 1e5 AND z LIKE 'ORDER 7'"]
    got = {r[0]: tuple(r)[1:] for r in spark.createDataFrame([(r,) for r in rows], "tail string").select("tail", *lift_literals(F.col("tail"))).collect()}
    assert got[rows[0]] == (f"WHERE a = {HOLE} AND b <> {HOLE} OR c2 < {HOLE}", ["INT", "STRING", "DECIMAL(3,2)"], ["1", "it's 5", "007.50"])
    assert got[rows[1]] == (f"where d >= {HOLE} and x$3 = -{HOLE}", ["DATE", "INT"], ["2024-01-01", "2"])
    assert got[rows[2]] == (rows[2], [], []) and got[""] == ("", [], [])
    assert got[rows[4]] == (f"WHERE t.k1 IN ({HOLE}, {HOLE}) AND n = 1e5 AND z LIKE {HOLE}", ["INT", "BIGINT", "STRING"], ["3", "12345678901", "ORDER 7"])


def test_variables_of_several_conditions(spark):
    spark.createDataFrame([(i % 20, i % 7, float(i), None if i % 5 == 0 else f"g{i % 3}") for i in range(300)],
                          "k int, q int, x double, g string").createOrReplaceTempView("facts")
    tails = [f"WHERE k = {k} AND q > {q}" for k in range(0, 25, 3) for q in (0, 3, 9)]
    tails += [f"WHERE facts.g = 'g{j}' AND (q = {j} OR NOT k < {10 * j})" for j in range(4)] + ["WHERE g IS NULL AND x BETWEEN 5 AND 60.5", "", "WHERE q = 2 HAVING count(*) > 3"]
    for expr in ("count(*)", "max(x)", "sum(k)", "x"):
        scripts = spark.createDataFrame([(t or "-", f"SELECT {expr} INTO v FROM facts {t};") for t in tails], "script_id string, sql string")
        ask = expr if expr != "x" else "min(x)"
        want = {t or "-": spark.sql(f"SELECT CAST({ask} AS STRING) FROM facts {t}").first()[0] for t in tails}
        assert {r.script_id: r.value for r in jobs.resolve_variables(spark, scripts)[1].collect()} == want


def test_variables_compare_as_the_engine_does(spark):
    spark.sql("""SELECT 5 AS id, CAST(10 AS DECIMAL(12,2)) AS price, 10.0D AS d, CAST(0.1 AS FLOAT) AS f, TIMESTAMP '2024-01-01 00:00:00' AS ts,
                 DATE '2024-01-01' AS day, '7' AS tag, 'hit' AS v UNION ALL
                 SELECT 7, 0.5, 0.1D, CAST(2 AS FLOAT), TIMESTAMP '2024-02-01 10:00:00', DATE '2024-02-01', '5', 'other'""").createOrReplaceTempView("typed")
    tails = ["price = 10", "price = 10.000", "price = +10", "price = 10.001", "price = .5", "d = 10", "d = 0.1", "f = 0.1", "f = 2", "id = +5", "id = 007",
             "id = 5.0", "id = 5.5", "id = '5'", "ts = '2024-01-01'", "ts = '2024-02-01 10:00:00'", "day = '2024-01-01'", "tag = 7", "tag = '7'",
             "price = '10'", "id = -5", "id = 99999999999999999999999"]
    scripts = spark.createDataFrame([(t, f"DECLARE v DATE; BEGIN SELECT max(v) INTO x FROM typed WHERE {t}; END; /\nselect x from t") for t in tails],
                                    "script_id string, sql string")
    want = {t: spark.sql(f"SELECT max(v) FROM typed WHERE {t}").first()[0] for t in tails}
    assert {r.script_id: r.value for r in jobs.resolve_variables(spark, scripts)[1].collect()} == want
    assert want["price = 10"] == want["id = +5"] == want["ts = '2024-01-01'"] == "hit"
