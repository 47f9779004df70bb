"""Registry (T1-T8), readiness gate (A10) and CSV round trip."""

import os
import tempfile

from pyspark.sql import functions as F

from concord.operators import registry as reg

T0, T1 = "2026-01-01T00:00:00+00:00", "2026-06-01T00:00:00+00:00"


def empty(spark):
    return spark.createDataFrame([], reg.REGISTRY_SCHEMA)


def one(spark, **kw):
    base = dict(source_schema="demo", source_table="sales_orders")
    base.update(kw)
    cols = list(base)
    return spark.createDataFrame([tuple(base[c] for c in cols)], ", ".join(
        f"{c} {'boolean' if c.endswith('_reachable') else 'string'}" for c in cols))


def test_upsert_keeps_created_at_and_lowercases(spark):
    r = reg.upsert(empty(spark), one(spark, source_schema="DEMO", source_table="Sales_Orders", target_table="RAW"), F.lit(T0))
    r2 = reg.upsert(r, one(spark, target_table="raw_v2", status="ready"), F.lit(T1)).collect()
    assert len(r2) == 1
    x = r2[0]
    assert (x.source_schema, x.source_table, x.target_table, x.status) == ("demo", "sales_orders", "raw_v2", "ready")
    assert (x.created_at, x.updated_at) == (T0, T1)


def test_seed_only_inserts_absent_keys_as_ready(spark):
    r = reg.upsert(empty(spark), one(spark, target_table="mine", status="blocked"), F.lit(T0))
    m = spark.createDataFrame([("sales_orders", "raw_sales_orders"), ("customer_segments", "raw_customer_segments")],
                              "source_table string, target_table string")
    got = {x.source_table: (x.target_table, x.status) for x in reg.seed(r, m, "demo", "p", "d", F.lit(T1)).collect()}
    assert got == {"sales_orders": ("mine", "blocked"), "customer_segments": ("raw_customer_segments", "ready")}


def test_unknown_source_becomes_pending(spark):
    req = spark.createDataFrame([("demo", "missing_table")], "source_schema string, source_table string")
    got = reg.ensure_pending(empty(spark), req, F.lit(T0)).collect()
    assert [(x.source_table, x.status, x.target_table) for x in got] == [("missing_table", "pending", "")]


def test_reachability_state_machine_and_sticky_flags(spark):
    r = reg.upsert(empty(spark), one(spark, target_table="t", status="ready", source_reachable=True,
                                     target_reachable=True), F.lit(T0))
    obs = spark.createDataFrame([("demo", "sales_orders", False, False)],
                                "source_schema string, source_table string, source_probe boolean, target_probe boolean")
    sticky = reg.update_reachability(r, obs, F.lit(T1)).first()
    assert sticky.status == "ready" and sticky.source_reachable  # cached true is kept
    recheck = reg.update_reachability(r, obs, F.lit(T1), recheck=True).first()
    assert recheck.status == "blocked" and recheck.source_checked_at == T1
    pend = reg.upsert(empty(spark), one(spark, status="pending"), F.lit(T0))
    obs2 = spark.createDataFrame([("demo", "sales_orders", True, True)], obs.schema)
    assert reg.update_reachability(pend, obs2, F.lit(T1)).first().status == "pending"  # no target table


def test_layered_mapping_later_layer_wins(spark):
    a = spark.createDataFrame([("x", "a1"), ("y", "a2")], "source_table string, target_table string")
    b = spark.createDataFrame([("y", "b2")], a.schema)
    c = spark.createDataFrame([("z", "scratch_z")], a.schema)
    got = {r.source_table: (r.target_table, r.layer) for r in reg.layered_mapping(
        [("legacy", a), ("registry", b), ("intermediate", c)]).collect()}
    assert got == {"x": ("a1", "legacy"), "y": ("b2", "registry"), "z": ("scratch_z", "intermediate")}


def test_replace_columns(spark):
    cols = spark.createDataFrame([("demo", "t", "a"), ("demo", "t", "b"), ("demo", "u", "a")],
                                 "source_schema string, source_table string, source_column string")
    new = spark.createDataFrame([("demo", "t", "c")], cols.schema)
    got = sorted(tuple(r) for r in reg.replace_columns(cols, new).collect())
    assert got == [("demo", "t", "c"), ("demo", "u", "a")]


def test_csv_round_trip_and_import_rules(spark):
    r = reg.upsert(empty(spark), one(spark, target_table="raw", status="ready", source_reachable=True,
                                     target_reachable=False, notes="n"), F.lit(T0))
    out = tempfile.mkdtemp(prefix="concord-reg-", dir="/tmp")
    reg.export_csv(r.coalesce(1), os.path.join(out, "reg"))
    back = reg.import_csv(spark, os.path.join(out, "reg")).collect()
    assert len(back) == 1
    b = back[0]
    assert (b.source_table, b.status, b.source_reachable, b.target_reachable) == ("sales_orders", "ready", True, False)
    path = os.path.join(out, "template.csv")
    with open(path, "w", encoding="utf-8-sig") as fh:  # BOM, messy values, a keyless row
        fh.write(",".join(reg.CSV_COLUMNS) + "\n")
        fh.write(" DEMO , Sales_Orders ,p,d, RAW_Sales ,,Yes,,n,,example row\n")
        fh.write(",,p,d,x,ready,1,,1,,skipped\n")
    rows = reg.import_csv(spark, path).collect()
    assert len(rows) == 1
    x = rows[0]
    assert (x.source_schema, x.source_table, x.target_table, x.status, x.source_reachable, x.target_reachable) == \
        ("demo", "sales_orders", "raw_sales", "pending", True, False)


def test_readiness_gate(spark):
    r = reg.upsert(empty(spark), one(spark, target_table="t", status="ready", source_reachable=True,
                                     target_reachable=True), F.lit(T0))
    req = spark.createDataFrame([("demo", "sales_orders"), ("demo", "unknown_one")], "source_schema string, source_table string")
    got = {x.source_table: (x.verdict, x.can_run) for x in reg.readiness(req, r).collect()}
    assert got == {"sales_orders": ("ready", False), "unknown_one": ("unknown", False)}
    only = reg.readiness(req.where(F.col("source_table") == "sales_orders"), r).first()
    assert only.can_run is True
    cols = spark.createDataFrame([("demo", "sales_orders", "type_mismatch")],
                                 "source_schema string, source_table string, compatibility_status string")
    assert reg.readiness(req, r, cols).where(F.col("source_table") == "sales_orders").first().verdict == "schema_blocked"


def test_template_imports_as_one_row(spark):
    out = tempfile.mkdtemp(prefix="concord-tpl-", dir="/tmp")
    reg.template_frame(spark).coalesce(1).write.option("header", True).csv(os.path.join(out, "tpl"))
    rows = reg.import_csv(spark, os.path.join(out, "tpl")).collect()
    assert len(rows) == 1 and rows[0].source_table == "invoices" and rows[0].status == "pending"
    merged = reg.upsert(empty(spark), reg.import_csv(spark, os.path.join(out, "tpl")), F.lit(T0))
    assert merged.count() == 1


def test_upsert_applies_several_updates_of_a_key_in_order(spark):
    ups = spark.createDataFrame([("demo", "T", "first", 1), ("demo", "t", "second", 2)],
                                "source_schema string, source_table string, target_table string, seq int")
    got = reg.upsert(empty(spark), ups, F.lit(T0), order="seq").collect()
    assert [(r.source_table, r.target_table) for r in got] == [("t", "second")]


def test_audit_report_feeds_the_column_registry_and_the_gate(spark):
    from concord.operators import schema_audit as sa
    src = spark.createDataFrame([], "id int, amount decimal(20,4), note string")
    tgt = spark.createDataFrame([], "id int, amount decimal(12,2)")
    meta, errors = sa.column_metadata(spark, [sa.AuditPair("sales_orders", "raw_sales_orders", lambda: src, lambda: tgt)])
    rows = reg.column_rows(sa.compare_columns(meta, errors), "demo", F.lit(T1))
    got = {r.source_column: r.compatibility_status for r in rows.collect()}
    assert got == {"id": "compatible", "amount": "compatible", "note": "missing_target"}
    r = reg.upsert(empty(spark), one(spark, target_table="raw_sales_orders", status="ready", source_reachable=True,
                                     target_reachable=True), F.lit(T0))
    cols = reg.replace_columns(spark.createDataFrame([], reg.COLUMN_REGISTRY_SCHEMA), rows)
    req = spark.createDataFrame([("demo", "sales_orders")], "source_schema string, source_table string")
    assert reg.readiness(req, r, cols).first().verdict == "schema_blocked"
