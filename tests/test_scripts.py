"""Script corpora (X1-X5): split, classify, extract, translate, variables."""

from pyspark.sql import functions as F

from concord.operators import scripts as scr

# A variable block, a CTAS with NVL and TRUNC and a join, and a query over its result.
DEMO = """DECLARE
  v_cutoff DATE;
BEGIN
  SELECT MIN(picked_on) INTO v_cutoff FROM parcels;
END;
/

create table depot_load as
select p.depot_id, d.zone, TRUNC(p.picked_on) as pick_day, sum(NVL(p.weight_kg, 0)) as kilos
from parcels p join depots d on d.depot_id = p.depot_id
where p.picked_on >= v_cutoff group by p.depot_id, d.zone, TRUNC(p.picked_on);

select zone, max(kilos) as heaviest from depot_load group by zone;
"""


def units_of(spark, text):
    df = spark.createDataFrame([("s", text)], "script_id string, sql string")
    return [r.statement for r in scr.split_units(df).orderBy("unit_id").collect()]


def test_split_respects_quotes_escapes_and_tail(spark):
    assert units_of(spark, "a; b;; c") == ["a", "b", "c"]
    assert units_of(spark, "select 'x;y' from t; select 'it''s; ok' from u") == \
        ["select 'x;y' from t", "select 'it''s; ok' from u"]
    assert units_of(spark, "a ';b; c") == ["a ';b; c"]  # unterminated quote runs to the end
    assert units_of(spark, "  ;\n ; ") == []


def test_classify_extract(spark):
    df = spark.createDataFrame([
        ("  create table A.B_x as select * from `proj.ds.Src` join \"Dim\" d on 1=1 join src s",),
        ("insert into t select * from x",), ("\n select 1",), ("with q as (select 1) select * from q",)],
        "statement string")
    rows = df.select(scr.classify(F.col("statement")).alias("k"), scr.sources_of(F.col("statement")).alias("s"),
                     scr.targets_of(F.col("statement")).alias("t")).collect()
    assert [r.k for r in rows] == ["DDL", "DML", "SELECT", "SQL"]
    assert rows[0].s == ["src", "dim"] and rows[0].t == ["b_x"]
    assert rows[1].t == []  # INSERT targets are not extracted


def test_materialize_and_build_units_on_demo_script(spark):
    scripts = spark.createDataFrame([("demo", DEMO)], "script_id string, sql string")
    variables = spark.createDataFrame([("demo", "V_CUTOFF", "2026-06-20")], "script_id string, var_name string, value string")
    pure = scr.materialize_variables(scripts, variables).first().sql
    assert "DECLARE" not in pure and "p.picked_on >= DATE '2026-06-20'" in pure
    u = scr.build_units(scr.materialize_variables(scripts, variables)).orderBy("unit_id").collect()
    assert [x.statement_type for x in u] == ["DDL", "SELECT"]
    assert u[0].sources == ["parcels", "depots"] and u[0].targets == ["depot_load"]
    assert u[1].sources == ["depot_load"]
    found = scr.select_into(scripts).first()
    assert (found.var_name, found.expr, found.table_name) == ("v_cutoff", "MIN(picked_on)", "parcels")


def test_sql_literal(spark):
    df = spark.createDataFrame([(None,), ("2026-06-20",), ("O'Brien",)], "v string")
    assert [r.l for r in df.select(scr.sql_literal(F.col("v")).alias("l")).collect()] == \
        ["NULL", "DATE '2026-06-20'", "'O''Brien'"]


def test_translate(spark):
    units = spark.createDataFrame([
        ("s", 1, "CREATE TABLE Daily_Revenue AS SELECT SUM(NVL(o.amount, 0)), TRUNC (o.d) FROM Sales_Orders o "
                 "JOIN sales_orders_hist h ON 1=1")], "script_id string, unit_id int, statement string")
    mapping = spark.createDataFrame([("sales_orders", "raw_sales_orders"), ("daily_revenue", "daily_revenue_bq")],
                                    "source_name string, target_name string")
    got = scr.translate(units, mapping).first().translated
    assert got == ("CREATE OR REPLACE TABLE daily_revenue_bq AS SELECT SUM(COALESCE(o.amount, 0)), DATE(o.d) "
                   "FROM raw_sales_orders o JOIN sales_orders_hist h ON 1=1")


def test_translate_rewrites_every_ctas_with_its_own_name(spark):
    units = spark.createDataFrame([("s", 1, "create table A_1 as select 1; CREATE  TABLE B$x AS select 2")],
                                  "script_id string, unit_id int, statement string")
    mapping = spark.createDataFrame([], "source_name string, target_name string")
    got = scr.translate(units, mapping).first().translated
    assert got == "CREATE OR REPLACE TABLE a_1 AS select 1; CREATE OR REPLACE TABLE b$x AS select 2"


def test_longest_name_with_dots_and_dollars_wins(spark):
    units = spark.createDataFrame([("s", 1, "select * from demo.sales_orders o, Ord$Stg x, sales_orders y, demo.other, a.sales_orders, resales_orders")],
                                  "script_id string, unit_id int, statement string")
    mapping = spark.createDataFrame([("sales_orders", "S"), ("demo.sales_orders", "p.d.long_name"), ("ord$stg", "stage$1\\x"), ("ord", "no")],
                                    "source_name string, target_name string")
    assert scr.translate(units, mapping).first().translated == (
        "select * from p.d.long_name o, stage$1\\x x, S y, demo.other, a.S, resales_orders")


def test_many_names_take_the_shuffled_path(spark, monkeypatch):
    monkeypatch.setattr(scr, "BROADCAST_NAMES", 3)
    rows = [("s", i, f"select t{i % 50}.x from hot join t{i % 50}") for i in range(300)]
    units = spark.createDataFrame(rows, "script_id string, unit_id int, statement string")
    mapping = spark.createDataFrame([(f"T{i}", f"u{i}") for i in range(50)] + [("hot", "cold")], "source_name string, target_name string")
    got = {r.unit_id: r.translated for r in scr.translate(units, mapping).collect()}
    assert got == {i: f"select u{i % 50}.x from cold join u{i % 50}" for i in range(300)}


def test_many_names_only_words_that_may_be_names_are_kept(spark, monkeypatch):
    monkeypatch.setattr(scr, "BROADCAST_NAMES", 3)
    kept = []

    def seen(df, label, keep=scr.stored):
        out = keep(df, label)
        kept.append((label, out.count()))
        return out

    monkeypatch.setattr(scr, "stored", seen)
    units = spark.range(40).selectExpr("CAST(id AS STRING) AS script_id", "1 AS unit_id", "concat('select a, b, c, d, e, f, g, h from T', id, ' join t', id + 1, ' using (k)') AS statement")
    names = spark.range(0, 20).selectExpr("concat('t', id) AS source_name", "concat('new', id) AS target_name")
    got = {r.script_id: r.translated for r in scr.translate(units, names).collect()}
    name = lambda i, old: f"new{i}" if i < 20 else f"{old}{i}"
    assert got == {str(i): f"select a, b, c, d, e, f, g, h from {name(i, 'T')} join {name(i + 1, 't')} using (k)" for i in range(40)}
    assert ("texts", 40) in kept  # made once
    assert dict(kept)["words"] < 40 * 14 // 3
