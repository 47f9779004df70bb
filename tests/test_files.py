"""File sources and sinks (S4, S5, S7, S9-S12) and latest-per-key."""

import json
import os
import tempfile
import time

import pytest

from concord.sources import files, tables


def scratch():
    return tempfile.mkdtemp(prefix="concord-files-", dir="/tmp")


def test_load_pairs_csv_with_bom_and_json_forms(spark):
    d = scratch()
    header = ",".join(files.PAIR_FIELDS)
    with open(os.path.join(d, "pairs.csv"), "w", encoding="utf-8-sig") as fh:
        fh.write(header + "\n DEMO , sales_orders ,p,d,raw_sales_orders\n")
    rows = files.load_table_pairs(spark, os.path.join(d, "pairs.csv")).collect()
    assert [(r.oracle_schema, r.oracle_table, r.bigquery_table) for r in rows] == [("DEMO", "sales_orders", "raw_sales_orders")]
    row = dict(zip(files.PAIR_FIELDS, ["DEMO", "t", "p", "d", "bt"]))
    with open(os.path.join(d, "pairs.json"), "w") as fh:
        json.dump({"tables": [row]}, fh)
    assert files.load_table_pairs(spark, os.path.join(d, "pairs.json")).count() == 1
    with open(os.path.join(d, "list.json"), "w") as fh:
        json.dump([row, {**row, "bigquery_table": ""}], fh)
    with pytest.raises(ValueError, match="bigquery_table"):
        files.load_table_pairs(spark, os.path.join(d, "list.json"))
    assert files.load_table_pairs(spark, os.path.join(d, "list.json"), strict=False).count() == 1


def test_column_renames(spark):
    d = scratch()
    with open(os.path.join(d, "p.csv"), "w") as fh:
        fh.write("SRC_SCHEMA,SRC_TABLE,PROJECT,DATASET,TABLE\nS,T,P,D,X\n")
    cols = {"oracle_schema": "SRC_SCHEMA", "oracle_table": "SRC_TABLE", "bigquery_project": "PROJECT",
            "bigquery_dataset": "DATASET", "bigquery_table": "TABLE"}
    assert files.load_table_pairs(spark, os.path.join(d, "p.csv"), columns=cols).first().bigquery_table == "X"


def test_list_sql_scripts_non_recursive_case_insensitive(spark):
    d = scratch()
    for name, body in [("b.SQL", "select 2;"), ("a.sql", "select 1;"), ("notes.txt", "x")]:
        with open(os.path.join(d, name), "w") as fh:
            fh.write(body)
    os.makedirs(os.path.join(d, "sub"))
    with open(os.path.join(d, "sub", "c.sql"), "w") as fh:
        fh.write("select 3;")
    got = [(r.script_id, r.sql) for r in files.list_sql_scripts(spark, d).collect()]
    assert got == [("a", "select 1;"), ("b", "select 2;")]


def test_ingest_prefix_keeps_relative_paths(spark):
    d = scratch()
    os.makedirs(os.path.join(d, "x", "y"))
    for p in ["one.txt", "x/two.txt", "x/y/three.txt"]:
        with open(os.path.join(d, p), "w") as fh:
            fh.write(p)
    got = sorted(r.relative_path for r in files.ingest_prefix(spark, "file://" + d).collect())
    assert got == ["one.txt", "x/two.txt", "x/y/three.txt"]


def test_run_reports_newest_first_and_units(spark):
    d = scratch()
    for i, name in enumerate(["s1_bq", "s2_bq"]):
        os.makedirs(os.path.join(d, name))
        with open(os.path.join(d, name, f"run_report_{i}.json"), "w") as fh:
            json.dump({"script_id": name, "status": "validated", "units": [{"id": 1, "bq_sql": "select 1"}]}, fh)
        time.sleep(1.1)
    reps = files.run_reports(spark, d)
    assert [r.script_id for r in reps.orderBy("recency").collect()] == ["s2_bq", "s1_bq"]
    assert files.report_units(reps).count() == 2


def test_latest_by_breaks_ties_by_second_key(spark):
    df = spark.createDataFrame([(1, 10, 1, "a"), (1, 10, 2, "b"), (2, 5, 3, "c")], "k int, ts int, id int, v string")
    got = sorted((r.k, r.v) for r in files.latest_by(df, ["k"], ["ts", "id"]).collect())
    assert got == [(1, "b"), (2, "c")]


def test_load_counts_rows_and_skips_empty(spark):
    d = scratch()
    df = spark.range(5)
    assert tables.load(df, os.path.join(d, "t")) == 5
    assert tables.load(df, os.path.join(d, "t")) == 5
    assert spark.read.parquet(os.path.join(d, "t")).count() == 10  # appended
    assert tables.load(df.limit(0), os.path.join(d, "e")) == 0
    assert not os.path.exists(os.path.join(d, "e"))
    back = tables.materialize(df.selectExpr("id * 2 AS x"), os.path.join(d, "m"))
    assert sorted(r.x for r in back.collect()) == [0, 2, 4, 6, 8]


def test_parameterised_query(spark):
    spark.range(10).createOrReplaceTempView("nums")
    got = tables.run_query(spark, "SELECT count(*) AS n FROM nums WHERE id >= :lo AND id < :hi", {"lo": 3, "hi": 7})
    assert got.first().n == 4


def test_execute_script_runs_statements_in_order(spark):
    spark.range(10).createOrReplaceTempView("nums")
    got = tables.execute_script(spark, """
        DECLARE lo INT DEFAULT 3;
        CREATE OR REPLACE TEMPORARY VIEW big AS SELECT id FROM nums WHERE id >= lo;
        SELECT count(*) AS n FROM big;""")
    assert got.first().n == 7


def test_reachability_probe_and_listing(spark):
    spark.range(1).createOrReplaceTempView("present_t")
    assert tables.reachable(spark, "present_t") is True
    assert tables.reachable(spark, "absent_t") is False
    assert tables.catalog_listing(spark).where("table_name = 'present_t'").count() == 1


def test_where_equals(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "s string, t string")
    assert tables.where_equals(df, s="a", t=None).count() == 2
    assert tables.where_equals(df, s="a", t="y").count() == 1
    assert tables.where_equals(df).count() == 3


def test_csv_survives_quotes_commas_and_line_breaks_both_ways(spark, tmp_path):
    import csv

    from concord.operators import registry as reg

    notes = ['He said "x", ok', "two\nlines", "tab\tand; more", "plain", "  inner  spaces", 'ends with "']
    path = tmp_path / "registry.csv"
    with open(path, "w", newline="", encoding="utf-8-sig") as f:
        w = csv.DictWriter(f, fieldnames=reg.CSV_COLUMNS)
        w.writeheader()
        for i, n in enumerate(notes):
            w.writerow({c: "" for c in reg.CSV_COLUMNS} | {"oracle_schema": "demo\t", "oracle_table": f"T{i}", "status": "\tready", "notes": n})
    got = {r.source_table: r for r in reg.import_csv(spark, str(path)).collect()}
    assert [got[f"t{i}"].notes for i in range(len(notes))] == [n.strip() for n in notes]
    assert {(r.source_schema, r.status) for r in got.values()} == {("demo", "ready")}

    out = tmp_path / "out"
    reg.export_csv(reg.import_csv(spark, str(path)).selectExpr("*", "'' as created_at", "'' as updated_at").coalesce(1), str(out))
    rows = []
    for part in sorted(out.glob("part-*.csv")):
        with open(part, newline="", encoding="utf-8") as f:
            rows += list(csv.DictReader(f))
    assert [r["notes"] for r in sorted(rows, key=lambda r: r["oracle_table"])] == [n.strip() for n in notes]


def test_report_csv_is_read_back_by_csv(spark, tmp_path):
    import csv

    from concord.sources.files import load_table_pairs, write_report

    df = spark.createDataFrame([('a "q", b', "x\ny", None, "")], "p string, q string, r string, s string").coalesce(1)
    write_report(df, str(tmp_path / "rep"), "csv")
    with open(next((tmp_path / "rep").glob("part-*.csv")), newline="", encoding="utf-8") as f:
        assert list(csv.reader(f)) == [["p", "q", "r", "s"], ['a "q", b', "x\ny", "", ""]]
    pairs = tmp_path / "pairs.csv"
    with open(pairs, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["oracle_schema", "oracle_table", "bigquery_project", "bigquery_dataset", "bigquery_table"])
        w.writerow(["s", 'odd "name"', "p", "d", "with, comma"])
    got = load_table_pairs(spark, str(pairs)).first()
    assert (got.oracle_table, got.bigquery_table) == ('odd "name"', "with, comma")


def test_replicate_appends_a_catalog_table(spark, tmp_path):
    from concord.sources.tables import replicate

    spark.range(7).createOrReplaceTempView("concord_replicated")
    out = str(tmp_path / "copy")
    assert [replicate(spark, "concord_replicated", out) for _ in range(2)] == [7, 7]
    assert spark.read.parquet(out).count() == 14


def test_run_reports_are_ranked_newest_first(spark, tmp_path):
    import json
    import os

    from concord.sources.files import run_reports

    for i in range(3):
        folder = tmp_path / f"s{i}_bq"
        folder.mkdir()
        path = folder / f"run_report_{i}.json"
        path.write_text(json.dumps({"script_id": f"s{i}", "units": [{"id": 1}]}))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    got = {r.script_id: r.recency for r in run_reports(spark, str(tmp_path)).collect()}
    assert got == {"s2": 1, "s1": 2, "s0": 3}


def test_scripts_are_opened_once_and_others_not_at_all(spark, monkeypatch):
    d = scratch()
    for name in ("a.sql", "B.Sql", "c.txt"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write(f"select '{name}'")
    seen = []

    def stored(df, label, keep=files.stored):
        seen.extend(sorted(os.path.basename(f) for f in df.inputFiles()))
        return keep(df, label)

    monkeypatch.setattr(files, "stored", stored)
    found = files.list_sql_scripts(spark, d)
    assert seen == ["B.Sql", "a.sql"]
    for name in ("a.sql", "B.Sql"):
        os.remove(os.path.join(d, name))  # nothing is read from the folder again
    assert sorted((r.script_id, r.sql) for r in found.collect()) == [("B", "select 'B.Sql'"), ("a", "select 'a.sql'")]
