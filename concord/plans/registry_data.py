"""Registry versions derived from the driver tables (one correspondence per customer).

Each customer ``k`` is a source table ``cust_k`` in schema ``demo`` mapped to
``customer_k``; its balance decides status and reachability, so the registry
grows with the data. Suppliers supply new keys for upserts and seeds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CREATED = "2026-01-01T00:00:00+00:00"
NOW = "2026-06-01T00:00:00+00:00"
CUSTOMER_COLUMNS = [("c_custkey", "BIGINT"), ("c_name", "STRING"), ("c_nationkey", "INT"), ("c_acctbal", "DOUBLE"),
                    ("c_mktsegment", "STRING")]


def _k(c: str) -> F.Column:
    return F.col(c).cast("string")


def base_registry(customer: DataFrame, nation: DataFrame) -> DataFrame:
    c = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    bal = F.col("c_acctbal")
    return c.select(
        F.lit("demo").alias("source_schema"), F.concat(F.lit("cust_"), _k("c_custkey")).alias("source_table"),
        F.lit("wh").alias("target_project"), F.lower("n_name").alias("target_dataset"),
        F.when(bal >= 0, F.concat(F.lit("customer_"), _k("c_custkey"))).otherwise(F.lit("")).alias("target_table"),
        F.when(bal >= 5000, "ready").when(bal >= 0, "pending").otherwise("blocked").alias("status"),
        (bal >= 1000).alias("source_reachable"),
        F.when(bal >= 1000, F.lit(CREATED)).otherwise(F.lit("")).alias("source_checked_at"),
        (bal >= 2000).alias("target_reachable"),
        F.when(bal >= 2000, F.lit(CREATED)).otherwise(F.lit("")).alias("target_checked_at"),
        F.col("c_mktsegment").alias("notes"), F.lit(CREATED).alias("created_at"), F.lit(CREATED).alias("updated_at"))


def upsert_updates(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    fixed = customer.where(F.col("c_acctbal") < 0).select(
        F.lit("demo").alias("source_schema"), F.concat(F.lit("cust_"), _k("c_custkey")).alias("source_table"),
        F.lit("wh").alias("target_project"), F.lit("fixed").alias("target_dataset"),
        F.concat(F.lit("customer_fix_"), _k("c_custkey")).alias("target_table"), F.lit("ready").alias("status"),
        F.lit(True).alias("source_reachable"), F.lit(False).alias("target_reachable"), F.lit("fixed").alias("notes"))
    new = supplier.select(
        F.lit("demo").alias("source_schema"), F.concat(F.lit("supp_"), _k("s_suppkey")).alias("source_table"),
        F.lit("wh").alias("target_project"), F.lit("suppliers").alias("target_dataset"),
        F.concat(F.lit("supplier_"), _k("s_suppkey")).alias("target_table"), F.lit("pending").alias("status"),
        F.lit(False).alias("source_reachable"), F.lit(False).alias("target_reachable"), F.col("s_name").alias("notes"))
    return fixed.unionByName(new)


def seed_mapping(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    s = supplier.select(F.concat(F.lit("supp_"), _k("s_suppkey")).alias("source_table"),
                        F.concat(F.lit("supplier_"), _k("s_suppkey")).alias("target_table"))
    c = customer.where(F.col("c_acctbal") < 0).select(F.concat(F.lit("cust_"), _k("c_custkey")).alias("source_table"),
                                                      F.concat(F.lit("legacy_"), _k("c_custkey")).alias("target_table"))
    return s.unionByName(c)


def required_tables(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    a = orders.select(F.concat(F.lit("cust_"), _k("o_custkey")).alias("source_table"))
    b = lineitem.select(F.concat(F.lit("supp_"), _k("l_suppkey")).alias("source_table"))
    return a.union(b).distinct().select(F.lit("demo").alias("source_schema"), "source_table")


def observations(customer: DataFrame, orders: DataFrame) -> DataFrame:
    buyers = orders.select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("_has")).distinct()
    j = customer.join(buyers, "c_custkey", "left")
    return j.select(F.lit("demo").alias("source_schema"), F.concat(F.lit("cust_"), _k("c_custkey")).alias("source_table"),
                    F.coalesce("_has", F.lit(False)).alias("source_probe"),
                    (F.col("c_acctbal") >= 3000).alias("target_probe"))


def column_registry(customer: DataFrame, nation: DataFrame) -> DataFrame:
    c = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    cols = F.array(*[F.struct(F.lit(n).alias("col"), F.lit(t).alias("typ")) for n, t in CUSTOMER_COLUMNS])
    e = c.select("c_custkey", "n_name", F.explode(cols).alias("x"))
    return e.select(
        F.lit("demo").alias("source_schema"), F.concat(F.lit("cust_"), _k("c_custkey")).alias("source_table"),
        F.col("x.col").alias("source_column"), F.col("x.typ").alias("source_type"), F.lit("wh").alias("target_project"),
        F.lower("n_name").alias("target_dataset"), F.concat(F.lit("customer_"), _k("c_custkey")).alias("target_table"),
        F.col("x.col").alias("target_column"), F.col("x.typ").alias("target_type"), F.lit(True).alias("source_present"),
        F.lit(True).alias("target_present"), F.lit("compatible").alias("compatibility_status"),
        F.lit(CREATED).alias("checked_at"), F.lit("").alias("notes"))


def replacement_columns(customer: DataFrame) -> DataFrame:
    c = customer.where(F.col("c_acctbal") < 0)
    rows = F.array(
        F.struct(F.lit("c_custkey").alias("col"), F.lit("BIGINT").alias("st"), F.lit("INT64").alias("tt"),
                 F.lit("compatible").alias("status")),
        F.struct(F.lit("c_name").alias("col"), F.lit("STRING").alias("st"), F.lit("INT64").alias("tt"),
                 F.lit("type_mismatch").alias("status")))
    e = c.select("c_custkey", F.explode(rows).alias("x"))
    return e.select(
        F.lit("demo").alias("source_schema"), F.concat(F.lit("cust_"), _k("c_custkey")).alias("source_table"),
        F.col("x.col").alias("source_column"), F.col("x.st").alias("source_type"), F.lit("wh").alias("target_project"),
        F.lit("fixed").alias("target_dataset"), F.concat(F.lit("customer_fix_"), _k("c_custkey")).alias("target_table"),
        F.col("x.col").alias("target_column"), F.col("x.tt").alias("target_type"), F.lit(True).alias("source_present"),
        F.lit(True).alias("target_present"), F.col("x.status").alias("compatibility_status"),
        F.lit(NOW).alias("checked_at"), F.lit("").alias("notes"))


def raw_import_rows(customer: DataFrame) -> DataFrame:
    bal = F.col("c_acctbal")
    return customer.select(
        F.when(bal < 0, F.lit("")).otherwise(F.lit("  DEMO ")).alias("oracle_schema"),
        F.concat(F.lit(" CUST_"), _k("c_custkey"), F.lit(" ")).alias("oracle_table"),
        F.lit(" wh ").alias("bigquery_project"), F.concat(F.lit(" Seg_"), F.col("c_mktsegment")).alias("bigquery_dataset"),
        F.upper(F.concat(F.lit("customer_"), _k("c_custkey"))).alias("bigquery_table"),
        F.when(bal > 5000, F.lit(" READY ")).when(bal > 2500, F.lit("")).otherwise(F.lit("Pending")).alias("status"),
        F.when(bal > 1000, F.lit("Yes")).when(bal > 500, F.lit("1")).otherwise(F.lit("no")).alias("oracle_reachable"),
        F.when(bal > 3000, F.lit("Y")).otherwise(F.lit("")).alias("bigquery_reachable"),
        F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")).alias("notes"))


# ---- the same definitions as DuckDB SQL

BASE_SQL = f"""SELECT 'demo' AS source_schema, 'cust_' || c_custkey AS source_table, 'wh' AS target_project,
  lower(n_name) AS target_dataset, CASE WHEN c_acctbal >= 0 THEN 'customer_' || c_custkey ELSE '' END AS target_table,
  CASE WHEN c_acctbal >= 5000 THEN 'ready' WHEN c_acctbal >= 0 THEN 'pending' ELSE 'blocked' END AS status,
  c_acctbal >= 1000 AS source_reachable, CASE WHEN c_acctbal >= 1000 THEN '{CREATED}' ELSE '' END AS source_checked_at,
  c_acctbal >= 2000 AS target_reachable, CASE WHEN c_acctbal >= 2000 THEN '{CREATED}' ELSE '' END AS target_checked_at,
  c_mktsegment AS notes, '{CREATED}' AS created_at, '{CREATED}' AS updated_at
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

UPDATES_SQL = """SELECT 'demo' AS source_schema, 'cust_' || c_custkey AS source_table, 'wh' AS target_project,
  'fixed' AS target_dataset, 'customer_fix_' || c_custkey AS target_table, 'ready' AS status, true AS source_reachable,
  '' AS source_checked_at, false AS target_reachable, '' AS target_checked_at, 'fixed' AS notes
FROM customer WHERE c_acctbal < 0
UNION ALL
SELECT 'demo', 'supp_' || s_suppkey, 'wh', 'suppliers', 'supplier_' || s_suppkey, 'pending', false, '', false, '', s_name
FROM supplier"""

REQUIRED_SQL = """SELECT DISTINCT 'demo' AS source_schema, t AS source_table FROM (
  SELECT 'cust_' || o_custkey AS t FROM orders UNION ALL SELECT 'supp_' || l_suppkey FROM lineitem) AS r"""

COLUMN_REGISTRY_SQL = f"""SELECT 'demo' AS source_schema, 'cust_' || c_custkey AS source_table, x.col AS source_column,
  x.typ AS source_type, 'wh' AS target_project, lower(n_name) AS target_dataset, 'customer_' || c_custkey AS target_table,
  x.col AS target_column, x.typ AS target_type, true AS source_present, true AS target_present,
  'compatible' AS compatibility_status, '{CREATED}' AS checked_at, '' AS notes
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey,
  (VALUES {', '.join(f"('{n}', '{t}')" for n, t in CUSTOMER_COLUMNS)}) AS x(col, typ)"""

REPLACEMENT_SQL = f"""SELECT 'demo' AS source_schema, 'cust_' || c_custkey AS source_table, x.col AS source_column,
  x.st AS source_type, 'wh' AS target_project, 'fixed' AS target_dataset, 'customer_fix_' || c_custkey AS target_table,
  x.col AS target_column, x.tt AS target_type, true AS source_present, true AS target_present,
  x.status AS compatibility_status, '{NOW}' AS checked_at, '' AS notes
FROM customer, (VALUES ('c_custkey', 'BIGINT', 'INT64', 'compatible'), ('c_name', 'STRING', 'INT64', 'type_mismatch'))
  AS x(col, st, tt, status) WHERE c_acctbal < 0"""
