"""Statement corpora and optimisation histories derived from the driver tables.

* ``order_scripts``: one script per order: a PL/SQL block resolving a variable,
  a CTAS whose string literal holds a semicolon and a doubled quote, a blank
  statement, an INSERT with a join, and an unterminated last SELECT that uses
  the variable and NVL/TRUNC.
* ``document_statements``: one INSERT per document carrying its whole text.
* ``part_histories``: six recorded optimisation iterations per part, with
  costs from the retail price and size, rejected candidates and failures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _s(c: str | F.Column) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def order_scripts(orders: DataFrame) -> DataFrame:
    k, c = _s("o_orderkey"), _s("o_custkey")
    sql = F.concat(
        F.lit("DECLARE\n  v_day DATE;\nBEGIN\n  SELECT MAX(o_orderdate) INTO v_day FROM orders WHERE o_orderkey = "),
        k, F.lit(";\nEND;\n/\n"),
        F.lit("CREATE TABLE stg_"), k, F.lit(" AS SELECT * FROM orders WHERE o_orderkey = "), k,
        F.lit(" AND o_orderpriority = '"), F.col("o_orderpriority"), F.lit(";"), F.col("o_orderstatus"),
        F.lit("''s';\n  ;\nINSERT INTO fact_orders SELECT s.*, c.c_name FROM stg_"), k,
        F.lit(" s JOIN Customer c ON c.c_custkey = "), c,
        F.lit(";\nselect NVL(o_totalprice, 0), TRUNC(o_orderdate) from stg_"), k, F.lit(" where o_orderdate = v_day\n"))
    return orders.select(F.concat(F.lit("ord_"), k).alias("script_id"), sql.alias("sql"))


def item_scripts(orders: DataFrame) -> DataFrame:
    """One script per order with two assignments from its items, with two and three conditions."""
    k = _s("o_orderkey")
    sql = F.concat(
        F.lit("SELECT COUNT(*) INTO v_n FROM lineitem WHERE l_orderkey = "), k, F.lit(" AND l_quantity > "), _s(F.col("o_orderkey") % 50),
        F.lit(";\nSELECT MAX(l_partkey) INTO v_part FROM lineitem\n WHERE l_orderkey = "), k, F.lit(" AND l_discount <= 0.05 AND l_shipdate >= DATE '"),
        F.date_format(F.date_add("o_orderdate", 30), "yyyy-MM-dd"), F.lit("';\n"))
    return orders.select(F.concat(F.lit("ord_"), k).alias("script_id"), sql.alias("sql"))


def order_variables(orders: DataFrame) -> DataFrame:
    """The resolved ``v_day`` of each order script (its own order date)."""
    return orders.select(F.concat(F.lit("ord_"), _s("o_orderkey")).alias("script_id"),
                         F.lit("v_day").alias("var_name"),
                         F.date_format("o_orderdate", "yyyy-MM-dd").alias("value"))


def order_table_map(orders: DataFrame) -> DataFrame:
    """Correspondences: the two base tables, and staging tables of finished orders."""
    stg = orders.where(F.col("o_orderstatus") == "F").select(
        F.concat(F.lit("stg_"), _s("o_orderkey")).alias("source_name"),
        F.concat(F.lit("stage_"), _s("o_orderkey")).alias("target_name"))
    base = orders.sparkSession.createDataFrame([("orders", "dw_orders"), ("customer", "dw_customer")],
                                               "source_name string, target_name string")
    return base.unionByName(stg)


def document_statements(documents: DataFrame) -> DataFrame:
    sql = F.concat(F.lit("INSERT INTO docs_"), F.col("lang"), F.lit(" VALUES ("), _s("doc_id"), F.lit(", '"),
                   F.replace(F.col("text"), F.lit("'"), F.lit("''")), F.lit("')"))
    return documents.select(F.col("lang").alias("script_id"), F.col("doc_id").alias("unit_order"), sql.alias("sql"))


def part_histories(part: DataFrame) -> DataFrame:
    """``(query_id, iteration, estimated_bytes, outcome)``, iterations 0..5 per part."""
    i = F.col("iteration")
    cents = F.round(F.col("p_retailprice") * F.lit(100.0)).cast("long")
    step = (F.col("p_size") % 7).cast("long")
    bytes_ = cents * (F.lit(100) - i * step * F.lit(3)) * F.lit(10000)
    bytes_ = F.when((F.col("p_partkey") % 11 == 0) & (i == 2), bytes_ * F.lit(3)).otherwise(bytes_)
    outcome = (F.when((i == 0) & (F.col("p_size") == 50), F.lit("execution_failed"))
               .when(i == 0, F.lit("ok"))
               .when(F.col("p_partkey") % 97 == i, F.lit("llm_error"))
               .when(F.col("p_partkey") % 89 == i, F.lit("estimate_failed"))
               .when(F.col("p_partkey") % 83 == i, F.lit("execution_failed"))
               .when(F.col("p_partkey") % 13 == i, F.lit("validation_failed"))
               .otherwise(F.lit("ok")))
    return part.select("p_partkey", "p_retailprice", "p_size", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("iteration")).select(
        F.col("p_partkey").alias("query_id"), i.cast("int").alias("iteration"), bytes_.cast("long").alias("estimated_bytes"),
        outcome.alias("outcome"))


ORDER_UNITS_SQL = """
SELECT 'ord_' || o_orderkey AS script_id, 1 AS unit_id,
       'CREATE TABLE stg_' || o_orderkey || ' AS SELECT * FROM orders WHERE o_orderkey = ' || o_orderkey
       || ' AND o_orderpriority = ''' || o_orderpriority || ';' || o_orderstatus || '''''s''' AS statement,
       'DDL' AS statement_type, o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders
UNION ALL
SELECT 'ord_' || o_orderkey, 2,
       'INSERT INTO fact_orders SELECT s.*, c.c_name FROM stg_' || o_orderkey || ' s JOIN Customer c ON c.c_custkey = '
       || o_custkey, 'DML', o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders
UNION ALL
SELECT 'ord_' || o_orderkey, 3,
       'select NVL(o_totalprice, 0), TRUNC(o_orderdate) from stg_' || o_orderkey || ' where o_orderdate = DATE '''
       || strftime(o_orderdate, '%Y-%m-%d') || '''', 'SELECT', o_orderkey, o_custkey, o_orderstatus, o_orderdate,
       o_orderpriority FROM orders"""

PART_HISTORY_SQL = """
SELECT p_partkey AS query_id, CAST(i AS INTEGER) AS iteration,
       CAST(CASE WHEN p_partkey % 11 = 0 AND i = 2 THEN b * 3 ELSE b END AS BIGINT) AS estimated_bytes,
       CASE WHEN i = 0 AND p_size = 50 THEN 'execution_failed' WHEN i = 0 THEN 'ok'
            WHEN p_partkey % 97 = i THEN 'llm_error' WHEN p_partkey % 89 = i THEN 'estimate_failed'
            WHEN p_partkey % 83 = i THEN 'execution_failed' WHEN p_partkey % 13 = i THEN 'validation_failed'
            ELSE 'ok' END AS outcome
FROM (SELECT p_partkey, p_size, i,
             CAST(round(p_retailprice * 100.0::DOUBLE) AS BIGINT) * (100 - i * (p_size % 7) * 3) * 10000 AS b
      FROM part, range(0, 6) AS r(i)) AS h"""
