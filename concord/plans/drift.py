"""Drifted copies of driver tables, used as reconciliation targets.

Each copy plants known differences into a whole table: rows dropped, values
changed, values nulled, rows duplicated (``orders_tgt``, ``lineitem_tgt``) and
a compensating change that leaves counts and grouped sums intact
(``orders_comp``). The same definitions exist as SQL text for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _hit(key: str, m: int):
    return F.col(key) % F.lit(m) == 0


def orders_tgt(orders: DataFrame) -> DataFrame:
    kept = orders.where(~_hit("o_orderkey", 97)).withColumn(
        "o_totalprice",
        F.when(_hit("o_orderkey", 101), F.col("o_totalprice") + F.lit(1.0))
        .when(_hit("o_orderkey", 103), F.lit(None).cast("double"))
        .otherwise(F.col("o_totalprice")))
    return kept.unionByName(orders.where(_hit("o_orderkey", 107)))


def lineitem_tgt(lineitem: DataFrame) -> DataFrame:
    kept = lineitem.where(~_hit("l_orderkey", 97)).withColumn(
        "l_extendedprice",
        F.when(_hit("l_orderkey", 101), F.col("l_extendedprice") + F.lit(1.0))
        .when(_hit("l_orderkey", 103), F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice")))
    return kept.unionByName(lineitem.where(_hit("l_orderkey", 107)))


def orders_comp(orders: DataFrame) -> DataFrame:
    # Per-status extreme keys by a partial aggregate (one row per status), joined
    # back; a window partitioned by status would put a third of the table in one task.
    ends = orders.groupBy("o_orderstatus").agg(F.min("o_orderkey").alias("_lo"), F.max("o_orderkey").alias("_hi"))
    ends = F.broadcast(ends) if ends.count() <= 100_000 else ends  # counted
    j = orders.join(ends, orders.o_orderstatus.eqNullSafe(ends.o_orderstatus), "left").drop(ends.o_orderstatus)
    price = (F.col("o_totalprice")
             + F.when(F.col("o_orderkey") == F.col("_lo"), F.lit(10.0)).otherwise(F.lit(0.0))
             - F.when(F.col("o_orderkey") == F.col("_hi"), F.lit(10.0)).otherwise(F.lit(0.0)))
    return j.select(*[price.alias(c) if c == "o_totalprice" else F.col(c) for c in orders.columns])


ORDERS_TGT_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 101 = 0 THEN o_totalprice + 1.0
            WHEN o_orderkey % 103 = 0 THEN NULL
            ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 97 <> 0
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 107 = 0"""

LINEITEM_TGT_SQL = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
       CASE WHEN l_orderkey % 101 = 0 THEN l_extendedprice + 1.0
            WHEN l_orderkey % 103 = 0 THEN NULL
            ELSE l_extendedprice END AS l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem WHERE l_orderkey % 97 <> 0
UNION ALL
SELECT * FROM lineitem WHERE l_orderkey % 107 = 0"""

ORDERS_COMP_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus,
       o_totalprice
         + CASE WHEN o_orderkey = min(o_orderkey) OVER (PARTITION BY o_orderstatus) THEN 10.0 ELSE 0.0 END
         - CASE WHEN o_orderkey = max(o_orderkey) OVER (PARTITION BY o_orderstatus) THEN 10.0 ELSE 0.0 END
         AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders"""

# Values that sums cannot hold, and ids above 2^53, on both sides; planted changes that keep every count.
ODD_SOURCE_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, 20000000000000001 + o_orderkey * 8 AS big_id,
       CASE o_orderkey % 50 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN CAST('Infinity' AS DOUBLE)
            WHEN 2 THEN CAST('-Infinity' AS DOUBLE) WHEN 3 THEN CAST(1e30 AS DOUBLE) WHEN 4 THEN NULL
            ELSE o_totalprice END AS x
FROM orders"""

ODD_TARGET_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus,
       20000000000000001 + o_orderkey * 8 + CASE WHEN o_orderkey % 409 = 5 THEN 1 ELSE 0 END AS big_id,
       CASE o_orderkey % 50 WHEN 0 THEN CASE WHEN o_orderkey % 500 = 0 THEN NULL ELSE CAST('NaN' AS DOUBLE) END
            WHEN 1 THEN CASE WHEN o_orderkey % 500 = 1 THEN CAST('NaN' AS DOUBLE) ELSE CAST('Infinity' AS DOUBLE) END
            WHEN 2 THEN CAST('-Infinity' AS DOUBLE)
            WHEN 3 THEN CASE WHEN o_orderkey % 500 = 3 THEN CAST(2e30 AS DOUBLE) ELSE CAST(1e30 AS DOUBLE) END
            WHEN 4 THEN NULL ELSE o_totalprice END AS x
FROM orders"""

# A migrated copy of orders: every column retyped, one dropped, one added, a few rows changed.
RETYPED_SQL = """SELECT CAST(o_orderkey AS DECIMAL(38,0)) AS O_ORDERKEY, CAST(o_custkey AS INTEGER) AS o_custkey,
       o_orderstatus, CAST(CASE WHEN o_orderkey % 401 = 7 THEN o_totalprice + 0.25 ELSE o_totalprice END AS DECIMAL(20,4)) AS o_totalprice,
       CAST(o_orderdate AS DATE) AS o_orderdate, o_orderkey % 2 AS o_flag
FROM orders WHERE o_orderkey % 499 <> 11"""

DRIFT_CTES = (f"orders_tgt AS ({ORDERS_TGT_SQL}),\n lineitem_tgt AS ({LINEITEM_TGT_SQL}),\n"
              f" orders_comp AS ({ORDERS_COMP_SQL})")
