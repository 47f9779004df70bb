"""Units frames derived from the driver tables.

Each entity row becomes one statement-like unit that builds a table for that
entity from the tables of the entities it refers to, so the lineage graph grows
with the data: region → nation → customer/supplier → order → line item (fed by
its order and its supplier). Nations also refresh themselves (a self-loop) and
each region has a snapshot unit without sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.sources.tables import read_table


def _name(prefix: str, *cols: str) -> F.Column:
    parts = [F.lit(prefix)]
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("_"))
        parts.append(F.col(c).cast("string"))
    return F.concat(*parts)


def _unit(df: DataFrame, kind: str, rank: int, key_cols: list[str], sources: list[F.Column],
          target: F.Column) -> DataFrame:
    uid = F.concat_ws(":", F.lit(kind), *[F.col(c).cast("string") for c in key_cols])
    order = F.lit(rank * 10**12) + F.col(key_cols[0]).cast("long")
    return df.select(uid.alias("unit_id"), order.alias("unit_order"),
                     F.array(*sources).cast("array<string>").alias("sources"), F.array(target).alias("targets"))


def entity_units(spark: SparkSession, sf: str) -> DataFrame:
    region, nation = read_table(spark, sf, "region"), read_table(spark, sf, "nation")
    customer, supplier = read_table(spark, sf, "customer"), read_table(spark, sf, "supplier")
    orders, lineitem = read_table(spark, sf, "orders"), read_table(spark, sf, "lineitem")
    parts = [
        _unit(region, "regsnap", 1, ["r_regionkey"], [], _name("regsnap_", "r_regionkey")),
        _unit(nation, "nation", 2, ["n_nationkey"], [_name("reg_", "n_regionkey")], _name("nat_", "n_nationkey")),
        _unit(nation, "natrefresh", 3, ["n_nationkey"], [_name("nat_", "n_nationkey")], _name("nat_", "n_nationkey")),
        _unit(customer, "customer", 4, ["c_custkey"], [_name("nat_", "c_nationkey")], _name("cust_", "c_custkey")),
        _unit(supplier, "supplier", 5, ["s_suppkey"], [_name("nat_", "s_nationkey")], _name("supp_", "s_suppkey")),
        _unit(orders, "orders", 6, ["o_orderkey"], [_name("cust_", "o_custkey")], _name("ord_", "o_orderkey")),
        _unit(lineitem, "lineitem", 7, ["l_orderkey", "l_linenumber"],
              [_name("ord_", "l_orderkey"), _name("supp_", "l_suppkey")], _name("line_", "l_orderkey", "l_linenumber")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cyclic_units(spark: SparkSession, sf: str) -> DataFrame:
    """The same units and such as close cycles: a nation's suppliers feed each other in a ring, and the orders of every
    fiftieth customer feed the customer's table back."""
    supplier, orders = read_table(spark, sf, "supplier"), read_table(spark, sf, "orders")
    ring = Window.partitionBy("s_nationkey").orderBy("s_suppkey")
    first = supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("_first"))
    after = supplier.withColumn("_next", F.lead("s_suppkey").over(ring)).join(first, "s_nationkey").withColumn(
        "_next", F.coalesce("_next", "_first"))
    back = orders.where("o_custkey % 50 = 0")
    return entity_units(spark, sf).unionByName(
        _unit(after, "ring", 8, ["s_suppkey"], [_name("supp_", "s_suppkey")], _name("supp_", "_next"))).unionByName(
        _unit(back, "back", 9, ["o_orderkey"], [_name("ord_", "o_orderkey")], _name("cust_", "o_custkey")))


# The same graph as DuckDB SQL: one row per (source, target, unit) edge, and the produced tables.
ENTITY_EDGES_SQL = """
SELECT 'reg_' || n_regionkey AS source, 'nat_' || n_nationkey AS target, 'nation:' || n_nationkey AS unit_id FROM nation
UNION ALL SELECT 'nat_' || n_nationkey, 'nat_' || n_nationkey, 'natrefresh:' || n_nationkey FROM nation
UNION ALL SELECT 'nat_' || c_nationkey, 'cust_' || c_custkey, 'customer:' || c_custkey FROM customer
UNION ALL SELECT 'nat_' || s_nationkey, 'supp_' || s_suppkey, 'supplier:' || s_suppkey FROM supplier
UNION ALL SELECT 'cust_' || o_custkey, 'ord_' || o_orderkey, 'orders:' || o_orderkey FROM orders
UNION ALL SELECT 'ord_' || l_orderkey, 'line_' || l_orderkey || '_' || l_linenumber,
                 'lineitem:' || l_orderkey || ':' || l_linenumber FROM lineitem
UNION ALL SELECT 'supp_' || l_suppkey, 'line_' || l_orderkey || '_' || l_linenumber,
                 'lineitem:' || l_orderkey || ':' || l_linenumber FROM lineitem"""

ENTITY_PRODUCED_SQL = "SELECT target AS t FROM edges UNION SELECT 'regsnap_' || r_regionkey FROM region"

CYCLIC_EDGES_SQL = ENTITY_EDGES_SQL + """
UNION ALL SELECT 'supp_' || s_suppkey, 'supp_' || COALESCE(lead(s_suppkey) OVER ring, min(s_suppkey) OVER (PARTITION BY s_nationkey)),
                 'ring:' || s_suppkey FROM supplier WINDOW ring AS (PARTITION BY s_nationkey ORDER BY s_suppkey)
UNION ALL SELECT 'ord_' || o_orderkey, 'cust_' || o_custkey, 'back:' || o_orderkey FROM orders WHERE o_custkey % 50 = 0"""

# Its cycles, as the units above close them: the suppliers of a nation with two and more, a customer (by whose
# name, smaller than any order's, the cycle goes) and its orders.
CYCLES_SQL = """SELECT 'supp_' || s_suppkey AS t, min('supp_' || s_suppkey) OVER (PARTITION BY s_nationkey) AS cycle
FROM supplier WHERE s_nationkey IN (SELECT s_nationkey FROM supplier GROUP BY 1 HAVING count(*) > 1)
UNION SELECT 'ord_' || o_orderkey, 'cust_' || o_custkey FROM orders WHERE o_custkey % 50 = 0
UNION SELECT 'cust_' || o_custkey, 'cust_' || o_custkey FROM orders WHERE o_custkey % 50 = 0"""
