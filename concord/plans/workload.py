"""The demo workload (Q1, Q2, J1, G1-G3) on the driver's order tables.

The reference's script resolves ``MAX(load_date)`` into a variable, filters the
orders of that day, joins the customer segment, groups per customer, segment
and day, and re-groups per segment. Here the variable is a scalar subquery:
Catalyst runs it once and keeps its type (no text round-trip), and the filter
on the day is applied before the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions.numeric import exact_sum


def daily_revenue(orders: DataFrame, customer: DataFrame, run_date: F.Column | None = None) -> DataFrame:
    """G1 (stage 1 of the demo): revenue and order count per customer, segment and day.

    ``run_date`` optionally restricts to one load day (Q2). Revenue is summed as
    ``decimal(38,6)`` so the total does not depend on summation order.
    """
    o = orders.select("o_custkey", "o_orderdate", "o_totalprice")
    if run_date is not None:
        o = o.where(F.col("o_orderdate") == run_date)
    c = customer.select(F.col("c_custkey"), F.col("c_mktsegment").alias("segment"))
    joined = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return joined.groupBy(
        F.col("o_custkey").alias("customer_id"),
        F.col("segment"),
        F.to_date("o_orderdate").alias("order_day"),
    ).agg(
        exact_sum(F.coalesce(F.col("o_totalprice"), F.lit(0.0))).alias("revenue"),
        F.count(F.lit(1)).alias("order_count"),
    )


def last_load_day(orders: DataFrame) -> F.Column:
    """``MAX(o_orderdate)`` as a scalar subquery column."""
    return orders.select(F.max("o_orderdate")).scalar()


def segment_revenue(daily: DataFrame) -> DataFrame:
    """Second-level aggregate over the stage-1 result."""
    return daily.groupBy("segment").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("order_count").alias("order_count"),
    )


def segment_revenue_last_day(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """The whole demo: max day → filter → join → group → re-group."""
    return segment_revenue(daily_revenue(orders, customer, last_load_day(orders)))
