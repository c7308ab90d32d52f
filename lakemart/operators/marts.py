"""Silver -> gold marts.

Plan shape used by every mart: aggregate the fact side (lineitem / orders) on
the join key *before* the join. Partial (map-side) aggregation collapses a hot
key to one row per task before any shuffle, and the aggregate's output is
already hash-partitioned on the join key. The dimension side is reduced to its
distinct payloads with a count first: a dimension key that repeats many times
costs one row per task, and the reference's join-then-group multiplicities come
from multiplying by that count. Every result is exact: sums and integer
multiples of DECIMAL sums are DECIMAL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import REVENUE_TYPE, net_revenue, quarter_start, week_start


def _revenue_by(lineitem: DataFrame, key: str) -> DataFrame:
    return lineitem.groupBy(key).agg(F.sum(net_revenue()).alias("_rev"))


def _counted(dim: DataFrame, *columns: str) -> DataFrame:
    """The distinct rows of the columns with their number ``_n``."""
    return dim.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))


def _times(amount: str) -> Column:
    """The amount once per repeated dimension row, exactly (scale kept)."""
    return F.col(amount).cast(REVENUE_TYPE) * F.col("_n").cast("decimal(18,0)")


def revenue_metrics(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Net revenue per order day, with its week and quarter start."""
    per_order = _revenue_by(lineitem, "l_orderkey")
    joined = _counted(orders, "o_orderkey", "o_orderdate").join(
        per_order, F.col("o_orderkey") == F.col("l_orderkey"), "inner")
    return joined.groupBy(
        F.col("o_orderdate").alias("date"),
        week_start("o_orderdate").alias("week_start"),
        quarter_start("o_orderdate").alias("quarter_start"),
    ).agg(F.sum(_times("_rev")).cast(REVENUE_TYPE).alias("net_revenue"))


def active_flag(last: Column, as_of: dt.date | Column, window_days: int) -> Column:
    """Latest order strictly after as_of - window and not after as_of. Never
    NULL: a customer without orders is inactive."""
    as_of_col = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return (F.when((last > F.date_sub(as_of_col, window_days)) & (last <= as_of_col), F.lit(True))
            .otherwise(F.lit(False)))


def _last_orders(customer: DataFrame, last: DataFrame) -> DataFrame:
    """Each distinct customer with the last order date (one row per key in ``last``)."""
    return (customer.select("c_custkey", "c_name").distinct()
            .join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
            .select("c_custkey", "c_name", F.col("_last").alias("last_order_date")))


def customer_activity(customer: DataFrame, orders: DataFrame, as_of: dt.date | Column,
                      window_days: int = 365) -> DataFrame:
    """Last order date and trailing-window activity flag per customer;
    customers without orders are kept (last_order_date NULL, flag FALSE)."""
    last = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("_last"))
    out = _last_orders(customer, last)
    return out.select("c_custkey", "c_name", "last_order_date",
                      active_flag(F.col("last_order_date"), as_of, window_days).alias("is_active_trailing_12m"))


def customer_activity_latest(customer: DataFrame, orders: DataFrame, window_days: int = 365) -> DataFrame:
    """``customer_activity`` with as_of = the last order date in the data,
    computed in the plan as a scalar subquery (no collect, no join)."""
    as_of = orders.agg(F.max("o_orderdate")).scalar()
    last = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("_last"))
    out = _last_orders(customer, last)
    return out.select(
        "c_custkey", "c_name", "last_order_date",
        active_flag(F.col("last_order_date"), as_of, window_days).alias("is_active_trailing_12m"))


def _contribution(dim: DataFrame, key: str, name: str, lineitem: DataFrame, fact_key: str) -> DataFrame:
    per_key = _revenue_by(lineitem, fact_key)
    joined = _counted(dim, key, name).join(per_key, F.col(key) == F.col(fact_key), "inner")
    return joined.select(key, name, _times("_rev").cast(REVENUE_TYPE).alias("total_revenue_contribution"))


def top_suppliers(supplier: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Revenue contribution per supplier (suppliers without sales drop out)."""
    return _contribution(supplier, "s_suppkey", "s_name", lineitem, "l_suppkey")


def top_parts(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Revenue contribution per part (parts without sales drop out)."""
    return _contribution(part, "p_partkey", "p_name", lineitem, "l_partkey")
