"""Calendar periods: days with orders per week / quarter, and completeness.

A period is complete when it has orders on every calendar day it covers.
Grouping is by (period, day) first, so the shuffle carries distinct days,
never order rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import days_in_quarter, quarter_start, week_start


def _start(kind: str, day):
    if kind == "week":
        return week_start(day)
    if kind == "quarter":
        return quarter_start(day)
    raise ValueError(kind)


def days_with_orders(orders: DataFrame, kind: str, date_col: str = "o_orderdate") -> DataFrame:
    """(period_start, days_with_orders) from raw or silver orders."""
    day = F.col(date_col).cast("date")
    return (orders.select(_start(kind, day).alias("period_start"), day.alias("_d"))
            .groupBy("period_start")
            .agg(F.count_distinct("_d").alias("days_with_orders")))


def period_days(orders: DataFrame, kind: str, date_col: str = "o_orderdate") -> DataFrame:
    """Days with orders, days in the period, and the completeness flag."""
    d = days_with_orders(orders, kind, date_col)
    total = F.lit(7) if kind == "week" else days_in_quarter(F.col("period_start"))
    return d.select(
        F.lit(kind).alias("period_type"), "period_start", "days_with_orders",
        total.cast("int").alias("days_in_period"),
        (F.col("days_with_orders") == total).alias("is_complete"),
    )
