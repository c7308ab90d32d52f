"""The four business questions, answered from the gold marts.

The quarter and week series are one row per calendar period, so the global
windows below run over a calendar-bounded handful of rows.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import Q1_CUTOFF, Q1_QUARTERS, Q3_CUT_FACTOR, Q3_CUT_WEEK
from ..functions import REVENUE_TYPE, as_double_ratio
from .monitor import weekly_revenue
from .periods import period_days

_D = dt.date.fromisoformat


def quarterly_revenue(revenue_metrics: DataFrame) -> DataFrame:
    return (revenue_metrics.groupBy("quarter_start")
            .agg(F.sum("net_revenue").cast(REVENUE_TYPE).alias("total_revenue")))


def _qoq(quarters: DataFrame) -> DataFrame:
    w = Window.orderBy("quarter_start")
    prev = F.lag("total_revenue").over(w)
    return quarters.select(
        "quarter_start", "total_revenue", prev.alias("prev_quarter_revenue"),
        F.round(as_double_ratio(F.col("total_revenue"), prev) * 100, 2).alias("revenue_qoq_pct"),
    )


def q1_quarter_revenue(revenue_metrics: DataFrame, quarters=Q1_QUARTERS, cutoff: str = Q1_CUTOFF) -> DataFrame:
    """Revenue of the chosen quarters and the change against the previous
    *listed* quarter: the IN filter applies before LAG, so the first row has
    no previous value."""
    days = [_D(x) for x in quarters]
    # Implied by the IN list: order days inside the listed quarters. Stated on
    # the grouping column ``date`` it reaches the orders scan as a Parquet
    # range filter, so only those quarters' orders are read and joined.
    span = (F.col("date") >= F.lit(min(days))) & (F.col("date") < F.add_months(F.lit(max(days)), 3))
    q = quarterly_revenue(revenue_metrics.where(span & (F.col("quarter_start") < F.lit(_D(cutoff)))))
    q = q.where(F.col("quarter_start").isin(days))
    return _qoq(q).orderBy("quarter_start")


def q1_quarter_trend(revenue_metrics: DataFrame, orders: DataFrame) -> DataFrame:
    """Quarter-over-quarter change across all complete quarters."""
    done = period_days(orders, "quarter").where("is_complete").select(F.col("period_start").alias("_q"))
    q = quarterly_revenue(revenue_metrics).join(done, F.col("quarter_start") == F.col("_q"), "left_semi")
    return _qoq(q)


def q2_active_customers(customer_activity: DataFrame) -> DataFrame:
    return (customer_activity.where(F.col("is_active_trailing_12m") == F.lit(True))
            .agg(F.count("c_custkey").alias("active_customers_count")))


def _calendar_drops(weekly: DataFrame, threshold: float) -> DataFrame:
    cur = weekly.select(F.col("week_start").alias("current_week"), F.col("weekly_revenue").alias("current_rev"))
    prev = weekly.select(F.date_add("week_start", 7).alias("_next"), F.col("weekly_revenue").alias("previous_rev"))
    ratio = as_double_ratio(F.col("current_rev"), F.col("previous_rev"))
    return (cur.join(prev, F.col("current_week") == F.col("_next"))
            .select("current_week", "current_rev", "previous_rev", (ratio * 100).alias("drop_percentage"))
            .where(ratio <= threshold))


def q3_wow_drop(revenue_metrics: DataFrame, threshold: float = -0.20) -> DataFrame:
    """Weeks whose revenue fell by 20 % or more against the calendar week before, in week order."""
    return _calendar_drops(weekly_revenue(revenue_metrics), threshold).orderBy("current_week")


def q3_wow_drop_simulated(revenue_metrics: DataFrame, cut_week: str = Q3_CUT_WEEK,
                          factor: Decimal = Q3_CUT_FACTOR, threshold: float = -0.20) -> DataFrame:
    """The same detector after scaling one week's revenue by ``factor``."""
    weekly = weekly_revenue(revenue_metrics)
    rev = F.col("weekly_revenue")
    cut = F.when(F.col("week_start") == F.lit(_D(cut_week)), rev * F.lit(factor)).otherwise(rev)
    changed = weekly.select("week_start", cut.cast("decimal(38,5)").alias("weekly_revenue"))
    return _calendar_drops(changed, threshold).orderBy("current_week")


def planted_cut_week(orders: DataFrame):
    """Scalar: the latest complete week whose previous calendar week is also
    complete (chosen from the data, so the planted drop is always comparable)."""
    done = period_days(orders, "week").where("is_complete").select("period_start")
    prev = done.select(F.date_add("period_start", 7).alias("_w"))
    both = done.join(prev, F.col("period_start") == F.col("_w"), "left_semi")
    return both.agg(F.max("period_start")).scalar()


def q3_wow_drop_planted(revenue_metrics: DataFrame, orders: DataFrame, factor: Decimal = Q3_CUT_FACTOR,
                        threshold: float = -0.20) -> DataFrame:
    """Fault injection with the cut week taken from the data: scale the
    latest comparable complete week by ``factor`` and run the detector."""
    weekly = weekly_revenue(revenue_metrics)
    rev = F.col("weekly_revenue")
    cut = F.when(F.col("week_start") == planted_cut_week(orders), rev * F.lit(factor)).otherwise(rev)
    return _calendar_drops(weekly.select("week_start", cut.cast("decimal(38,5)").alias("weekly_revenue")), threshold)


def _top_share(mart: DataFrame, key: str, n: int) -> DataFrame:
    """Share of the top-n contributors in the total; top-n is a bounded
    TakeOrdered, the total a plain aggregate (no global sort of the mart)."""
    rev = "total_revenue_contribution"
    top = mart.orderBy(F.col(rev).desc(), F.col(key).asc()).limit(n).agg(F.sum(rev).alias("_top"))
    total = mart.agg(F.sum(rev)).scalar()
    return top.select((F.col("_top").cast("double") / total.cast("double")).alias("share"))


def q4_company_health(revenue_metrics: DataFrame, orders: DataFrame, customer_activity: DataFrame,
                      top_suppliers: DataFrame, top_parts: DataFrame, n: int = 10) -> DataFrame:
    """One row: last complete quarter's revenue and its change, active
    customers, and the share of the top-n suppliers and parts in revenue."""
    quarters = quarterly_revenue(revenue_metrics)
    done = period_days(orders, "quarter").where("is_complete")
    last_q = done.agg(F.max("period_start").alias("last_complete_quarter"))
    cur = quarters.select(F.col("quarter_start").alias("_c"), F.col("total_revenue").alias("quarter_revenue"))
    prev = quarters.select(F.col("quarter_start").alias("_p"), F.col("total_revenue").alias("prev_quarter_revenue"))
    head = (last_q.join(cur, F.col("last_complete_quarter") == F.col("_c"), "left")
            .join(prev, F.add_months(F.col("last_complete_quarter"), -3) == F.col("_p"), "left"))
    head = head.select(
        "last_complete_quarter", "quarter_revenue", "prev_quarter_revenue",
        F.round(as_double_ratio(F.col("quarter_revenue"), F.col("prev_quarter_revenue")) * 100, 2)
        .alias("revenue_qoq_pct"))
    # One-row parts as scalar subqueries: each runs once, no join.
    active = q2_active_customers(customer_activity).scalar()
    sup = _top_share(top_suppliers, "s_suppkey", n).scalar()
    par = _top_share(top_parts, "p_partkey", n).scalar()
    return head.select(
        "last_complete_quarter", "quarter_revenue", "prev_quarter_revenue", "revenue_qoq_pct",
        active.alias("active_customers"), F.lit(n).alias("top_n"),
        sup.alias("top_supplier_share"), par.alias("top_part_share"))
