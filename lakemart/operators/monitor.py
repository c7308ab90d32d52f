"""Week-over-week revenue monitoring.

The reference carries three definitions of the revenue alert; all three are
parameters of one operator:

* ``adjacency="row"``, ``weeks="drop_first"``, ``inclusive=False``: the
  pipeline alert (previous *row*, first week dropped, strict ``<``);
* ``adjacency="calendar"``, ``weeks="all"``, ``inclusive=True``: the business
  question (previous *calendar* week, inclusive ``<=``);
* ``weeks="complete"``: the documented definition, complete weeks only.

Size bound: the input is one row per calendar week (about 52 a year whatever
the data volume), so the global ordering window runs on a few hundred rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DROP_THRESHOLD
from ..functions import REVENUE_TYPE, as_double_ratio
from .periods import period_days


def weekly_revenue(revenue_metrics: DataFrame) -> DataFrame:
    """Net revenue per week, in week order."""
    return (revenue_metrics.groupBy("week_start")
            .agg(F.sum("net_revenue").cast(REVENUE_TYPE).alias("weekly_revenue")).orderBy("week_start"))


def drop_first_week(weekly: DataFrame) -> DataFrame:
    """Remove the earliest week. The minimum is a window over the weekly rows
    (one per calendar week), so the weeks are computed once."""
    first = F.min("week_start").over(Window.partitionBy())
    return (weekly.withColumn("_first", first).where(F.col("week_start") != F.col("_first")).drop("_first"))


def complete_weeks_only(weekly: DataFrame, orders: DataFrame) -> DataFrame:
    """Keep weeks with orders on all 7 days."""
    done = period_days(orders, "week").where("is_complete").select(F.col("period_start").alias("_w"))
    return weekly.join(done, F.col("week_start") == F.col("_w"), "left_semi")


def wow_change(weekly: DataFrame, adjacency: str = "row") -> DataFrame:
    """Each week with the previous week's revenue and the relative change.

    ``row``: previous row in week order (the first row has NULL).
    ``calendar``: the week exactly 7 days earlier; weeks without one are dropped.
    """
    w = Window.orderBy("week_start")
    out = weekly.select(
        "week_start", "weekly_revenue",
        F.lag("weekly_revenue", 1).over(w).alias("previous_week_revenue"),
        F.lag("week_start", 1).over(w).alias("_prev_week"),
    )
    if adjacency == "calendar":
        out = out.where(F.col("_prev_week") == F.date_sub(F.col("week_start"), 7))
    elif adjacency != "row":
        raise ValueError(f"adjacency must be 'row' or 'calendar', not {adjacency!r}")
    return out.select(
        "week_start", "weekly_revenue", "previous_week_revenue",
        as_double_ratio(F.col("weekly_revenue"), F.col("previous_week_revenue")).alias("wow_change_percentage"),
    )


def revenue_drops(weekly: DataFrame, *, adjacency: str = "row", weeks: str = "drop_first",
                  inclusive: bool = False, threshold: float = DROP_THRESHOLD,
                  orders: DataFrame | None = None) -> DataFrame:
    """Weeks whose change falls below (or to, with ``inclusive``) the threshold."""
    if weeks == "drop_first":
        weekly = drop_first_week(weekly)
    elif weeks == "complete":
        if orders is None:
            raise ValueError("weeks='complete' needs the orders to tell complete weeks")
        weekly = complete_weeks_only(weekly, orders)
    elif weeks != "all":
        raise ValueError(f"weeks must be 'all', 'drop_first' or 'complete', not {weeks!r}")
    change = wow_change(weekly, adjacency)
    ratio = F.col("wow_change_percentage")
    return change.where(ratio <= threshold if inclusive else ratio < threshold)


def alert_status(drops: DataFrame) -> DataFrame:
    """One row: whether the alert fires and on how many weeks (the boolean
    the pipeline alert returns, as data)."""
    return drops.agg((F.count(F.lit(1)) > 0).alias("anomaly_detected"),
                     F.count(F.lit(1)).alias("anomaly_weeks"))


def alert(spark: SparkSession, drops: DataFrame, show: bool = True, threshold: float = DROP_THRESHOLD) -> bool:
    """Driver-side action: True if any week fired. Runs the plan once.
    ``threshold``: the one that ``drops`` was made with, for the message."""
    rows = drops.orderBy("week_start").collect()  # at most one row per week
    if rows:
        print(f"WARNING: revenue anomaly in {len(rows)} week(s) "
              f"(week-over-week drop beyond {abs(threshold):.0%}).")
        if show:
            spark.createDataFrame(rows, drops.schema).show(truncate=False)
        return True
    print("INFO: no revenue anomaly detected.")
    return False
