"""Profiling of the raw (bronze) tables.

Every profile is one aggregate over one scan; value counts of several columns
are unpivoted with ``stack`` and counted in a single grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import days_in_quarter, quarter_start, week_start
from .periods import days_with_orders


def order_dates(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """First and last order day, rows, distinct customers (integer keys: on
    bitmaps, in the pass that takes the dates) and the customers there are."""
    day = F.col("o_orderdate").cast("date")
    total = customer.agg(F.count(F.lit(1))).scalar()
    if dict(orders.dtypes)["o_custkey"] not in ("bigint", "int", "smallint", "tinyint"):
        o = orders.agg(F.min(day).alias("first_order"), F.max(day).alias("last_order"), F.count(F.lit(1)).alias("orders"),
                       F.count_distinct("o_custkey").alias("customers_with_orders"))
        return o.select("*", total.alias("customers_total"))
    key = F.col("o_custkey").cast("bigint")
    ranges = orders.groupBy(F.bitmap_bucket_number(key).alias("_range")).agg(
        F.min(day).alias("_first"), F.max(day).alias("_last"), F.count(F.lit(1)).alias("_n"),
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("_bits"))
    zero = F.lit(0).cast("bigint")
    o = ranges.agg(F.min("_first").alias("first_order"), F.max("_last").alias("last_order"), F.coalesce(F.sum("_n"), zero).alias("orders"),
                   F.coalesce(F.sum(F.when(F.col("_range").isNotNull(), F.bitmap_count("_bits"))), zero).alias("customers_with_orders"))
    return o.select("*", total.alias("customers_total"))


def weeks(orders: DataFrame) -> DataFrame:
    return days_with_orders(orders, "week").withColumnRenamed("period_start", "week_start")


def first_weeks(orders: DataFrame, n: int = 3) -> DataFrame:
    return weeks(orders).orderBy("week_start").limit(n)


def last_weeks(orders: DataFrame, n: int = 3) -> DataFrame:
    return weeks(orders).orderBy(F.col("week_start").desc()).limit(n)


def quarters(orders: DataFrame) -> DataFrame:
    return (days_with_orders(orders, "quarter").withColumnRenamed("period_start", "quarter_start")
            .orderBy("quarter_start"))


def complete_periods(orders: DataFrame) -> DataFrame:
    """Weeks and quarters from one pass: distinct days first, then both periods of each day."""
    day = F.col("o_orderdate").cast("date")
    days = orders.select(day.alias("_d")).distinct()
    both = days.select("_d", F.inline(F.array(
        F.struct(F.lit("week").alias("period_type"), week_start("_d").alias("period_start")),
        F.struct(F.lit("quarter").alias("period_type"), quarter_start("_d").alias("period_start")))))
    counted = both.groupBy("period_type", "period_start").agg(F.count("_d").alias("days_with_orders"))
    total = F.when(F.col("period_type") == "week", F.lit(7)).otherwise(days_in_quarter(F.col("period_start")))
    return counted.select("period_type", "period_start", "days_with_orders", total.cast("int").alias("days_in_period"),
                          (F.col("days_with_orders") == total).alias("is_complete"))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, value, n) for each listed column, from one scan of ``df``."""
    pairs = ", ".join(f"'{c}', CAST({c} AS STRING)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, value)")
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def categories(tables: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    out = None
    for t, cols in columns.items():
        vc = value_counts(tables[t], cols)
        out = vc if out is None else out.unionByName(vc)
    return out.orderBy("column_name", F.col("n").desc(), "value")


def numeric(lineitem: DataFrame) -> DataFrame:
    anynull = (F.col("l_discount").isNull() | F.col("l_tax").isNull()
               | F.col("l_quantity").isNull() | F.col("l_extendedprice").isNull())
    return lineitem.agg(
        F.min("l_discount").alias("min_discount"), F.max("l_discount").alias("max_discount"),
        F.min("l_tax").alias("min_tax"), F.max("l_tax").alias("max_tax"),
        F.min("l_quantity").alias("min_qty"), F.max("l_quantity").alias("max_qty"),
        F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"),
        F.coalesce(F.sum(F.when(anynull, 1).otherwise(0)), F.lit(0)).cast("bigint").alias("rows_with_nulls"),
    )
