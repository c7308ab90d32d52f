"""Column expressions shared by the layers. All are built-in Spark functions,
so they stay inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exact revenue type: SUM of DECIMAL(18,2) * (1 - DECIMAL(4,2)) widened to the
# largest decimal, so sums of sums keep every cent and hash equal everywhere.
REVENUE_TYPE = "decimal(38,4)"


def net_revenue(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """Line revenue net of discount, before tax."""
    return F.col(price) * (F.lit(1) - F.col(discount))


def week_start(col: str | Column) -> Column:
    """Monday of the ISO week, as DATE."""
    return F.trunc(F.col(col) if isinstance(col, str) else col, "week")


def quarter_start(col: str | Column) -> Column:
    return F.trunc(F.col(col) if isinstance(col, str) else col, "quarter")


def days_in_quarter(qstart: Column) -> Column:
    return F.datediff(F.add_months(qstart, 3), qstart)


def cond(sql: str) -> Column:
    """A Spark SQL boolean condition as a Column."""
    return F.expr(sql)


def is_true(c: Column) -> Column:
    """TRUE only when ``c`` is TRUE (NULL -> FALSE)."""
    return F.coalesce(c, F.lit(False))


def count_if(c: Column) -> Column:
    """Number of rows where ``c`` is TRUE, as BIGINT (0 on empty input)."""
    return F.coalesce(F.sum(F.when(c, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("bigint")


def as_double_ratio(num: Column, den: Column) -> Column:
    """(num - den) / den in DOUBLE, the same way in every engine."""
    return (num.cast("double") - den.cast("double")) / den.cast("double")
