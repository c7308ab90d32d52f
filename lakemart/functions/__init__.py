"""Column-level building blocks (built-in Spark functions only)."""

from .columns import (REVENUE_TYPE, as_double_ratio, cond, count_if, days_in_quarter, is_true, net_revenue,
                      quarter_start, week_start)

__all__ = [
    "REVENUE_TYPE", "as_double_ratio", "cond", "count_if", "days_in_quarter", "is_true", "net_revenue",
    "quarter_start", "week_start",
]
