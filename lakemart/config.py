"""Run parameters and the fixed values that decide the pipeline's results.

One frozen ``Config`` is passed everywhere instead of module globals, so a job
can run two configurations (for example two as-of dates) side by side.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from decimal import Decimal

LAYERS = ("bronze", "silver", "gold")

# The eight source tables, in the order the rules report them.
TABLES = ("region", "nation", "supplier", "customer", "part", "partsupp", "orders", "lineitem")

# Silver build order: every parent before its children (foreign keys).
BUILD_ORDER = ("region", "nation", "customer", "orders", "part", "supplier", "partsupp", "lineitem")

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference pipeline's values for the
# results to agree: the as-of date, the rate bounds and the allowed values of
# the categorical columns (each list in the order the reference states it).
# ---------------------------------------------------------------------------
AS_OF_DATE = "1998-08-02"
DISCOUNT_MIN, DISCOUNT_MAX = Decimal("0"), Decimal("0.10")
TAX_MIN, TAX_MAX = Decimal("0"), Decimal("0.08")
ALLOWED = {
    ("customer", "c_mktsegment"): ("BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD", "AUTOMOBILE"),
    ("orders", "o_orderstatus"): ("F", "O", "P"),
    ("orders", "o_orderpriority"): ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
    ("lineitem", "l_returnflag"): ("N", "R", "A"),
    ("lineitem", "l_linestatus"): ("F", "O"),
    ("lineitem", "l_shipmode"): ("TRUCK", "FOB", "REG AIR", "AIR", "SHIP", "RAIL", "MAIL"),
}
# Week-over-week alert: a change below -20 % fires.
DROP_THRESHOLD = -0.20
# Trailing activity window in days.
ACTIVE_WINDOW_DAYS = 365
# Business question 1 compares these two quarters; question 3 halves this week.
Q1_QUARTERS = ("1995-10-01", "1996-01-01")
Q1_CUTOFF = "1998-07-01"
Q3_CUT_WEEK = "1998-05-04"
Q3_CUT_FACTOR = Decimal("0.5")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    """Parameters of one pipeline run."""

    as_of: dt.date = dt.date.fromisoformat(AS_OF_DATE)
    discount_bounds: tuple[Decimal, Decimal] = (DISCOUNT_MIN, DISCOUNT_MAX)
    tax_bounds: tuple[Decimal, Decimal] = (TAX_MIN, TAX_MAX)
    allowed: dict = field(default_factory=lambda: dict(ALLOWED))
    drop_threshold: float = DROP_THRESHOLD
    active_window_days: int = ACTIVE_WINDOW_DAYS
    # Catalog namespace that holds the bronze/silver/gold databases. ``None``
    # means the session's current catalog.
    catalog: str | None = None
    # Top-N used by the company-health summary (question 4).
    health_top_n: int = 10

    def fq(self, layer: str, table: str) -> str:
        """Fully qualified table name, e.g. ``silver.orders``."""
        return f"{self.catalog}.{layer}.{table}" if self.catalog else f"{layer}.{table}"

    def schema(self, layer: str) -> str:
        return f"{self.catalog}.{layer}" if self.catalog else layer


DEFAULT = Config()
