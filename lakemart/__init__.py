"""lakemart: a PySpark medallion pipeline for retail order data.

bronze (raw copy + ingest stamp) -> silver (typed tables from declarative
contracts, rejected rows quarantined with a reason) -> gold (revenue, activity
and contribution marts), with fused data-quality rules, constraint checks,
audits, week-over-week revenue monitoring, profiling and business questions.
"""

from .config import DEFAULT, Config

__all__ = ["Config", "DEFAULT"]
