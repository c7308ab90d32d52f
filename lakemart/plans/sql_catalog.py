"""Oracle SQL per registry key (assembled from ``oracle.py``)."""

from __future__ import annotations

from . import oracle, oracle_fx

ORACLE_SQL: dict[str, str] = {}
ORACLE_SQL.update(oracle.marts_sql())
ORACLE_SQL.update(oracle.monitor_sql())
ORACLE_SQL.update(oracle.questions_sql())
ORACLE_SQL.update(oracle_fx.fx_sql())
ORACLE_SQL.update(oracle_fx.profile_sql())
