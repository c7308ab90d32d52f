"""Bronze -> silver: typed clean rows, quarantined rows with a reason, and the
rows that land in neither (the NULL gap).

All operators are narrow (filter + project): no shuffle, partitions stay as
the scan made them, and the whole table flows through codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .contracts import UNKNOWN_REASON, TableContract

INGESTED_AT = "_ingested_at"
REASON = "rejection_reason"


# Columns that some deliveries of the source lack; no predicate or mart reads them.
OPTIONAL = frozenset(
    "r_comment n_comment c_address c_phone c_comment s_address s_phone s_comment p_mfgr p_container p_comment ps_comment "
    "o_clerk o_shippriority o_comment l_commitdate l_receiptdate l_shipinstruct l_shipmode l_comment".split())

_NUMERIC = ("double", "float", "decimal", "int", "bigint", "smallint", "tinyint")


def cents_form(df: DataFrame | None, contract: TableContract) -> bool:
    """Use the cast-free predicates when all measure inputs are numeric: the
    DECIMAL casts then cost most of the silver filter's CPU. Both forms hold for
    the same rows (also for NaN, infinities and what no DECIMAL(18,2) holds)."""
    if df is None or not contract.fast_accept:
        return False
    types = dict(df.dtypes)
    return all(types.get(c, "string").split("(")[0] in _NUMERIC for c in contract.numeric_inputs)


def accept_list(contract: TableContract, df: DataFrame | None = None) -> tuple[str, ...]:
    return contract.fast_accept if cents_form(df, contract) else contract.accept


def reject_branches(contract: TableContract, df: DataFrame | None = None) -> tuple[tuple[str, str], ...]:
    if cents_form(df, contract):
        return tuple(zip(contract.fast_reject, (r for _, r in contract.reject)))
    return contract.reject


def accept_sql(contract: TableContract, df: DataFrame | None = None) -> str:
    return " AND ".join(f"({c})" for c in accept_list(contract, df))


def reject_sql(contract: TableContract, df: DataFrame | None = None) -> str:
    """The OR of the reject branches: exactly the rows the CASE labels."""
    return " OR ".join(f"({c})" for c, _ in reject_branches(contract, df))


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def reason_sql(contract: TableContract, otherwise: str | None = UNKNOWN_REASON,
               df: DataFrame | None = None) -> str:
    """First matching branch wins; ``otherwise`` (NULL if None) when none does."""
    whens = " ".join(f"WHEN ({c}) THEN {_lit(r)}" for c, r in reject_branches(contract, df))
    tail = f" ELSE {_lit(otherwise)}" if otherwise is not None else ""
    return f"CASE {whens}{tail} END"


def silver_projection_sql(columns: list[str], contract: TableContract) -> list[str]:
    """Typed, trimmed silver columns as SQL. A descriptive column (``OPTIONAL``)
    that the input lacks is emitted as a typed NULL; any other must be there."""
    present = set(columns)
    out = []
    for c in contract.columns:
        if c.name not in present and c.name not in OPTIONAL:
            raise ValueError(f"{contract.table}: the input lacks column {c.name}")
        if c.name not in present:
            out.append(f"CAST(NULL AS {c.type}) AS {c.name}")
        elif c.type == "string":
            out.append(f"TRIM({c.name}) AS {c.name}")
        elif c.from_text:
            out.append(f"CAST(TRIM(CAST({c.name} AS STRING)) AS {c.type}) AS {c.name}")
        else:
            out.append(f"CAST({c.name} AS {c.type}) AS {c.name}")
    if INGESTED_AT in present:
        out.append(INGESTED_AT)
    return out


def clean(df: DataFrame, contract: TableContract) -> DataFrame:
    """Silver table: rows whose accept condition is TRUE, typed and trimmed."""
    return df.where(accept_sql(contract, df)).selectExpr(*silver_projection_sql(df.columns, contract))


def typed(df: DataFrame, contract: TableContract) -> DataFrame:
    """All rows in silver's types, none filtered."""
    return df.selectExpr(*silver_projection_sql(df.columns, contract))


def quarantine(df: DataFrame, contract: TableContract, strict: bool = False) -> DataFrame:
    """Quarantine table: raw columns and types plus ``rejection_reason``.

    ``strict=True`` also sends the NULL-gap rows here (as ``Unknown error``),
    so bronze = silver + quarantine always holds.
    """
    cols = [f"`{c}`" for c in df.columns]
    if strict:
        reject = f"coalesce({reject_sql(contract, df)}, false) OR NOT coalesce({accept_sql(contract, df)}, false)"
        return df.where(reject).selectExpr(*cols, f"{reason_sql(contract, df=df)} AS {REASON}")
    # A row is rejected exactly when some branch matches, i.e. when the CASE
    # without ELSE is not NULL. The pre-filter is implied by every branch (the
    # hint, or the OR of the branches when they compare raw columns only) and
    # stays a separate conjunct that reaches the Parquet reader; ANDing it with
    # the OR of the branches instead lets the optimizer factor both into one
    # OR that cannot be pushed.
    # The hint compares raw columns with numbers: for numeric measures only.
    hint = contract.reject_hint if cents_form(df, contract) else None
    pre = hint or reject_sql(contract, df)
    return (df.where(pre).selectExpr(*cols, f"{reason_sql(contract, None, df)} AS {REASON}")
            .where(f"{REASON} IS NOT NULL"))


def unaccounted(df: DataFrame, contract: TableContract) -> DataFrame:
    """Rows that reach neither silver nor quarantine (accept and reject both
    not TRUE, i.e. a NULL in a compared measure)."""
    return df.where(f"NOT coalesce({accept_sql(contract, df)}, false) AND NOT coalesce({reject_sql(contract, df)}, false)")


def balance(df: DataFrame, contract: TableContract) -> DataFrame:
    """bronze = silver + quarantine, from ONE pass over bronze: conditional
    counts instead of three table scans."""
    agg = df.selectExpr(
        "count(1) AS bronze_received",
        f"count_if(coalesce({accept_sql(contract, df)}, false)) AS silver_delivered",
        f"count_if(coalesce({reject_sql(contract, df)}, false)) AS quarantine_rejected",
    )
    return agg.select(
        F.lit(contract.table).alias("table_name"),
        "bronze_received", "silver_delivered", "quarantine_rejected",
        (F.col("silver_delivered") + F.col("quarantine_rejected")).alias("total_accounted"),
        (F.col("bronze_received") - F.col("silver_delivered") - F.col("quarantine_rejected")).alias("missing_rows"),
    )

