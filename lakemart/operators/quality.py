"""The 52 validation rules and the 38 silver constraints, as fused checks.

Rules are data (``checks.Check``); ``validation_report`` evaluates all of them
in one plan. ``rule(n)`` evaluates one on its own with the same machinery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, TABLES
from .checks import Check, evaluate
from .contracts import CONTRACTS, contracts_for
from .refine import accept_sql, reject_sql

# ---------------------------------------------------------------------------
# Rule layers and names as the reference reports them.
# ---------------------------------------------------------------------------
LAYER_BRONZE = "bronze"
LAYER_RECON = "bronze_silver_reconciliation"
LAYER_SILVER = "silver"
LAYER_GOLD = "gold"
NAME_SOURCE_COUNT = "{t}: row count equals source"
NAME_RECON = "{t}: bronze rows equals silver plus quarantine"
NAMES_BRONZE = (
    "orders: customer exists",
    "lineitem: order exists",
    "orders: has at least one line item",
    "orders: key, customer and date not null",
    "lineitem: quantity and price strictly positive",
    "lineitem: discount between 0 and 0.1",
    "lineitem: tax between 0 and 0.08",
)
NAME_ALLOWED = "{t}.{c}: value in allowed list"
NAMES_SILVER_PK = {
    "region": "region: primary key unique",
    "nation": "nation: primary key unique",
    "supplier": "supplier: primary key unique",
    "customer": "customer: primary key unique",
    "part": "part: primary key unique",
    "partsupp": "partsupp: primary key unique",
    "orders": "orders: primary key unique",
    "lineitem": "lineitem: primary key unique",
}
NAMES_SILVER = (
    "nation: every nation references a valid region",
    "lineitem: ship_date before or equal receipt_date",
    "lineitem: discount and tax within bounds [0, 0.1] and [0, 0.08]",
    "lineitem: quantity strictly positive",
    "orders: totalprice cannot be negative",
    "lineitem: ship_date cannot be earlier than parent order date",
    "customer: every customer references a valid nation",
    "supplier: every supplier references a valid nation",
    "lineitem: every part-supplier pair exists in partsupp",
)
NAMES_GOLD = (
    "reconciliation: gold net revenue matches silver sum within tolerance $0.01",
    "revenue_metrics: net_revenue is strictly positive",
    "top_suppliers: revenue contribution is strictly positive",
    "top_parts: revenue contribution is strictly positive",
    "customer_activity: trailing 12m flag has no nulls",
    "revenue_metrics: table is not empty",
)
# ---------------------------------------------------------------------------


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def rule_checks(config, lazy: bool = False, bronze=None) -> list[Check]:
    """All 52 rules as checks. ``lazy``: silver and quarantine are filters of
    bronze, so reconciliation counts come from one bronze scan. ``bronze``: gives
    a table's bronze frame, whose types choose the form of the predicates."""
    out: list[Check] = []
    n = 0

    def add(layer, name, kind, frame, **kw):
        nonlocal n
        n += 1
        return [Check(n, (layer, name), kind, frame, **kw)]

    def add_parts(layer, name, parts):
        nonlocal n
        n += 1
        return [Check(n, (layer, name), kind, frame, **kw) for kind, frame, kw in parts]

    # 1-8: bronze copy has every source row.
    for t in TABLES:
        out += add_parts(LAYER_BRONZE, NAME_SOURCE_COUNT.format(t=t), [
            ("rows", ("source", t), dict(finish="abs")),
            ("rows", ("bronze", t), dict(sign=-1, finish="abs")),
        ])
    # 9-16: bronze = silver + quarantine.
    for t in TABLES:
        c = contracts_for(config)[t]
        if lazy:  # the predicates that silver and quarantine use, on the same frame
            df = bronze(t) if bronze is not None else None
            acc, rej = accept_sql(c, df), reject_sql(c, df)
            parts = [("rows", ("bronze", t), dict(finish="abs")),
                     ("where", ("bronze", t), dict(condition=acc, sign=-1, finish="abs")),
                     ("where", ("bronze", t), dict(condition=rej, sign=-1, finish="abs"))]
        else:
            parts = [("rows", ("bronze", t), dict(finish="abs")),
                     ("rows", ("silver", t), dict(sign=-1, finish="abs")),
                     ("rows", ("quarantine", t), dict(sign=-1, finish="abs"))]
        out += add_parts(LAYER_RECON, NAME_RECON.format(t=t), parts)
    # 17-23: bronze integrity and ranges (NULL outcome = violation).
    (lo_d, hi_d), (lo_t, hi_t) = config.discount_bounds, config.tax_bounds
    b = NAMES_BRONZE
    out += add(LAYER_BRONZE, b[0], "orphans", ("bronze", "orders"), key=("o_custkey",),
               parent=("bronze", "customer"), parent_key=("c_custkey",))
    out += add(LAYER_BRONZE, b[1], "orphans", ("bronze", "lineitem"), key=("l_orderkey",),
               parent=("bronze", "orders"), parent_key=("o_orderkey",))
    out += add(LAYER_BRONZE, b[2], "orphans", ("bronze", "orders"), key=("o_orderkey",),
               parent=("bronze", "lineitem"), parent_key=("l_orderkey",))
    out += add(LAYER_BRONZE, b[3], "where", ("bronze", "orders"),
               condition="o_orderkey IS NULL OR o_custkey IS NULL OR o_orderdate IS NULL")
    out += add(LAYER_BRONZE, b[4], "where", ("bronze", "lineitem"),
               condition="NOT coalesce(l_quantity > 0 AND l_extendedprice > 0, false)")
    out += add(LAYER_BRONZE, b[5], "where", ("bronze", "lineitem"),
               condition=f"NOT coalesce(l_discount BETWEEN {lo_d} AND {hi_d}, false)")
    out += add(LAYER_BRONZE, b[6], "where", ("bronze", "lineitem"),
               condition=f"NOT coalesce(l_tax BETWEEN {lo_t} AND {hi_t}, false)")
    # 24-29: categorical values.
    for (t, col), values in config.allowed.items():
        out += add(LAYER_BRONZE, NAME_ALLOWED.format(t=t, c=col), "where", ("bronze", t),
                   condition=f"NOT coalesce({col} IN ({_in_list(values)}), false)")
    # 30-37: silver primary keys.
    for t in TABLES:
        out += add(LAYER_SILVER, NAMES_SILVER_PK[t], "duplicates", ("silver", t), key=CONTRACTS[t].key,
                   dense=CONTRACTS[t].dense_key)
    # 38-46: silver references and ranges (NULL outcome passes).
    s = NAMES_SILVER
    out += add(LAYER_SILVER, s[0], "orphans", ("silver", "nation"), key=("n_regionkey",),
               parent=("silver", "region"), parent_key=("r_regionkey",))
    out += add(LAYER_SILVER, s[1], "where", ("silver", "lineitem"), condition="l_shipdate > l_receiptdate")
    out += add(LAYER_SILVER, s[2], "where", ("silver", "lineitem"),
               condition=f"NOT (l_discount BETWEEN {lo_d} AND {hi_d} AND l_tax BETWEEN {lo_t} AND {hi_t})")
    out += add(LAYER_SILVER, s[3], "where", ("silver", "lineitem"), condition="l_quantity <= 0")
    out += add(LAYER_SILVER, s[4], "where", ("silver", "orders"), condition="o_totalprice < 0")
    out += add(LAYER_SILVER, s[5], "before", ("silver", "lineitem"), key=("l_orderkey",),
               attrs=("l_shipdate",), parent=("silver", "orders"), parent_key=("o_orderkey",),
               parent_attrs=("o_orderdate",))
    out += add(LAYER_SILVER, s[6], "orphans", ("silver", "customer"), key=("c_nationkey",),
               parent=("silver", "nation"), parent_key=("n_nationkey",))
    out += add(LAYER_SILVER, s[7], "orphans", ("silver", "supplier"), key=("s_nationkey",),
               parent=("silver", "nation"), parent_key=("n_nationkey",))
    out += add(LAYER_SILVER, s[8], "orphans", ("silver", "lineitem"), key=("l_partkey", "l_suppkey"),
               parent=("silver", "partsupp"), parent_key=("ps_partkey", "ps_suppkey"))
    # 47-52: gold. Lazily derived marts are checked from the rows that they are made of (the same ones that
    # the silver rules read); written ones are read.
    g = NAMES_GOLD
    if lazy:
        lines = dict(key=("l_orderkey",), attrs=("l_shipdate",), parent=("silver", "orders"), parent_key=("o_orderkey",),
                     parent_attrs=("o_orderdate",))
        of = lambda key, parent, pk, name: dict(condition="revenue <= 0", key=(key,), parent=("silver", parent),
                                                parent_key=(pk,), parent_attrs=(name,))
        out += add_parts(LAYER_GOLD, g[0], [
            ("dated", ("silver", "lineitem"), dict(lines, condition="revenue", finish="over_tolerance")),
            ("revenue", ("silver", "lineitem"), dict(sign=-1, finish="over_tolerance")),
        ])
        out += add(LAYER_GOLD, g[1], "dated", ("silver", "lineitem"), **lines, condition="revenue <= 0")
        out += add(LAYER_GOLD, g[2], "contribution", ("silver", "lineitem"), **of("l_suppkey", "supplier", "s_suppkey", "s_name"))
        out += add(LAYER_GOLD, g[3], "contribution", ("silver", "lineitem"), **of("l_partkey", "part", "p_partkey", "p_name"))
    else:
        out += add_parts(LAYER_GOLD, g[0], [
            ("revenue", ("gold", "revenue_metrics"), dict(condition="net_revenue", finish="over_tolerance")),
            ("revenue", ("silver", "lineitem"), dict(sign=-1, finish="over_tolerance")),
        ])
        out += add(LAYER_GOLD, g[1], "where", ("gold", "revenue_metrics"), condition="net_revenue <= 0")
        out += add(LAYER_GOLD, g[2], "where", ("gold", "top_suppliers"), condition="total_revenue_contribution <= 0")
        out += add(LAYER_GOLD, g[3], "where", ("gold", "top_parts"), condition="total_revenue_contribution <= 0")
    out += add(LAYER_GOLD, g[4], "where", ("gold", "customer_activity"),
               condition="is_active_trailing_12m IS NULL")
    if lazy:
        out += add(LAYER_GOLD, g[5], "dated", ("silver", "lineitem"), **lines, condition="dates", finish="is_empty")
    else:
        out += add(LAYER_GOLD, g[5], "rows", ("gold", "revenue_metrics"), finish="is_empty")
    assert n == 52
    return out


BRONZE_RULES = tuple(range(1, 9)) + tuple(range(17, 30))


def _is_lazy(layers) -> bool:
    from ..plans.layers import LazyLayers
    return isinstance(layers, LazyLayers)


def _report(df: DataFrame, with_timestamp: bool) -> DataFrame:
    out = df.select("id", F.col("label0").alias("layer"), F.col("label1").alias("rule"), "violations",
                    (F.col("violations") == 0).alias("passed"))
    if with_timestamp:
        out = out.withColumn("checked_at", F.current_timestamp())
    return out.orderBy("id").drop("id")


def validation_report(layers, rules: list[int] | None = None, with_timestamp: bool = True) -> DataFrame:
    """layer, rule, violations, passed[, checked_at]: one row per rule."""
    lazy = _is_lazy(layers)
    checks = rule_checks(layers.config, lazy=lazy, bronze=layers.bronze if lazy else None)
    if rules is not None:
        keep = set(rules)
        checks = [c for c in checks if c.id in keep]
    return _report(evaluate(layers, checks, width=2), with_timestamp)


def rule(layers, number: int) -> DataFrame:
    """One rule on its own: layer, rule, violations."""
    return validation_report(layers, [number], with_timestamp=False).drop("passed")


def failing_rules(report: DataFrame) -> DataFrame:
    return report.where(F.col("passed") == F.lit(False))


def assert_valid(report: DataFrame) -> None:
    """Raise if any rule failed (the ``fail_on_error`` mode)."""
    if not failing_rules(report).isEmpty():
        raise AssertionError("Validation failed, see the results table")


# ----------------------------- constraints --------------------------------

def constraint_checks(config=DEFAULT) -> list[Check]:
    """The 38 declared silver constraints as checks, in declaration order:
    NOT NULL (NULL count), PRIMARY KEY (duplicates or NULL parts), FOREIGN KEY
    (non-NULL keys without a parent row) and CHECK (condition FALSE)."""
    out: list[Check] = []
    from ..config import BUILD_ORDER
    n = 0
    for t in BUILD_ORDER:
        c = contracts_for(config)[t]
        fr = ("silver", t)
        items = []
        for col in c.not_null:
            items.append(((f"nn_{t}_{col}", t, "NOT NULL"), dict(kind="where", condition=f"{col} IS NULL")))
        items.append(((c.key_name, t, "PRIMARY KEY"), dict(kind="duplicates", key=c.key, dense=c.dense_key)))
        for fk in c.foreign_keys:
            items.append(((fk.name, t, "FOREIGN KEY"), dict(
                kind="orphans", key=fk.columns, parent=("silver", fk.parent), parent_key=fk.parent_columns,
                null_ok=True)))
        for ch in c.checks:
            items.append(((ch.name, t, "CHECK"), dict(kind="where", condition=f"NOT coalesce({ch.condition}, true)")))
        for labels, kw in items:
            n += 1
            kind = kw.pop("kind")
            out.append(Check(n, labels, kind, fr, **kw))
    assert n == 38, n
    return out


def constraint_report(layers, names: list[str] | None = None) -> DataFrame:
    """constraint_name, table_name, constraint_type, violations."""
    checks = constraint_checks(layers.config)
    if names is not None:
        checks = [c for c in checks if c.labels[0] in set(names)]
    df = evaluate(layers, checks, width=3)
    return df.select("id", F.col("label0").alias("constraint_name"), F.col("label1").alias("table_name"),
                     F.col("label2").alias("constraint_type"), "violations").orderBy("id").drop("id")


def declared_constraints() -> list[tuple[str, str, str]]:
    """(constraint_name, table_name, constraint_type) declared in silver."""
    return [c.labels for c in constraint_checks()]
