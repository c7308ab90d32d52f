"""Physical-plan properties the design relies on."""

from __future__ import annotations

import __spark_entry__ as E
from paths import SF_SMALL
from lakemart.plans.registry import REGISTRY, Env


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_cartesian_or_nested_loop_joins(spark):
    qs = {k: f for k, f in E.queries().items() if k in REGISTRY}
    for k, fn in qs.items():
        p = formatted(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in p, k
        assert "BroadcastNestedLoopJoin" not in p, k


def test_marts_prune_columns(spark):
    p = formatted(Env(spark, SF_SMALL).raw.gold("revenue_metrics"))
    # lineitem scan reads only what the revenue and the accept predicate need.
    li = [l for l in p.splitlines() if l.startswith("ReadSchema") and "l_orderkey" in l]
    assert li and all("l_returnflag" not in l and "l_linestatus" not in l for l in li)


def test_quarantine_filter_pushed_to_parquet(spark):
    p = formatted(Env(spark, SF_SMALL).raw.quarantine("lineitem"))
    pushed = [l for l in p.splitlines() if l.startswith("PushedFilters")]
    assert pushed and any("IsNull(l_orderkey)" in l and "LessThan(l_quantity" in l for l in pushed)


def test_marts_pre_aggregate_fact_side(spark):
    p = formatted(Env(spark, SF_SMALL).raw.gold("top_suppliers"))
    # partial aggregation of lineitem by supplier happens before any join
    assert "partial_sum" in p
    assert p.index("partial_sum") > p.index("Join")  # formatted lists the join first, its inputs after


def test_silver_filter_has_no_decimal_casts_for_numeric_input(spark):
    p = formatted(Env(spark, SF_SMALL).raw.silver("lineitem"))
    conds = [l for l in p.splitlines() if l.startswith("Condition")]
    assert conds and not any("as decimal" in l for l in conds)
    # the output is still typed by casts in the projection
    assert "cast(l_discount" in p and "decimal(4,2)" in p


def test_q1_date_range_reaches_orders_scan(spark):
    p = formatted(E.queries()["q1_quarter_revenue"](spark, SF_SMALL))
    pushed = [l for l in p.splitlines() if l.startswith("PushedFilters") and "o_orderdate" in l]
    assert pushed and "GreaterThanOrEqual(o_orderdate" in pushed[0] and "LessThan(o_orderdate" in pushed[0]


def test_marts_shuffle_lineitem_once_at_scale(spark):
    """With broadcasts off (as at 100 TB) each mart exchanges its fact table
    once, for the aggregate, and the sort-merge join reuses that partitioning;
    the group by after the join needs no exchange (revenue adds one tiny
    per-day one)."""
    import re

    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # the fact side once; the dimension side by payload (repeated keys are counted map-side), then by key
        want = {"revenue_metrics": (4, "l_orderkey"), "customer_activity": (3, "o_custkey"),
                "top_suppliers": (3, "l_suppkey"), "top_parts": (3, "l_partkey")}
        for k, (n, fact_key) in want.items():
            p = E.queries()[k](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
            ex = re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition)", p)
            assert len(ex) == n, (k, ex)
            assert sum(1 for e in ex if fact_key in e) == 1, (k, ex)  # fact side: one exchange
            assert "SortMergeJoin" in p, k
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def executed_scans(df, column: str) -> int:
    """Scans of the table with ``column`` in the final adaptive plan (reused exchanges run once)."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    return sum("FileScan parquet" in line and column in line for line in final.splitlines())


def test_weeks_are_computed_once(spark):
    env = Env(spark, SF_SMALL)
    for key in ("revenue_drop_alert", "weekly_revenue_without_first", "wow_change", "revenue_alert_status"):
        assert executed_scans(REGISTRY[key](env), "l_orderkey") == 1, key
    assert executed_scans(REGISTRY["complete_periods"](env), "o_orderdate") == 1
