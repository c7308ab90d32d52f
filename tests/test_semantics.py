"""Hand-made rows for the semantics that are easy to get wrong."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakemart.config import DEFAULT
from lakemart.operators import marts, monitor, quality, refine
from lakemart.operators.contracts import CONTRACTS, REASONS, UNKNOWN_REASON
from lakemart.plans.layers import LazyLayers
from lakemart.sources.tables import FrameSource

D = dt.date.fromisoformat

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "partsupp": "ps_partkey bigint, ps_suppkey bigint, ps_availqty int, ps_supplycost double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate date, o_orderpriority string, o_shippriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate date, l_commitdate date, l_receiptdate date, l_shipmode string"),
}


def li(orderkey=1, partkey=1, suppkey=1, line=1, qty=1.0, price=100.0, disc=0.05, tax=0.02,
       ship=D("1998-01-05")):
    return (orderkey, partkey, suppkey, line, qty, price, disc, tax, "N", "O", ship, ship, ship, "AIR")


def order(key=1, cust=1, price=10.0, date=D("1998-01-01"), prio="1-URGENT", ship="0"):
    return (key, cust, "O", price, date, prio, ship)


def frames(spark, **rows):
    return {t: spark.createDataFrame(rows.get(t, []), SCHEMAS[t]) for t in SCHEMAS}


def layers(spark, **rows):
    return LazyLayers(FrameSource(spark, frames(spark, **rows)), DEFAULT)


def reasons(df):
    return [r["rejection_reason"] for r in df.orderBy("l_orderkey").collect()]


def test_branch_order_first_match_wins(spark):
    df = spark.createDataFrame([li(partkey=None, disc=0.15)], SCHEMAS["lineitem"])
    q = refine.quarantine(df, CONTRACTS["lineitem"])
    assert reasons(q) == [REASONS["lineitem"][1]]
    assert refine.clean(df, CONTRACTS["lineitem"]).isEmpty()


def test_round_before_range(spark):
    df = spark.createDataFrame([li(orderkey=1, disc=0.104), li(orderkey=2, disc=0.105)], SCHEMAS["lineitem"])
    s = refine.clean(df, CONTRACTS["lineitem"]).collect()
    assert [(r.l_orderkey, r.l_discount) for r in s] == [(1, Decimal("0.10"))]
    assert reasons(refine.quarantine(df, CONTRACTS["lineitem"])) == [REASONS["lineitem"][2]]


def test_null_gap_and_strict(spark):
    df = spark.createDataFrame([order(price=None)], SCHEMAS["orders"])
    c = CONTRACTS["orders"]
    assert refine.clean(df, c).isEmpty()
    assert refine.quarantine(df, c).isEmpty()
    assert refine.unaccounted(df, c).count() == 1
    strict = refine.quarantine(df, c, strict=True).collect()
    assert [r.rejection_reason for r in strict] == [UNKNOWN_REASON]
    b = refine.balance(df, c).collect()[0]
    assert (b.bronze_received, b.silver_delivered, b.quarantine_rejected, b.missing_rows) == (1, 0, 0, 1)


def test_zero_quantity_passes_silver_but_fails_rules(spark):
    lay = layers(spark, lineitem=[li(qty=0.0)], orders=[order()])
    assert lay.silver("lineitem").count() == 1
    got = {r.rule: r.violations for r in quality.validation_report(lay, [21, 41], with_timestamp=False).collect()}
    assert got == {"lineitem: quantity and price strictly positive": 1, "lineitem: quantity strictly positive": 1}


def test_trim_and_text_int(spark):
    df = spark.createDataFrame([order(prio="  1-URGENT ", ship=" 0 ")], SCHEMAS["orders"])
    r = refine.clean(df, CONTRACTS["orders"]).collect()[0]
    assert r.o_orderpriority == "1-URGENT" and r.o_shippriority == 0
    assert dict(refine.clean(df, CONTRACTS["orders"]).dtypes)["o_shippriority"] == "int"


def test_missing_contract_columns_are_typed_nulls(spark):
    df = spark.createDataFrame([order()], SCHEMAS["orders"])
    s = refine.clean(df, CONTRACTS["orders"])
    assert s.columns == list(CONTRACTS["orders"].column_names)
    assert dict(s.dtypes)["o_clerk"] == "string" and s.collect()[0].o_clerk is None


def test_duplicate_key_kept_and_counted(spark):
    lay = layers(spark, region=[(1, "A"), (1, "B")])
    assert lay.silver("region").count() == 2
    r = quality.validation_report(lay, [30], with_timestamp=False).collect()[0]
    assert r.violations == 1 and r.passed is False


def test_customer_activity_edges(spark):
    as_of = D("1998-08-02")
    cust = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "c_custkey bigint, c_name string")
    o = spark.createDataFrame(
        [(2, D("1997-08-02")), (3, D("1997-08-03")), (4, D("1997-09-01")), (4, D("1998-09-01"))],
        "o_custkey bigint, o_orderdate date")
    got = {r.c_custkey: (r.last_order_date, r.is_active_trailing_12m)
           for r in marts.customer_activity(cust, o, as_of).collect()}
    assert got[1] == (None, False)          # no orders: kept, inactive, never NULL
    assert got[2][1] is False               # exactly as_of - 365: excluded
    assert got[3][1] is True                # one day later: active
    assert got[4][1] is False               # latest order after as_of: inactive


def weekly(spark, rows):
    return spark.createDataFrame([(D(w), Decimal(v)) for w, v in rows], "week_start date, weekly_revenue decimal(38,4)")


def test_missing_week_row_vs_calendar(spark):
    w = weekly(spark, [("1998-01-05", "100"), ("1998-01-19", "50")])
    row = monitor.revenue_drops(w, adjacency="row", weeks="all")
    cal = monitor.revenue_drops(w, adjacency="calendar", weeks="all")
    assert row.count() == 1 and cal.count() == 0


def test_exactly_twenty_percent(spark):
    w = weekly(spark, [("1998-01-05", "100"), ("1998-01-12", "80")])
    assert monitor.revenue_drops(w, adjacency="row", weeks="all", inclusive=True).count() == 1
    assert monitor.revenue_drops(w, adjacency="row", weeks="all", inclusive=False).count() == 0


def test_first_week_is_dropped(spark):
    w = weekly(spark, [("1998-01-05", "100"), ("1998-01-12", "50"), ("1998-01-19", "50")])
    assert monitor.revenue_drops(w, weeks="all").count() == 1
    assert monitor.revenue_drops(w, weeks="drop_first").count() == 0


def test_partial_week_not_compared(spark):
    days = [D("1998-01-05") + dt.timedelta(days=i) for i in range(7)] + [D("1998-01-12") + dt.timedelta(days=i)
                                                                         for i in range(3)]
    orders = spark.createDataFrame([(d,) for d in days], "o_orderdate date")
    w = weekly(spark, [("1998-01-05", "100"), ("1998-01-12", "10")])
    assert monitor.revenue_drops(w, adjacency="calendar", weeks="all").count() == 1
    assert monitor.revenue_drops(w, adjacency="calendar", weeks="complete", orders=orders).count() == 0


def test_planted_drop_flagged_by_every_variant(spark):
    """Pick a complete week from the data, bring it to 50 % of the week before."""
    from paths import SF_MID
    from lakemart.plans.registry import Env
    from lakemart.operators.periods import period_days

    e = Env(spark, SF_MID)
    w = monitor.weekly_revenue(e.raw.gold("revenue_metrics"))
    done = [r.period_start for r in period_days(e.raw.bronze("orders"), "week").where("is_complete")
            .orderBy("period_start").collect()]
    rows = {r.week_start: r.weekly_revenue for r in w.collect()}
    cut = done[len(done) // 2]
    prev = cut - dt.timedelta(days=7)
    assert prev in done
    factor = (rows[prev] * Decimal("0.5")) / rows[cut]
    planted = w.select("week_start", F.when(F.col("week_start") == F.lit(cut), F.col("weekly_revenue") * F.lit(factor))
                       .otherwise(F.col("weekly_revenue")).cast("decimal(38,4)").alias("weekly_revenue"))
    for kw in (dict(adjacency="row", weeks="drop_first"),
               dict(adjacency="calendar", weeks="all", inclusive=True),
               dict(adjacency="calendar", weeks="complete", orders=e.raw.bronze("orders"))):
        hit = [r.week_start for r in monitor.revenue_drops(planted, **kw).collect()]
        assert cut in hit, kw


def test_empty_gold_rules(spark):
    lay = layers(spark)
    got = {r.rule: r.violations for r in quality.validation_report(lay, [47, 52], with_timestamp=False).collect()}
    assert got == {quality.NAMES_GOLD[0]: 0, quality.NAMES_GOLD[5]: 1}


def test_fused_report_equals_individual_rules(spark):
    from paths import SF_SMALL
    from lakemart.plans.registry import Env

    e = Env(spark, SF_SMALL)
    fused = [(r.layer, r.rule, r.violations) for r in quality.validation_report(e.fx, with_timestamp=False).collect()]
    single = [tuple(quality.rule(e.fx, n).collect()[0]) for n in range(1, 53)]
    assert fused == single
    assert len(fused) == 52


def test_silver_quarantine_disjoint_and_complete(spark):
    from paths import SF_SMALL
    from lakemart.plans.registry import Env

    e = Env(spark, SF_SMALL)
    for t, c in CONTRACTS.items():
        b = e.fx.bronze(t)
        n, s, q, u = b.count(), e.fx.silver(t).count(), e.fx.quarantine(t).count(), refine.unaccounted(b, c).count()
        assert n == s + q + u, t
        assert refine.quarantine(b, c, strict=True).count() == q + u, t


def test_validation_report_shape_and_fail_on_error(spark):
    lay = layers(spark, region=[(1, "A"), (1, "B")])
    rep = quality.validation_report(lay)
    assert rep.columns == ["layer", "rule", "violations", "passed", "checked_at"]
    assert rep.count() == 52
    with pytest.raises(AssertionError):
        quality.assert_valid(rep)


def test_declared_constraints():
    decl = quality.declared_constraints()
    assert len(decl) == 38
    kinds = [k for _, _, k in decl]
    assert (kinds.count("NOT NULL"), kinds.count("PRIMARY KEY"), kinds.count("FOREIGN KEY"), kinds.count("CHECK")) \
        == (16, 8, 8, 6)


def test_cast_free_cent_bounds_equal_cast_form(spark):
    """The cast-free lineitem predicates agree with the DECIMAL-cast ones on
    every value around each half-cent boundary (DOUBLE and DECIMAL inputs)."""
    import math
    import random

    from lakemart.operators.refine import accept_sql, reject_sql

    c = CONTRACTS["lineitem"]
    edges = [-0.015, -0.01, -0.005, 0.0, 0.005, 0.075, 0.08, 0.085, 0.095, 0.1, 0.104, 0.105, 0.11, 0.15, 1.0]
    vals = set()
    for e in edges:
        x = e
        for _ in range(3):
            vals.add(x)
            x = math.nextafter(x, math.inf)
        x = e
        for _ in range(3):
            vals.add(x)
            x = math.nextafter(x, -math.inf)
    rng = random.Random(7)
    vals |= {round(rng.uniform(-0.02, 0.12), rng.choice([2, 3, 4, 6])) for _ in range(300)}
    finite = sorted(vals)
    vals = finite + [math.nan, math.inf, -math.inf]
    rows = [(1, 1, 1, 1, v, v, v, v) for v in vals] + [(1, 1, 1, 1, None, 1.0, 0.05, 0.02)]
    rows += [(1, 1, 1, 1, *[v if i == k else 0.05 for i in range(4)]) for v in vals[-3:] for k in range(4)]
    cols = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, " \
           "l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    for typ in ("double", "float", "decimal(12,6)"):
        these = [r for r in rows if typ != "decimal(12,6)" or all(v is None or math.isfinite(v) for v in r)]
        df = spark.createDataFrame(these, cols).selectExpr(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
            *[f"CAST({k} AS {typ}) AS {k}" for k in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")])
        fast_a, fast_r = accept_sql(c, df), reject_sql(c, df)
        cast_a, cast_r = accept_sql(c), reject_sql(c)
        assert fast_a != cast_a  # the cast-free form is in use for numeric inputs
        # TRUE or not: NULL and FALSE both keep a row out
        is_true = [f"coalesce({x}, false) AS {n}" for x, n in ((fast_a, "a"), (fast_r, "r"), (cast_a, "ca"), (cast_r, "cr"))]
        got = df.selectExpr(*is_true).collect()
        for row, v in zip(got, these):
            assert (row.a, row.r) == (row.ca, row.cr), (typ, v)


LINE = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity {0}, l_extendedprice {0}, l_discount {0}, l_tax {0}, " \
       "l_returnflag string, l_linestatus string, l_shipdate date"


def test_text_measures_split_like_numbers(spark):
    from decimal import Decimal

    values = [(1.0, 5.0, 0.05, 0.02), (1.0, 5.0, 0.15, 0.02), (1.0, 5.0, 0.104, 0.02), (-1.0, 5.0, 0.05, 0.02), (1.0, 5.0, None, 0.02)]
    c = CONTRACTS["lineitem"]
    split = {}
    for typ, make in (("double", float), ("string", str), ("decimal(12,4)", lambda v: Decimal(str(v)))):
        df = spark.createDataFrame([(i, 1, 1, 1, *[None if v is None else make(v) for v in row], "N", "O", None) for i, row in enumerate(values)],
                                   LINE.format(typ))
        split[typ] = (sorted(r.l_orderkey for r in refine.clean(df, c).collect()),
                      sorted((r.l_orderkey, r.rejection_reason) for r in refine.quarantine(df, c).collect()),
                      sorted(r.l_orderkey for r in refine.unaccounted(df, c).collect()))
    assert split["double"][0] == [0, 2] and split["double"][2] == [4]
    assert split["string"] == split["double"] == split["decimal(12,4)"]


def test_two_configurations_side_by_side(spark):
    from decimal import Decimal

    from lakemart.config import Config
    from lakemart.plans.layers import LazyLayers
    from lakemart.sources.tables import FrameSource

    df = spark.createDataFrame([(i, 1, 1, 1, 1.0, 5.0, d, 0.02, "N", "O", None) for i, d in enumerate((0.03, 0.07, 0.2))], LINE.format("double"))
    src = FrameSource(spark, {"lineitem": df})
    wide, narrow = LazyLayers(src), LazyLayers(src, Config(discount_bounds=(Decimal("0"), Decimal("0.05"))))
    assert [sorted(r.l_orderkey for r in x.silver("lineitem").collect()) for x in (wide, narrow)] == [[0, 1], [0]]
    reasons = {r.l_orderkey: r.rejection_reason for r in narrow.quarantine("lineitem").collect()}
    assert reasons == {1: "Discount out of allowed range (0.00 - 0.05)", 2: "Discount out of allowed range (0.00 - 0.05)"}


def test_a_needed_column_must_be_there(spark):
    with pytest.raises(ValueError, match="c_name"):
        refine.clean(spark.createDataFrame([(1, 2)], "c_custkey long, c_nationkey long"), CONTRACTS["customer"])


def test_results_come_in_order(spark):
    import __spark_entry__ as E

    for key, column in (("weekly_revenue", "week_start"), ("q1_quarter_revenue", "quarter_start"), ("q3_wow_drop", "current_week"),
                        ("q3_wow_drop_simulated", "current_week")):
        got = [r[column] for r in E.queries()[key](spark, "/root/testdata/sf0.001").collect()]
        assert got and got == sorted(got), key


def test_a_repeated_dimension_key_stays_exact_and_small(spark):
    """40,000 copies of one supplier: the join gets one row for them, the sums are multiplied."""
    from decimal import Decimal

    from lakemart.operators import marts

    dim = spark.range(40_000).selectExpr("7L AS s_suppkey", "'x' AS s_name").union(spark.createDataFrame([(8, "y")], "s_suppkey long, s_name string"))
    fact = spark.createDataFrame([(7, Decimal("1.50"), Decimal("0.00")), (7, Decimal("2.00"), Decimal("0.10")), (8, Decimal("1.00"), Decimal("0.00"))],
                                 "l_suppkey long, l_extendedprice decimal(18,2), l_discount decimal(4,2)")
    counted = marts._counted(dim, "s_suppkey", "s_name")
    assert sorted((r.s_suppkey, r._n) for r in counted.collect()) == [(7, 40_000), (8, 1)]
    got = {r.s_suppkey: r.total_revenue_contribution for r in marts.top_suppliers(dim, fact).collect()}
    assert got == {7: Decimal("132000.0000"), 8: Decimal("1.0000")}
