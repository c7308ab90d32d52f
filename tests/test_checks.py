"""The check evaluator against counts by hand, and the plan it makes."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from lakemart.config import DEFAULT
from lakemart.operators import profile, quality
from lakemart.operators.checks import Check, distinct_integers, evaluate
from lakemart.plans.layers import Layers
from lakemart.plans.registry import REGISTRY, Env
from paths import SF_SMALL


class Frames(Layers):
    """Named frames as layers."""

    def __init__(self, spark, frames):
        self.spark, self.frames, self.config = spark, frames, DEFAULT

    def silver(self, t):
        return self.frames[t]


@pytest.mark.parametrize("kind", ["bigint", "string"])
@pytest.mark.parametrize("seed", [1, 2])
def test_counts_equal_counting_by_hand(spark, kind, seed):
    rng = random.Random(seed)
    as_key = (lambda v: v) if kind == "bigint" else (lambda v: None if v is None else f"k{v}")
    key = lambda: as_key(rng.choice([None, *range(12)]))
    child = [(key(), key(), rng.choice([None, *range(5)])) for _ in range(rng.choice([0, 80]) if seed == 2 else 80)]
    parent = [(key(), key()) for _ in range(25)]
    layers = Frames(spark, {"child": spark.createDataFrame(child, f"a {kind}, b {kind}, v int"),
                            "parent": spark.createDataFrame(parent, f"a {kind}, b {kind}")})
    c, p = ("silver", "child"), ("silver", "parent")
    one, two = dict(key=("a",), parent=p, parent_key=("a",)), dict(key=("a", "b"), parent=p, parent_key=("a", "b"))
    checks = [Check(1, ("where",), "where", c, condition="v > 2"), Check(2, ("rows",), "rows", c, sign=-1, finish="abs"),
              Check(3, ("dup1",), "duplicates", c, key=("a",)), Check(4, ("dup2",), "duplicates", c, key=("a", "b")),
              Check(5, ("dense",), "duplicates", c, key=("a",), dense=True),
              Check(6, ("lost1",), "orphans", c, **one), Check(7, ("lost2",), "orphans", c, **two),
              Check(8, ("lost2 known",), "orphans", c, **two, null_ok=True),
              Check(9, ("childless",), "orphans", p, key=("a",), parent=c, parent_key=("a",)),
              Check(10, ("empty",), "rows", c, finish="is_empty")]
    got = {r["label0"]: r["violations"] for r in evaluate(layers, checks).collect()}
    of = lambda rows, n: [r[:n] for r in rows]
    whole = lambda rows, n: [r for r in of(rows, n) if None not in r]
    lost = lambda xs, ys, n: sum(None in x or x not in whole(ys, n) for x in of(xs, n))
    assert got == {
        "where": sum(v is not None and v > 2 for *_, v in child), "rows": len(child), "empty": int(not child),
        "dup1": len(child) - len(set(whole(child, 1))), "dense": len(child) - len(set(whole(child, 1))),
        "dup2": len(child) - len(set(whole(child, 2))), "lost1": lost(child, parent, 1), "lost2": lost(child, parent, 2),
        "lost2 known": sum(x not in whole(parent, 2) for x in whole(child, 2)), "childless": lost(parent, child, 1)}


def test_distinct_integers_on_bitmaps(spark):
    values = [None, None, 0, 1, 1, -1, -32768, 32767, 32768, 32768, 2**40, 2**40 + 1, -(2**40)] + list(range(100_000, 170_000))
    df = spark.createDataFrame([(v,) for v in values], "k bigint")
    assert tuple(distinct_integers(df, "k").first()) == (len(values), 2, len({v for v in values if v is not None}))
    assert tuple(distinct_integers(df.where("false"), "k").first()) == (0, 0, 0)
    # shuffled: a row for each range of 32,768, not one for each key
    many = spark.range(0, 2_000_000, 1, 4).selectExpr("id AS k")
    assert many.groupBy("k").count().count() == 2_000_000
    assert many.selectExpr("bitmap_bucket_number(k) AS r").distinct().count() == 2_000_000 // 32768 + 2
    text = distinct_integers(many, "k")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_" in text and "hashpartitioning(id" not in text


def test_order_dates_for_integer_and_text_keys(spark):
    import datetime as dt

    rows = [(1, dt.date(1995, 1, 2)), (1, dt.date(1995, 1, 1)), (None, None), (70_000, dt.date(1996, 5, 5)), (-3, None)]
    customer = spark.createDataFrame([(1,), (2,)], "c_custkey bigint")
    want = (dt.date(1995, 1, 1), dt.date(1996, 5, 5), 5, 3, 2)
    for kind in ("bigint", "string"):
        orders = spark.createDataFrame(rows, "o_custkey bigint, o_orderdate date").selectExpr(f"CAST(o_custkey AS {kind}) AS o_custkey", "o_orderdate")
        assert tuple(profile.order_dates(orders, customer).first()) == want
        none = orders.where("false")
        assert tuple(profile.order_dates(none, customer).first()) == (None, None, 0, 0, 2)


def executed_scans(df, *columns):
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return sum("FileScan parquet" in line and any(c in line for c in columns) for line in final.splitlines())


def test_reports_read_each_fact_table_a_few_times(spark):
    """One scan expands into all key sets; the dated checks and the derived partsupp take one more each."""
    env = Env(spark, SF_SMALL)
    assert executed_scans(REGISTRY["validation_report"](env), "l_orderkey", "l_partkey") <= 3
    assert executed_scans(REGISTRY["constraint_report"](env), "l_orderkey", "l_partkey") <= 2
    lone = quality.validation_report(env.fx, [18, 19, 21, 22, 23, 27, 28, 29, 37, 39, 40, 41, 49, 50])
    assert executed_scans(lone, "l_orderkey", "l_partkey") == 1


def test_generated_methods_stay_below_the_limit_of_the_jvm(spark):
    """No stage runs with a method that the JVM does not compile: it is split by operator instead."""
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    env = Env(spark, SF_SMALL)
    for key in ("silver_lineitem", "quarantine_lineitem"):
        df = REGISTRY[key](env)
        df.collect()
        assert "FileScan" in df._jdf.queryExecution().executedPlan().toString()


def test_more_than_two_key_columns_are_refused(spark):
    layers = Frames(spark, {"child": spark.createDataFrame([(1, 2, 3)], "a int, b int, v int")})
    with pytest.raises(ValueError):
        evaluate(layers, [Check(1, ("x",), "duplicates", ("silver", "child"), key=("a", "b", "v"))])


def test_masks_tell_combinations_apart(spark):
    rows = [(i,) for i in range(64)]
    layers = Frames(spark, {"child": spark.createDataFrame(rows, "v int")})
    checks = [Check(i + 1, (f"bit{i}",), "where", ("silver", "child"), condition=f"(v >> {i}) & 1 = 1") for i in range(6)]
    assert Counter(r["violations"] for r in evaluate(layers, checks).collect()) == {32: 6}
