"""Every registered query against its independent SQL oracle (DuckDB)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from paths import SF_MID, SF_SMALL
from oracle_util import duck, duck_canon, duck_types, spark_canon, spark_types

from lakemart.plans import registry

QUERIES = {k: v for k, v in E.queries().items() if k in registry.REGISTRY}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k in registry.REGISTRY}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    got = spark_canon(df)
    want = duck_canon(con, ORACLE[key])
    assert spark_types(df) == duck_types(con, ORACLE[key]), "column types differ"
    assert got[0] == want[0], "columns differ"
    assert len(got[1]) == len(want[1]), "row counts differ"
    assert got[1] == want[1], "values differ"


#: Nothing can make these fail: no row is left out by both sides, or silver filters them.
NEVER = {"rule_9", "rule_10", "rule_11", "rule_12", "rule_40", "rule_42", "rule_51", "rule_52"}


def test_checks_have_something_to_find():
    """At sf0.01 every rule and constraint has violations, every duplicate-key audit rows."""
    big = duck(SF_MID)
    for key, sql in ORACLE.items():
        if key.startswith(("rule_", "constraint_")) and key != "constraint_report" and key not in NEVER:
            assert big.execute(sql).fetchall()[0][-1] > 0, key
        if key.startswith("duplicate_keys_"):
            assert big.execute(sql).fetchall(), key


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["quarter_start", "total_revenue", "prev_quarter_revenue", "revenue_qoq_pct"]
    assert len(rows) == 2 and rows[0]["prev_quarter_revenue"] is None
