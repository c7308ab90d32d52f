"""Hot keys: one order / supplier / part holding about a third of the line
items, one customer holding a third of the orders, and duplicated dimension
keys. Results must stay exact (pre-aggregation and count multiplication must
keep the join-then-group multiplicities of the SQL definitions)."""

from __future__ import annotations

import os
import tempfile

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as E
from paths import SF_SMALL
from oracle_util import duck, duck_canon, spark_canon

KEYS = [
    "revenue_metrics", "customer_activity", "customer_activity_latest", "top_suppliers", "top_parts",
    "q1_quarter_revenue", "q3_wow_drop", "q4_company_health", "revenue_drop_alert",
    "validation_report", "constraint_report", "broken_links_partsupp", "broken_links_lineitem_partsupp",
    "broken_links_orders_customer", "duplicate_keys_customer", "balance_lineitem", "profile_order_dates",
    "profile_categories",
]


def _set(table: pa.Table, col: str, mask, value) -> pa.Table:
    i = table.schema.get_field_index(col)
    arr = table.column(col)
    new = pc.if_else(mask, pa.scalar(value, type=arr.type), arr)
    return table.set_column(i, col, new)


@pytest.fixture(scope="module")
def skew_dir(scratch):
    d = tempfile.mkdtemp(prefix="skew-", dir=scratch)
    for t in ("region", "nation", "part", "orders", "lineitem", "customer", "supplier"):
        tab = pq.read_table(os.path.join(SF_SMALL, f"{t}.parquet"))
        if t == "lineitem":
            hot = pc.less_equal(tab.column("l_linenumber"), 2)  # about a third of the rows
            first_order = tab.column("l_orderkey")[0].as_py()
            tab = _set(tab, "l_orderkey", hot, first_order)
            tab = _set(tab, "l_suppkey", hot, tab.column("l_suppkey")[0].as_py())
            tab = _set(tab, "l_partkey", hot, tab.column("l_partkey")[0].as_py())
        elif t == "orders":
            hot = pc.equal(pc.bit_wise_and(tab.column("o_orderkey"), 3), 0)
            tab = _set(tab, "o_custkey", hot, tab.column("o_custkey")[0].as_py())
        elif t in ("customer", "supplier"):
            tab = pa.concat_tables([tab] + [tab.slice(0, 1)] * 40)  # one key 41 times
        pq.write_table(tab, os.path.join(d, f"{t}.parquet"))
    return d


@pytest.fixture(scope="module")
def con(skew_dir):
    return duck(skew_dir)


@pytest.mark.parametrize("key", KEYS)
def test_hot_keys_exact(spark, con, skew_dir, key):
    got = spark_canon(E.queries()[key](spark, skew_dir))
    want = duck_canon(con, E.oracle_sql()[key])
    assert got == want
