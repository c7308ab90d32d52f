"""Declarative table contracts for the silver layer.

A contract is data, not code: the typed column list, the primary key, the
foreign keys and CHECK constraints, the ordered reject branches (condition and
reason text) and the accept condition. ``refine.py`` turns a contract into
Spark plans; ``quality.py`` reads the same contracts. ``contracts_for(config)``
builds them with a configuration's rate bounds.

Conditions are Spark SQL boolean expressions over the *raw* (bronze) columns.
Accept and reject are stated separately on purpose: a NULL measure makes both
NULL, so such a row lands in neither table (see ``refine.unaccounted``).
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from ..config import DEFAULT, Config


@dataclass(frozen=True)
class Col:
    name: str
    type: str  # Spark SQL type of the silver column
    from_text: bool = False  # CAST(TRIM(x) AS type) instead of CAST(x AS type)


@dataclass(frozen=True)
class ForeignKey:
    name: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Check:
    name: str
    condition: str  # over silver columns; NULL counts as satisfied, as in SQL CHECK


@dataclass(frozen=True)
class TableContract:
    table: str
    columns: tuple[Col, ...]
    key: tuple[str, ...]
    key_name: str
    reject: tuple[tuple[str, str], ...]  # ordered (condition, reason); first match wins
    accept: tuple[str, ...]  # all must be TRUE
    not_null: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    checks: tuple[Check, ...] = ()
    # A cheap condition on raw columns that every rejected row satisfies.
    # ANDed into the quarantine filter so Parquet row-group statistics can
    # skip clean data (the exact branches cast to DECIMAL and do not push down).
    reject_hint: str | None = None
    # Equivalent accept / reject branches without DECIMAL casts, valid when
    # every column in ``numeric_inputs`` is numeric (see ``cents_form``).
    fast_accept: tuple[str, ...] | None = None
    fast_reject: tuple[str, ...] | None = None
    numeric_inputs: tuple[str, ...] = ()
    # The key is one integer that the source numbers through: its uniqueness is counted on bitmaps of
    # 32,768 keys. (A sparse key would fill a bitmap for every few keys; leave it undeclared.)
    dense_key: bool = False

    @property
    def column_names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)


def _s(name: str) -> Col:
    return Col(name, "string")


# ---------------------------------------------------------------------------
# The rejection reasons, exactly as the reference writes them,
# with each table's branches in the reference's order.
# ---------------------------------------------------------------------------
UNKNOWN_REASON = "Unknown error"
REASONS = {
    "region": ("NULL value in primary key: r_regionkey",),
    "nation": (
        "NULL value in primary key: n_nationkey",
        "Invalid primary key: n_nationkey must be non-negative",
        "NULL value in foreign key: n_regionkey",
        "Missing or empty nation name: n_name",
    ),
    "customer": (
        "NULL value in primary key: c_custkey",
        "NULL value in foreign key: c_nationkey",
    ),
    "orders": (
        "NULL value in primary key: o_orderkey",
        "NULL value in foreign key: o_custkey",
        "Negative total price",
    ),
    "part": (
        "NULL value in primary key: p_partkey",
        "Negative retail price: p_retailprice",
        "Negative size: p_size",
    ),
    "supplier": (
        "NULL value in primary key: s_suppkey",
        "NULL value in foreign key: s_nationkey",
    ),
    "partsupp": (
        "NULL value in composite primary key (ps_partkey or ps_suppkey)",
        "Negative available quantity: ps_availqty",
        "Negative supply cost: ps_supplycost",
    ),
    "lineitem": (
        "NULL value in composite primary key (l_orderkey or l_linenumber)",
        "NULL value in foreign key columns (l_partkey or l_suppkey)",
        "Discount out of allowed range (0.00 - 0.10)",
        "Tax out of allowed range (0.00 - 0.08)",
        "Negative quantity",
        "Negative extended price",
    ),
}
# ---------------------------------------------------------------------------

_D = "CAST({} AS DECIMAL(18,2))"


# Beyond it a value has no DECIMAL(18,2): the cast gives NULL, so such values
# (and NaN, which sorts above all numbers) satisfy neither form.
_LIMIT = Decimal("9999999999999999.995")


def _cent_in(col: str, lo, hi=None) -> str:
    """CAST(col AS DECIMAL(18,2)) BETWEEN lo AND hi (>= lo without hi), without
    the cast. Rounding to cents is half-up and monotone, so for any numeric input
    the cast is >= lo exactly when the raw value is above lo - 0.005."""
    top = _LIMIT if hi is None else hi + Decimal("0.005")
    return f"{col} > {lo - Decimal('0.005')} AND {col} < {top}"


def _cent_out(col: str, lo, hi=None) -> str:
    """CAST(col AS DECIMAL(18,2)) < lo [OR > hi], without the cast."""
    out = f"({col} <= {lo - Decimal('0.005')} AND {col} > -{_LIMIT})"
    return out if hi is None else f"{out} OR ({col} >= {hi + Decimal('0.005')} AND {col} < {_LIMIT})"


def _branches(table: str, conditions: list[str]) -> tuple[tuple[str, str], ...]:
    reasons = REASONS[table]
    assert len(reasons) == len(conditions)
    return tuple(zip(conditions, reasons))


REGION = TableContract(
    table="region",
    columns=(Col("r_regionkey", "bigint"), _s("r_name"), _s("r_comment")),
    key=("r_regionkey",),
    key_name="pk_region",
    reject=_branches("region", ["r_regionkey IS NULL"]),
    accept=("r_regionkey IS NOT NULL",),
    not_null=("r_regionkey",),
)

NATION = TableContract(
    table="nation",
    columns=(Col("n_nationkey", "bigint"), _s("n_name"), Col("n_regionkey", "bigint"), _s("n_comment")),
    key=("n_nationkey",),
    key_name="pk_nation",
    reject=_branches("nation", [
        "n_nationkey IS NULL",
        "n_nationkey < 0",
        "n_regionkey IS NULL",
        "n_name IS NULL OR TRIM(n_name) = ''",
    ]),
    accept=("n_nationkey IS NOT NULL", "n_nationkey >= 0", "n_regionkey IS NOT NULL",
            "n_name IS NOT NULL", "TRIM(n_name) != ''"),
    not_null=("n_nationkey", "n_regionkey"),
    foreign_keys=(ForeignKey("fk_nation_region", ("n_regionkey",), "region", ("r_regionkey",)),),
)

CUSTOMER = TableContract(
    table="customer",
    columns=(Col("c_custkey", "bigint"), _s("c_name"), _s("c_address"), Col("c_nationkey", "bigint"),
             _s("c_phone"), Col("c_acctbal", "decimal(18,2)"), _s("c_mktsegment"), _s("c_comment")),
    key=("c_custkey",),
    key_name="pk_customer",
    dense_key=True,
    reject=_branches("customer", ["c_custkey IS NULL", "c_nationkey IS NULL"]),
    accept=("c_custkey IS NOT NULL", "c_nationkey IS NOT NULL"),
    not_null=("c_custkey", "c_nationkey"),
    foreign_keys=(ForeignKey("fk_customer_nation", ("c_nationkey",), "nation", ("n_nationkey",)),),
)

ORDERS = TableContract(
    table="orders",
    columns=(Col("o_orderkey", "bigint"), Col("o_custkey", "bigint"), _s("o_orderstatus"),
             Col("o_totalprice", "decimal(18,2)"), Col("o_orderdate", "date"), _s("o_orderpriority"),
             _s("o_clerk"), Col("o_shippriority", "int", from_text=True), _s("o_comment")),
    key=("o_orderkey",),
    key_name="pk_orders",
    dense_key=True,
    reject=_branches("orders", ["o_orderkey IS NULL", "o_custkey IS NULL", "o_totalprice < 0"]),
    accept=("o_orderkey IS NOT NULL", "o_custkey IS NOT NULL", "o_totalprice >= 0"),
    not_null=("o_orderkey", "o_custkey"),
    foreign_keys=(ForeignKey("fk_orders_customer", ("o_custkey",), "customer", ("c_custkey",)),),
)

PART = TableContract(
    table="part",
    columns=(Col("p_partkey", "bigint"), _s("p_name"), _s("p_mfgr"), _s("p_brand"), _s("p_type"),
             Col("p_size", "int"), _s("p_container"), Col("p_retailprice", "decimal(18,2)"), _s("p_comment")),
    key=("p_partkey",),
    key_name="pk_part",
    dense_key=True,
    reject=_branches("part", ["p_partkey IS NULL", "p_retailprice < 0", "p_size < 0"]),
    accept=("p_partkey IS NOT NULL", "p_retailprice >= 0", "p_size >= 0"),
    not_null=("p_partkey",),
    checks=(Check("chk_part_retailprice", "p_retailprice >= 0"), Check("chk_part_size", "p_size >= 0")),
)

SUPPLIER = TableContract(
    table="supplier",
    columns=(Col("s_suppkey", "bigint"), _s("s_name"), _s("s_address"), Col("s_nationkey", "bigint"),
             _s("s_phone"), Col("s_acctbal", "decimal(18,2)"), _s("s_comment")),
    key=("s_suppkey",),
    key_name="pk_supplier",
    dense_key=True,
    reject=_branches("supplier", ["s_suppkey IS NULL", "s_nationkey IS NULL"]),
    accept=("s_suppkey IS NOT NULL", "s_nationkey IS NOT NULL"),
    not_null=("s_suppkey", "s_nationkey"),
    foreign_keys=(ForeignKey("fk_supplier_nation", ("s_nationkey",), "nation", ("n_nationkey",)),),
)

PARTSUPP = TableContract(
    table="partsupp",
    columns=(Col("ps_partkey", "bigint"), Col("ps_suppkey", "bigint"), Col("ps_availqty", "int"),
             Col("ps_supplycost", "decimal(18,2)"), _s("ps_comment")),
    key=("ps_partkey", "ps_suppkey"),
    key_name="pk_partsupp",
    reject=_branches("partsupp", [
        "ps_partkey IS NULL OR ps_suppkey IS NULL",
        "ps_availqty < 0",
        "ps_supplycost < 0",
    ]),
    accept=("ps_partkey IS NOT NULL", "ps_suppkey IS NOT NULL", "ps_availqty >= 0", "ps_supplycost >= 0"),
    not_null=("ps_partkey", "ps_suppkey"),
    foreign_keys=(
        ForeignKey("fk_partsupp_part", ("ps_partkey",), "part", ("p_partkey",)),
        ForeignKey("fk_partsupp_supplier", ("ps_suppkey",), "supplier", ("s_suppkey",)),
    ),
    checks=(Check("chk_partsupp_availqty", "ps_availqty >= 0"),
            Check("chk_partsupp_supplycost", "ps_supplycost >= 0")),
)

def lineitem(config: Config = DEFAULT) -> TableContract:
    """The lineitem contract with the configuration's rate bounds."""
    (d_lo, d_hi), (t_lo, t_hi) = config.discount_bounds, config.tax_bounds
    reject = _branches("lineitem", [
        "l_orderkey IS NULL OR l_linenumber IS NULL",
        "l_partkey IS NULL OR l_suppkey IS NULL",
        f"{_D.format('l_discount')} < {d_lo} OR {_D.format('l_discount')} > {d_hi}",
        f"{_D.format('l_tax')} < {t_lo} OR {_D.format('l_tax')} > {t_hi}",
        f"{_D.format('l_quantity')} < 0",
        f"{_D.format('l_extendedprice')} < 0",
    ])
    # the reasons name the bounds in use
    was = f"({DEFAULT.discount_bounds[0]:.2f} - {DEFAULT.discount_bounds[1]:.2f})", f"({DEFAULT.tax_bounds[0]:.2f} - {DEFAULT.tax_bounds[1]:.2f})"
    now = f"({d_lo:.2f} - {d_hi:.2f})", f"({t_lo:.2f} - {t_hi:.2f})"
    reject = tuple((c, r.replace(was[0], now[0]) if "Discount" in r else r.replace(was[1], now[1]) if "Tax" in r else r) for c, r in reject)
    keys = ("l_orderkey IS NOT NULL", "l_linenumber IS NOT NULL", "l_partkey IS NOT NULL", "l_suppkey IS NOT NULL")
    return TableContract(
        table="lineitem",
        columns=(Col("l_orderkey", "bigint"), Col("l_partkey", "bigint"), Col("l_suppkey", "bigint"),
                 Col("l_linenumber", "int"), Col("l_quantity", "decimal(18,2)"),
                 Col("l_extendedprice", "decimal(18,2)"), Col("l_discount", "decimal(4,2)"),
                 Col("l_tax", "decimal(4,2)"), _s("l_returnflag"), _s("l_linestatus"), Col("l_shipdate", "date"),
                 Col("l_commitdate", "date"), Col("l_receiptdate", "date"), _s("l_shipinstruct"),
                 _s("l_shipmode"), _s("l_comment")),
        key=("l_orderkey", "l_linenumber"),
        key_name="pk_lineitem",
        reject=reject,
        accept=(
            *keys,
            f"{_D.format('l_discount')} BETWEEN {d_lo} AND {d_hi}",
            f"{_D.format('l_tax')} BETWEEN {t_lo} AND {t_hi}",
            f"{_D.format('l_quantity')} >= 0",
            f"{_D.format('l_extendedprice')} >= 0",
        ),
        not_null=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        foreign_keys=(
            ForeignKey("fk_lineitem_orders", ("l_orderkey",), "orders", ("o_orderkey",)),
            ForeignKey("fk_lineitem_partsupp", ("l_partkey", "l_suppkey"), "partsupp", ("ps_partkey", "ps_suppkey")),
        ),
        checks=(
            Check("chk_lineitem_discount", f"l_discount >= {d_lo:.2f} AND l_discount <= {d_hi}"),
            Check("chk_lineitem_tax", f"l_tax >= {t_lo:.2f} AND l_tax <= {t_hi}"),
        ),
        fast_accept=(*keys, _cent_in("l_discount", d_lo, d_hi), _cent_in("l_tax", t_lo, t_hi),
                     _cent_in("l_quantity", 0), _cent_in("l_extendedprice", 0)),
        fast_reject=(
            reject[0][0],
            reject[1][0],
            _cent_out("l_discount", d_lo, d_hi),
            _cent_out("l_tax", t_lo, t_hi),
            _cent_out("l_quantity", 0),
            _cent_out("l_extendedprice", 0),
        ),
        numeric_inputs=("l_discount", "l_tax", "l_quantity", "l_extendedprice"),
        # Rounding to cents is monotone, so a rejected rate or amount is already
        # outside the bounds before the cast.
        reject_hint=(
            "l_orderkey IS NULL OR l_linenumber IS NULL OR l_partkey IS NULL OR l_suppkey IS NULL"
            f" OR l_discount < {d_lo} OR l_discount > {d_hi}"
            f" OR l_tax < {t_lo} OR l_tax > {t_hi} OR l_quantity < 0 OR l_extendedprice < 0"
        ),
    )


def contracts_for(config: Config = DEFAULT) -> dict[str, TableContract]:
    """The eight contracts under a configuration."""
    return {c.table: c for c in (REGION, NATION, CUSTOMER, ORDERS, PART, SUPPLIER, PARTSUPP, lineitem(config))}


CONTRACTS: dict[str, TableContract] = contracts_for()
