"""Named query plans: key -> builder(Env) -> DataFrame.

Two scenarios over one source directory (see ``oracle.py``):
``raw`` (the driver's tables as bronze) for marts, monitoring, questions and
profiling; ``fx`` (dirty fixture views as bronze) for silver, quarantine,
constraints, audits and rules, so each of them has violations to find.
Every plan reads whole tables; nothing is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, TABLES, Config
from ..operators import audits, marts, monitor, profile, quality, questions, refine
from ..operators.contracts import contracts_for
from ..sources.fixtures import fixture_source
from ..sources.tables import ParquetSource
from .layers import LazyLayers, LossyLayers, TypedLayers

RAW_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


class Env:
    """Lazy scenarios over one source directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, config: Config = DEFAULT):
        self.spark = spark
        self.sf_dir = sf_dir
        self.config = config
        self.base = ParquetSource(spark, sf_dir)

    @cached_property
    def raw(self) -> LazyLayers:
        return LazyLayers(self.base, self.config)

    @cached_property
    def fx_source(self):
        return fixture_source(self.base)

    @cached_property
    def fx(self) -> LazyLayers:
        return LazyLayers(self.fx_source, self.config)


    @cached_property
    def typed(self) -> TypedLayers:
        return TypedLayers(self.fx_source, self.config)

    @cached_property
    def lossy(self) -> LossyLayers:
        return LossyLayers(self.fx_source, self.config)


Builder = Callable[[Env], DataFrame]
REGISTRY: dict[str, Builder] = {}


def register(key: str, fn: Builder) -> None:
    assert key not in REGISTRY, key
    REGISTRY[key] = fn


# ---- 2.1 sources and bronze ---------------------------------------------------
for _t in TABLES:
    if _t in RAW_TABLES:
        register(f"scan_{_t}", lambda e, t=_t: e.base.table(t))
    else:  # partsupp is not among the driver's tables: derived from lineitem
        register(f"scan_{_t}", lambda e, t=_t: e.fx_source.table(t))
    # the copy without its write-time stamp (the stamp: ``ingest_stamp`` and the pipeline test)
    register(f"bronze_{_t}", lambda e, t=_t: LazyLayers(
        e.base if t in RAW_TABLES else e.fx_source, e.config, stamp=True).bronze(t).drop(refine.INGESTED_AT))


def _ingest_stamp(e: Env) -> DataFrame:
    """Per bronze table: rows, and how many distinct stamps (one per write)."""
    out = None
    for t in TABLES:
        src = e.base if t in RAW_TABLES else e.fx_source
        b = LazyLayers(src, e.config, stamp=True).bronze(t)
        one = b.agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                    F.count_distinct(refine.INGESTED_AT).alias("distinct_stamps"),
                    F.count(refine.INGESTED_AT).alias("stamped_rows"))
        out = one if out is None else out.unionByName(one)
    return out


register("ingest_stamp", _ingest_stamp)

# ---- 2.2 / 2.3 silver, quarantine, and the NULL gap (fixture bronze) ----------
for _t in TABLES:
    register(f"silver_{_t}", lambda e, t=_t: e.fx.silver(t))
    register(f"quarantine_{_t}", lambda e, t=_t: e.fx.quarantine(t))
    register(f"unaccounted_{_t}", lambda e, t=_t: refine.unaccounted(e.fx.bronze(t), contracts_for(e.config)[t]))

# ---- 2.4 constraints (over typed rows that nothing has filtered) ------------------------------------------------------------
for _name, _table, _type in quality.declared_constraints():
    register(f"constraint_{_name}", lambda e, n=_name: quality.constraint_report(e.typed, [n]))
register("constraint_report", lambda e: quality.constraint_report(e.typed))

# ---- 2.5 gold marts (driver's tables) ----------------------------------------
for _m in ("revenue_metrics", "customer_activity", "top_suppliers", "top_parts"):
    register(_m, lambda e, m=_m: e.raw.gold(m))
register("customer_activity_latest",
         lambda e: marts.customer_activity_latest(e.raw.silver("customer"), e.raw.silver("orders"),
                                                  e.config.active_window_days))


# ---- 2.6 monitoring -------------------------------------------------------------
def _weekly(e: Env) -> DataFrame:
    return monitor.weekly_revenue(e.raw.gold("revenue_metrics"))


register("weekly_revenue", _weekly)
register("weekly_revenue_without_first", lambda e: monitor.drop_first_week(_weekly(e)))
register("wow_change", lambda e: monitor.wow_change(monitor.drop_first_week(_weekly(e)), "row"))
register("revenue_drop_alert", lambda e: monitor.revenue_drops(
    _weekly(e), adjacency="row", weeks="drop_first", inclusive=False, threshold=e.config.drop_threshold))
register("revenue_alert_status", lambda e: monitor.alert_status(monitor.revenue_drops(
    _weekly(e), adjacency="row", weeks="drop_first", inclusive=False, threshold=e.config.drop_threshold)))
register("revenue_drop_alert_complete", lambda e: monitor.revenue_drops(
    _weekly(e), adjacency="calendar", weeks="complete", inclusive=False, threshold=e.config.drop_threshold,
    orders=e.raw.bronze("orders")))

# ---- 2.7 business questions -----------------------------------------------------
register("q1_quarter_revenue", lambda e: questions.q1_quarter_revenue(e.raw.gold("revenue_metrics")))
register("q1_quarter_trend", lambda e: questions.q1_quarter_trend(e.raw.gold("revenue_metrics"),
                                                                  e.raw.bronze("orders")))
register("q2_active_customers", lambda e: questions.q2_active_customers(e.raw.gold("customer_activity")))
register("q3_wow_drop", lambda e: questions.q3_wow_drop(e.raw.gold("revenue_metrics"), e.config.drop_threshold))
register("q3_wow_drop_simulated",
         lambda e: questions.q3_wow_drop_simulated(e.raw.gold("revenue_metrics"), threshold=e.config.drop_threshold))
register("q3_wow_drop_planted", lambda e: questions.q3_wow_drop_planted(
    e.raw.gold("revenue_metrics"), e.raw.bronze("orders"), threshold=e.config.drop_threshold))
register("q4_company_health", lambda e: questions.q4_company_health(
    e.raw.gold("revenue_metrics"), e.raw.bronze("orders"), e.raw.gold("customer_activity"),
    e.raw.gold("top_suppliers"), e.raw.gold("top_parts"), e.config.health_top_n))

# ---- 2.8 profiling (bronze) -------------------------------------------------------
register("profile_order_dates", lambda e: profile.order_dates(e.raw.bronze("orders"), e.raw.bronze("customer")))
register("profile_weeks", lambda e: profile.weeks(e.raw.bronze("orders")))
register("profile_first_weeks", lambda e: profile.first_weeks(e.raw.bronze("orders")))
register("profile_last_weeks", lambda e: profile.last_weeks(e.raw.bronze("orders")))
register("profile_quarters", lambda e: profile.quarters(e.raw.bronze("orders")))
register("complete_periods", lambda e: profile.complete_periods(e.raw.bronze("orders")))
register("profile_categories", lambda e: profile.categories(
    {"customer": e.raw.bronze("customer"), "orders": e.raw.bronze("orders"), "lineitem": e.fx.bronze("lineitem")},
    {"customer": ["c_mktsegment"], "orders": ["o_orderstatus", "o_orderpriority"],
     "lineitem": ["l_returnflag", "l_linestatus", "l_shipmode"]}))
register("profile_numeric", lambda e: profile.numeric(e.raw.bronze("lineitem")))
register("profile_rules", lambda e: quality.validation_report(e.fx, list(quality.BRONZE_RULES), with_timestamp=False))

# ---- 2.9 layer audits (fixture bronze) ----------------------------------------------
for _t in TABLES:
    register(f"balance_{_t}", lambda e, t=_t: e.fx.balance(t))
for _t in ("region", "nation", "customer", "partsupp"):
    register(f"duplicate_keys_{_t}", lambda e, t=_t: audits.duplicate_keys(e.fx.silver(t), t))
register("broken_links_bronze_customer_nation", lambda e: audits.broken_links(
    e.raw.bronze("customer"), ("c_nationkey",), e.raw.bronze("nation"), ("n_nationkey",), "broken_links"))
register("broken_links_customer_nation", lambda e: audits.broken_links(
    e.fx.silver("customer"), ("c_nationkey",), e.fx.silver("nation"), ("n_nationkey",), "broken_nation_links"))
register("broken_links_orders_customer", lambda e: audits.broken_links(
    e.fx.silver("orders"), ("o_custkey",), e.fx.silver("customer"), ("c_custkey",), "broken_customer_links"))
register("broken_links_partsupp", lambda e: audits.broken_links_partsupp(
    e.fx.silver("partsupp"), e.fx.silver("part"), e.fx.silver("supplier")))
register("broken_links_lineitem_partsupp", lambda e: audits.broken_links(
    e.fx.silver("lineitem"), ("l_partkey", "l_suppkey"), e.fx.silver("partsupp"), ("ps_partkey", "ps_suppkey"),
    "broken_partsupp_links"))
register("invalid_parts", lambda e: audits.invalid_parts(e.fx.silver("part")))
register("invalid_rates", lambda e: audits.invalid_rates(e.fx.silver("lineitem"), e.config.discount_bounds,
                                                         e.config.tax_bounds))

# ---- 2.10 validation rules (fixture bronze) ------------------------------------------
for _n in range(1, 53):
    # rules 1-8 compare bronze with its source: over a copy that lost rows
    register(f"rule_{_n}", lambda e, n=_n: quality.rule(e.lossy if n <= 8 else e.fx, n))
register("validation_report", lambda e: quality.validation_report(e.fx, with_timestamp=False))
register("failing_rules", lambda e: quality.failing_rules(quality.validation_report(e.fx, with_timestamp=False)))


def build(key: str, spark: SparkSession, sf_dir: str, config: Config = DEFAULT) -> DataFrame:
    return REGISTRY[key](Env(spark, sf_dir, config))
