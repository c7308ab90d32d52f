"""The medallion as lazy DataFrame plans.

``Layers`` gives every table of every layer as a DataFrame. ``LazyLayers``
derives them from a source on the fly (one logical plan from Parquet to the
report, so Catalyst prunes and pushes down end to end). ``TableLayers`` reads
the tables a pipeline run has written; reading them back cuts the lineage.
Operators (marts, rules, audits) only see this interface.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..operators import marts, refine
from ..operators.contracts import contracts_for
from ..sources.tables import Source

GOLD_TABLES = ("revenue_metrics", "customer_activity", "top_suppliers", "top_parts")


class Layers:
    spark: SparkSession
    config: Config

    def source(self, t: str) -> DataFrame:
        raise NotImplementedError

    def bronze(self, t: str) -> DataFrame:
        raise NotImplementedError

    def silver(self, t: str) -> DataFrame:
        raise NotImplementedError

    def quarantine(self, t: str) -> DataFrame | None:
        """``None`` when the quarantine table does not exist."""
        raise NotImplementedError

    def gold(self, name: str) -> DataFrame:
        raise NotImplementedError

    def balance(self, t: str) -> DataFrame:
        """bronze_received / silver_delivered / quarantine_rejected counts."""
        q = self.quarantine(t)
        s = self.silver(t).agg(F.count(F.lit(1))).scalar()
        qc = q.agg(F.count(F.lit(1))).scalar() if q is not None else F.lit(0).cast("bigint")
        out = self.bronze(t).agg(F.count(F.lit(1)).alias("bronze_received")).select(
            "bronze_received", s.alias("silver_delivered"), qc.alias("quarantine_rejected"))
        return out.select(
            F.lit(t).alias("table_name"), "bronze_received", "silver_delivered", "quarantine_rejected",
            (F.col("silver_delivered") + F.col("quarantine_rejected")).alias("total_accounted"),
            (F.col("bronze_received") - F.col("silver_delivered") - F.col("quarantine_rejected")).alias("missing_rows"),
        )


class LazyLayers(Layers):
    """Every layer derived lazily from ``source``.

    ``copies_source``: without a stamp, bronze is the source's own plan.
    ``filters_bronze``: silver is the contract's filter of bronze, row by row.

    ``stamp`` adds ``_ingested_at`` to bronze (off for oracle-compared plans).
    """

    copies_source = True
    filters_bronze = True

    def __init__(self, source: Source, config: Config = DEFAULT, stamp: bool = False):
        self.src = source
        self.spark = source.spark
        self.config = config
        self.stamp = stamp
        self._memo: dict[tuple[str, str], DataFrame] = {}

    def _get(self, layer: str, t: str, make) -> DataFrame:
        # One DataFrame per (layer, table), shared by every operator that uses
        # it: the plan is analysed once instead of once per use.
        if (layer, t) not in self._memo:
            self._memo[(layer, t)] = make()
        return self._memo[(layer, t)]

    def source(self, t: str) -> DataFrame:
        return self.src.table(t)

    def bronze(self, t: str) -> DataFrame:
        def make():
            df = self.src.table(t)
            return df.withColumn(refine.INGESTED_AT, F.current_timestamp()) if self.stamp else df
        return self._get("bronze", t, make)

    def silver(self, t: str) -> DataFrame:
        return self._get("silver", t, lambda: refine.clean(self.bronze(t), contracts_for(self.config)[t]))

    def quarantine(self, t: str) -> DataFrame:
        return self._get("quarantine", t, lambda: refine.quarantine(self.bronze(t), contracts_for(self.config)[t]))

    def balance(self, t: str) -> DataFrame:
        # One scan of bronze with conditional counts (silver and quarantine are
        # filters of it), instead of three scans.
        return refine.balance(self.bronze(t), contracts_for(self.config)[t])

    def gold(self, name: str) -> DataFrame:
        return self._get("gold", name, lambda: build_gold(self, name))


class TypedLayers(LazyLayers):
    """Silver typed but not filtered: what the declared constraints would have to
    hold against if nothing were quarantined."""

    filters_bronze = False

    def silver(self, t: str) -> DataFrame:
        return self._get("silver", t, lambda: refine.typed(self.bronze(t), contracts_for(self.config)[t]))


class LossyLayers(LazyLayers):
    """A bronze copy that lost some rows of every table (for the rules that
    compare the copy with its source)."""

    copies_source = False

    def bronze(self, t: str) -> DataFrame:
        key = contracts_for(self.config)[t].key[0]
        return self._get("bronze", t, lambda: self.src.table(t).where(F.coalesce(F.col(key) % 5, F.lit(0)) != 1))


class TableLayers(Layers):
    """Layers read from the catalog tables a pipeline run wrote."""

    def __init__(self, spark: SparkSession, source: Source, config: Config = DEFAULT):
        self.spark = spark
        self.src = source
        self.config = config

    def source(self, t: str) -> DataFrame:
        return self.src.table(t)

    def _t(self, layer: str, t: str) -> DataFrame:
        return self.spark.table(self.config.fq(layer, t))

    def bronze(self, t: str) -> DataFrame:
        return self._t("bronze", t)

    def silver(self, t: str) -> DataFrame:
        return self._t("silver", t)

    @cached_property
    def _silver_tables(self) -> set[str]:
        schema = self.config.schema("silver")
        if not self.spark.catalog.databaseExists(schema):  # any other catalog error rises
            return set()
        return {t.name for t in self.spark.catalog.listTables(schema)}

    def quarantine(self, t: str) -> DataFrame | None:
        name = f"quarantine_{t}"
        return self._t("silver", name) if name in self._silver_tables else None

    def gold(self, name: str) -> DataFrame:
        return self._t("gold", name)


def build_gold(layers: Layers, name: str) -> DataFrame:
    cfg = layers.config
    if name == "revenue_metrics":
        return marts.revenue_metrics(layers.silver("orders"), layers.silver("lineitem"))
    if name == "customer_activity":
        return marts.customer_activity(layers.silver("customer"), layers.silver("orders"),
                                       as_of=cfg.as_of, window_days=cfg.active_window_days)
    if name == "top_suppliers":
        return marts.top_suppliers(layers.silver("supplier"), layers.silver("lineitem"))
    if name == "top_parts":
        return marts.top_parts(layers.silver("part"), layers.silver("lineitem"))
    raise KeyError(name)
