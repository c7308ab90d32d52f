"""Writing the layers: the only module with side effects.

Each layer reads the tables the previous step wrote, which cuts the lineage
between steps: a lost executor re-runs tasks of one step, never the chain.
Writes are plain overwrites of managed Parquet tables; Spark's commit protocol
makes a failed task's output invisible.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .config import BUILD_ORDER, DEFAULT, LAYERS, TABLES, Config
from .operators import monitor, quality, refine
from .operators.contracts import TableContract, contracts_for
from .operators.refine import accept_sql, reason_sql, reject_sql, silver_projection_sql
from .plans.layers import GOLD_TABLES, TableLayers, build_gold
from .session import apply_engine_conf
from .sources.tables import Source

log = logging.getLogger("lakemart")

#: The schema that holds the rows of silver and quarantine.
STORE = "silver_store"


# ---- catalog helpers --------------------------------------------------------
def ensure_schemas(spark: SparkSession, config: Config = DEFAULT) -> None:
    """Create the layer schemas if missing (one-time setup)."""
    for layer in LAYERS:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {config.schema(layer)}")


def use_layer(spark: SparkSession, layer: str, config: Config = DEFAULT) -> None:
    if config.catalog:
        spark.catalog.setCurrentCatalog(config.catalog)
    spark.catalog.setCurrentDatabase(layer)


def list_tables(spark: SparkSession, layer: str, config: Config = DEFAULT) -> list[str]:
    """Table names of a layer; a layer whose schema is missing gives an empty list."""
    schema = config.schema(layer)
    if not spark.catalog.databaseExists(schema):  # any other catalog error rises
        return []
    return sorted(t.name for t in spark.catalog.listTables(schema))


def describe_table(spark: SparkSession, layer: str, table: str, config: Config = DEFAULT) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE {config.fq(layer, table)}")


def reset_silver(spark: SparkSession, config: Config = DEFAULT) -> None:
    """Drop silver and quarantine, children before parents, and their rows."""
    for t in reversed(BUILD_ORDER):
        for name in (config.fq("silver", t), config.fq("silver", f"quarantine_{t}"), config.fq(STORE, t)):
            drop(spark, name)


def drop(spark: SparkSession, name: str) -> None:
    """Drop a table or view, whichever it is."""
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP {'VIEW' if spark.catalog.getTable(name).tableType == 'VIEW' else 'TABLE'} {name}")


def write_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


# ---- layers -------------------------------------------------------------------
def write_bronze(spark: SparkSession, source: Source, config: Config = DEFAULT,
                 tables=TABLES) -> None:
    """Copy every source table unchanged plus ``_ingested_at`` (one timestamp
    per table write)."""
    for t in tables:
        df = source.table(t).withColumn(refine.INGESTED_AT, F.current_timestamp())
        write_table(df, config.fq("bronze", t))


@dataclass(frozen=True)
class Split:
    """What the writing pass over a bronze table counted."""

    table: str
    bronze: int
    silver: int
    quarantine: int

    @property
    def unaccounted(self) -> int:
        return self.bronze - self.silver - self.quarantine


def write_split(bronze: DataFrame, contract: TableContract, store: str, silver: str, quarantine: str, strict: bool = False) -> Split:
    """Silver and quarantine of one table from one read of bronze and one write,
    and the counts of that pass.

    Every row is written once to the table ``store``, partitioned by its verdict: ``accepted``
    rows with silver's typed columns, ``rejected`` ones and those in ``neither`` as they came,
    with the reason. ``silver`` and ``quarantine`` are views of their partitions (a reader prunes
    the others). The counts are observed on the way (``DataFrame.observe``), without another job."""
    spark = bronze.sparkSession
    accepted, rejected = accept_sql(contract, bronze), reject_sql(contract, bronze)
    if strict:
        rejected = f"NOT coalesce({accepted}, false)"
    typed_columns = [c.rsplit(" AS ", 1)[-1] for c in silver_projection_sql(bronze.columns, contract)]
    raw = ", ".join(f"`{c}`" for c in bronze.columns)
    verdict = f"CASE WHEN {accepted} THEN 'accepted' WHEN {rejected} THEN 'rejected' ELSE 'neither' END AS _verdict"
    # two steps: the raw row is packed before the typed columns take over its names
    marked = bronze.selectExpr(verdict, f"struct({raw}) AS _raw", f"{reason_sql(contract, df=bronze)} AS _reason",
                               *[f"{c.rsplit(' AS ', 1)[0]} AS `{n}`" for c, n in zip(silver_projection_sql(bronze.columns, contract), typed_columns)])
    kept = F.col("_verdict") == "accepted"
    rows = marked.select(*[F.when(kept, F.col(c)).alias(c) for c in typed_columns], F.when(~kept, F.col("_raw")).alias("_raw"),
                         F.when(F.col("_verdict") == "rejected", F.col("_reason")).alias("_reason"), "_verdict")
    seen = Observation(f"split {contract.table}")
    counts = [F.count(F.lit(1)).alias("bronze"), F.count_if(kept).alias("silver"),
              F.count_if(F.col("_verdict") == "rejected").alias("quarantine")]
    rows.observe(seen, *counts).write.mode("overwrite").format("parquet").partitionBy("_verdict").saveAsTable(store)
    for name in (silver, quarantine):
        drop(spark, name)
    spark.sql(f"CREATE VIEW {silver} AS SELECT {', '.join(f'`{c}`' for c in typed_columns)} FROM {store} WHERE _verdict = 'accepted'")
    spark.sql(f"CREATE VIEW {quarantine} AS SELECT _raw.*, _reason AS {refine.REASON} FROM {store} WHERE _verdict = 'rejected'")
    got = seen.get
    return Split(contract.table, got["bronze"], got["silver"], got["quarantine"])


def write_silver(spark: SparkSession, config: Config = DEFAULT, tables=BUILD_ORDER, strict: bool = False) -> dict[str, Split]:
    """Quarantine and silver per table, parents first; bronze is read once per
    table. Returns the counts observed by that read (``reconcile``). The rows
    lie in the schema ``silver_store``."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {config.schema(STORE)}")
    out = {}
    for t in tables:
        out[t] = write_split(spark.table(config.fq("bronze", t)), contracts_for(config)[t], config.fq(STORE, t), config.fq("silver", t),
                             config.fq("silver", f"quarantine_{t}"), strict)
        log.info("silver %s: %d rows, %d kept, %d rejected, %d in neither", t, out[t].bronze, out[t].silver, out[t].quarantine, out[t].unaccounted)
    return out


def reconcile(spark: SparkSession, splits: dict[str, Split]) -> DataFrame:
    """Rules 9-16 from the observed counts: rule, violations. No table is read."""
    rows = [(quality.NAME_RECON.format(t=t), abs(splits[t].unaccounted)) for t in TABLES if t in splits]
    return spark.createDataFrame(rows, "rule string, violations long")


def write_gold(spark: SparkSession, source: Source, config: Config = DEFAULT) -> None:
    layers = TableLayers(spark, source, config)
    for g in GOLD_TABLES:
        write_table(build_gold(layers, g), config.fq("gold", g))


def validate(spark: SparkSession, source: Source, config: Config = DEFAULT,
             fail_on_error: bool = False) -> DataFrame:
    """Run all 52 rules over the written tables as one job; the small report
    is materialised once so callers can inspect it without re-running."""
    layers = TableLayers(spark, source, config)
    report = quality.validation_report(layers)
    rows = report.collect()  # 52 rows
    df = spark.createDataFrame(rows, report.schema)
    if fail_on_error:
        quality.assert_valid(df)
    return df


def revenue_alert(spark: SparkSession, config: Config = DEFAULT, show: bool = True) -> bool:
    """The pipeline's week-over-week alert over the written gold table."""
    weekly = monitor.weekly_revenue(spark.table(config.fq("gold", "revenue_metrics")))
    drops = monitor.revenue_drops(weekly, adjacency="row", weeks="drop_first", inclusive=False,
                                  threshold=config.drop_threshold)
    return monitor.alert(spark, drops, show=show, threshold=config.drop_threshold)


def run_full_pipeline(spark: SparkSession, source: Source, config: Config = DEFAULT,
                      run_bronze: bool = True) -> DataFrame:
    """schemas -> bronze (skippable) -> silver -> gold -> validation -> alert.

    Validation failures are reported, not raised; any error is logged and
    re-raised. Returns the validation report. The session gets the engine's
    settings first (``apply_engine_conf``), sized by the source's files.
    """
    apply_engine_conf(spark, source.size_bytes() if source is not None else None)
    try:
        log.info("step 1/5: schemas")
        ensure_schemas(spark, config)
        if run_bronze:
            log.info("step 2/5: bronze")
            write_bronze(spark, source, config)
        else:
            log.info("step 2/5: bronze skipped")
        log.info("step 3/5: silver")
        write_silver(spark, config)
        log.info("step 4/5: gold")
        write_gold(spark, source, config)
        log.info("step 5/5: validation and alert")
        report = validate(spark, source, config, fail_on_error=False)
        failed = quality.failing_rules(report)
        n_failed = failed.count()
        if n_failed:
            log.warning("validation: %d failing rule(s)", n_failed)
        revenue_alert(spark, config, show=False)
        return report
    except Exception:
        log.exception("pipeline failed")
        raise
