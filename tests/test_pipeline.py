"""Writers, the full pipeline over written tables, and incremental ingest."""

from __future__ import annotations

import os
import shutil
import tempfile

import pytest

from lakemart import pipeline
from lakemart.config import TABLES, Config
from lakemart.operators import quality
from lakemart.plans.layers import LazyLayers, TableLayers
from lakemart.sources.fixtures import fixture_source
from lakemart.sources.tables import ParquetSource

from paths import SF_SMALL


def test_full_pipeline_matches_lazy_plan(spark):
    cfg = Config()
    src = fixture_source(ParquetSource(spark, SF_SMALL))
    report = pipeline.run_full_pipeline(spark, src, cfg, run_bronze=True)
    assert report.count() == 52
    for layer, n in (("bronze", 8), ("silver", 16), ("gold", 4)):
        assert len(pipeline.list_tables(spark, layer, cfg)) == n, layer
    assert "_ingested_at" in spark.table(cfg.fq("bronze", "orders")).columns
    assert "_ingested_at" in spark.table(cfg.fq("silver", "orders")).columns
    assert "rejection_reason" in spark.table(cfg.fq("silver", "quarantine_orders")).columns
    written = [(r.layer, r.rule, r.violations) for r in report.collect()]
    lazy = [(r.layer, r.rule, r.violations)
            for r in quality.validation_report(LazyLayers(src, cfg), with_timestamp=False).collect()]
    assert written == lazy

    # Overwrite is idempotent and bronze can be skipped.
    bronze_rows = {t: spark.table(cfg.fq("bronze", t)).count() for t in TABLES}
    again = pipeline.run_full_pipeline(spark, src, cfg, run_bronze=False)
    assert [(r.layer, r.rule, r.violations) for r in again.collect()] == written
    assert {t: spark.table(cfg.fq("bronze", t)).count() for t in TABLES} == bronze_rows

    # Gold over written silver equals gold over the lazy plan.
    tl = TableLayers(spark, src, cfg)
    for g in ("revenue_metrics", "top_parts"):
        assert tl.gold(g).exceptAll(LazyLayers(src, cfg).gold(g)).isEmpty()

    # Reconciliation without quarantine tables counts them as 0.
    pipeline.reset_silver(spark, cfg)
    assert pipeline.list_tables(spark, "silver", cfg) == []


def test_alert_action(spark):
    cfg = Config()
    src = ParquetSource(spark, SF_SMALL)
    pipeline.ensure_schemas(spark, cfg)
    tables = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    pipeline.write_bronze(spark, src, cfg, tables=tables)
    pipeline.write_silver(spark, cfg, tables=("customer", "orders", "part", "supplier", "lineitem"))
    pipeline.write_table(LazyLayers(src, cfg).gold("revenue_metrics"), cfg.fq("gold", "revenue_metrics"))
    assert pipeline.revenue_alert(spark, cfg, show=False) is True  # 139 weeks fire at sf0.001


def test_streaming_bronze_ingest(spark, scratch):
    from lakemart.streaming import ingest_available

    folder = tempfile.mkdtemp(prefix="stream-src-", dir=scratch)
    src = spark.read.parquet(os.path.join(SF_SMALL, "part.parquet"))
    shutil.copy(os.path.join(SF_SMALL, "part.parquet"), os.path.join(folder, "part.parquet"))
    # neighbours whose names begin alike are other tables
    shutil.copy(os.path.join(SF_SMALL, "orders.parquet"), os.path.join(folder, "partsupp.parquet"))
    shutil.copy(os.path.join(SF_SMALL, "orders.parquet"), os.path.join(folder, "part_old.parquet"))
    spark.sql("CREATE SCHEMA IF NOT EXISTS bronze_stream")
    ckpt = tempfile.mkdtemp(prefix="ckpt-", dir=scratch)
    ingest_available(spark, folder, "part", "bronze_stream.part", checkpoint=ckpt)
    got = spark.table("bronze_stream.part")
    assert got.count() == src.count()
    assert got.drop("_ingested_at").exceptAll(src).isEmpty()
    # A second run with no new files adds nothing (exactly-once by checkpoint).
    ingest_available(spark, folder, "part", "bronze_stream.part", checkpoint=ckpt)
    assert spark.table("bronze_stream.part").count() == src.count()


def test_streaming_ingest_of_a_table_folder(spark, scratch):
    """A table that Spark wrote (a folder of files): every file once, new ones incrementally."""
    from lakemart.streaming import ingest_available

    folder = tempfile.mkdtemp(prefix="stream-src-", dir=scratch)
    src = spark.read.parquet(os.path.join(SF_SMALL, "orders.parquet"))
    path = os.path.join(folder, "orders.parquet")
    src.repartition(3).write.parquet(path)
    spark.sql("CREATE SCHEMA IF NOT EXISTS bronze_stream")
    ckpt = tempfile.mkdtemp(prefix="ckpt-", dir=scratch)
    ingest_available(spark, folder, "orders", "bronze_stream.orders", checkpoint=ckpt)
    assert spark.table("bronze_stream.orders").drop("_ingested_at").exceptAll(src).isEmpty()
    assert spark.table("bronze_stream.orders").count() == src.count()
    src.limit(10).write.mode("append").parquet(path)
    ingest_available(spark, folder, "orders", "bronze_stream.orders", checkpoint=ckpt)
    assert spark.table("bronze_stream.orders").count() == src.count() + 10
    with pytest.raises(Exception, match="no_such|PATH_NOT_FOUND"):
        ingest_available(spark, folder, "no_such", "bronze_stream.none", checkpoint=ckpt + "-none")


def test_cli_steps_and_catalog_helpers(spark, scratch):
    """Per-step entry points over a parquet folder holding all eight tables."""
    from lakemart.__main__ import main

    folder = tempfile.mkdtemp(prefix="cli-src-", dir=scratch)
    src = fixture_source(ParquetSource(spark, SF_SMALL))
    for t in TABLES:
        src.table(t).write.mode("overwrite").parquet(os.path.join(folder, f"{t}.parquet"))
    for step in ("bronze", "silver", "gold", "validate"):
        assert main([step, "--parquet", folder]) == 0, step
    assert main(["alert"]) in (0, 1)
    cfg = Config()
    assert len(pipeline.list_tables(spark, "gold", cfg)) == 4
    desc = {r.col_name for r in pipeline.describe_table(spark, "silver", "lineitem", cfg).collect()}
    assert {"l_orderkey", "l_discount", "_ingested_at"} <= desc
    pipeline.use_layer(spark, "silver", cfg)
    assert spark.catalog.currentDatabase() == "silver"
    spark.catalog.setCurrentDatabase("default")
    assert pipeline.list_tables(spark, "no_such_layer", cfg) == []


def test_silver_reads_bronze_once_and_observes_its_counts(spark):
    """One job's read of bronze gives silver, quarantine and rules 9-16."""
    from lakemart.operators import refine
    from lakemart.operators.contracts import CONTRACTS

    cfg = Config()
    src = fixture_source(ParquetSource(spark, SF_SMALL))
    pipeline.ensure_schemas(spark, cfg)
    pipeline.write_bronze(spark, src, cfg)
    splits = pipeline.write_silver(spark, cfg)
    layers = TableLayers(spark, src, cfg)
    for t, c in CONTRACTS.items():
        bronze = layers.bronze(t)
        assert layers.silver(t).schema == refine.clean(bronze, c).schema or layers.silver(t).dtypes == refine.clean(bronze, c).dtypes, t
        assert layers.silver(t).exceptAll(refine.clean(bronze, c)).isEmpty() and refine.clean(bronze, c).exceptAll(layers.silver(t)).isEmpty(), t
        quarantine = layers.quarantine(t)
        assert quarantine.columns == refine.quarantine(bronze, c).columns
        assert quarantine.exceptAll(refine.quarantine(bronze, c)).isEmpty(), t
        assert (splits[t].bronze, splits[t].silver, splits[t].quarantine) == (bronze.count(), layers.silver(t).count(), quarantine.count())
    observed = {r["rule"]: r["violations"] for r in pipeline.reconcile(spark, splits).collect()}
    recomputed = {r["rule"]: r["violations"] for r in quality.validation_report(layers, list(range(9, 17))).collect()}
    assert observed == recomputed and any(recomputed.values())
    # readers of silver prune the other partitions
    plan = layers.silver("lineitem")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_verdict" in plan
    # strict: the rows in neither are quarantined
    strict = pipeline.write_silver(spark, cfg, tables=("lineitem",), strict=True)["lineitem"]
    assert strict.unaccounted == 0 and strict.quarantine > splits["lineitem"].quarantine
    assert layers.quarantine("lineitem").exceptAll(refine.quarantine(layers.bronze("lineitem"), CONTRACTS["lineitem"], strict=True)).isEmpty()
    # a table of an earlier layout under the same name gives way
    pipeline.reset_silver(spark, cfg)
    pipeline.write_table(layers.bronze("region"), cfg.fq("silver", "region"))
    assert pipeline.write_silver(spark, cfg, tables=("region",))["region"].bronze == 5
    pipeline.reset_silver(spark, cfg)


def test_split_of_empty_and_clashing_input(spark):
    from lakemart.operators.contracts import CONTRACTS

    cfg = Config()
    pipeline.ensure_schemas(spark, cfg)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {cfg.schema(pipeline.STORE)}")
    names = (cfg.fq(pipeline.STORE, "region"), cfg.fq("silver", "region"), cfg.fq("silver", "quarantine_region"))
    for rows in ([], [(1, " A ", "x", 7), (None, "B", None, 8), (1, None, "y", 9)]):
        df = spark.createDataFrame(rows, "r_regionkey bigint, r_name string, r_comment string, extra int")
        got = pipeline.write_split(df, CONTRACTS["region"], *names)
        assert (got.bronze, got.silver, got.quarantine) == ((3, 2, 1) if rows else (0, 0, 0))
        assert sorted(map(tuple, spark.table(names[1]).collect()), key=str) == ([(1, "A", "x"), (1, None, "y")] if rows else [])
        assert [tuple(r)[:4] for r in spark.table(names[2]).collect()] == ([(None, "B", None, 8)] if rows else [])
    for n in names[1:] + names[:1]:
        pipeline.drop(spark, n)
