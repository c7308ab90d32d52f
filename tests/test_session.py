"""Session helpers: partition sizing and the shared checkpoint folder."""

from __future__ import annotations

from lakemart.session import MB, ensure_checkpoint_dir, scale_conf


def test_scale_conf_sizes_partitions():
    size = 100 * 1024 ** 4
    big = scale_conf(size, 8000)
    split, reducers = int(big["spark.sql.files.maxPartitionBytes"]), int(big["spark.sql.shuffle.partitions"])
    assert split == 1024 * MB and 8_000 <= reducers <= 16_000
    assert size // split * reducers <= 1_000_000_000  # shuffle blocks stay bounded
    huge = scale_conf(50 * size, 8000)
    assert 50 * size // (1024 * MB) * int(huge["spark.sql.shuffle.partitions"]) <= 50 * size // (1024 * MB) * 8000
    small = scale_conf(40 * MB, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16  # never fewer than two waves
    assert 4 * MB <= int(small["spark.sql.files.maxPartitionBytes"]) <= 256 * MB


def test_command_line_applies_the_engine_settings(spark, scratch, capsys):
    from lakemart.__main__ import main
    from lakemart.session import ENGINE_CONF

    before = {k: spark.conf.get(k, None) for k in (*ENGINE_CONF, "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
                                                   "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "123")
        spark.sql("CREATE SCHEMA IF NOT EXISTS silver")
        import pytest

        with pytest.raises(SystemExit):
            main(["validate"])  # needs the source: rules 1-8 count its rows
        assert "required for this step" in capsys.readouterr().err
        import lakemart.pipeline as pipeline
        called = []
        real = pipeline.write_silver
        pipeline.write_silver = lambda *a, **k: called.append(1)
        try:
            assert main(["silver", "--parquet", "/root/testdata/sf0.001"]) == 0
        finally:
            pipeline.write_silver = real
        assert called and all(spark.conf.get(k) == v for k, v in ENGINE_CONF.items())
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= 2
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_checkpoint_dir_is_read_not_overridden(spark, scratch):
    current = ensure_checkpoint_dir(spark)
    assert current  # set by the session (or by local_session where it was unset)
    assert ensure_checkpoint_dir(spark, default=scratch + "/other") == current
