"""SparkSession construction for tests and benchmarks, and the shared
checkpoint location.

On a cluster the session comes from the platform; ``ensure_checkpoint_dir``
then only reads ``spark.checkpoint.dir``. A local default is set only when
the session has none (tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the plans rely on. AQE re-plans joins from runtime sizes (a
# broadcast only when the measured side is small), coalesces small shuffle
# partitions and splits skewed ones.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.session.timeZone": "UTC",
    # Size-checked broadcast, kept small on purpose: the plans already exchange
    # the fact side for its aggregate and the sort-merge join reuses that
    # partitioning, so not broadcasting costs only the dimension's own small
    # shuffle, while nothing that grows with the data is ever broadcast.
    # (Measured locally: 32 MB -> 1 MB cut the heavy queries by a quarter.)
    "spark.sql.autoBroadcastJoinThreshold": str(1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # The JVM compiles no method above 8,000 bytes of code: a stage whose generated
    # method is longer would run interpreted. Such stages fall back to the operators'
    # own loops, which are compiled one by one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, scratch: str | None = None,
                  driver_memory: str = "16g", app: str = "lakemart") -> SparkSession:
    scratch = scratch or tempfile.mkdtemp(prefix="run-", dir="/tmp")
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", driver_memory)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
         .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={os.path.join(scratch, 'derby')}"))
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, default=os.path.join(scratch, "checkpoints"))
    return spark


def ensure_checkpoint_dir(spark: SparkSession, default: str | None = None) -> str | None:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``; set to
    ``default`` only when the session names none."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d and default:
        d = default
        spark.conf.set("spark.checkpoint.dir", d)
    if d and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


MB = 1024 * 1024


def scale_conf(input_bytes: int, total_cores: int, shuffle_ratio: float = 0.05,
               target_partition_mb: int = 512, max_split_mb: int = 1024, max_blocks: int = 1_000_000_000) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` on ``total_cores``.

    * scan splits: at most ``max_split_mb``, but small enough that every core
      gets about three splits;
    * shuffle partitions: the bytes that are shuffled (``shuffle_ratio`` of the
      input: a few columns of it, aggregated map-side before the exchange) in
      pieces of ``target_partition_mb``, which a task sorts with spilling; never
      fewer than two waves of cores;
    * map tasks x reducers stay under ``max_blocks`` shuffle blocks, so blocks
      don't get tiny and the driver can hold their statistics.

    For ~100 TB on 1000 executors x 8 cores: 1 GB splits (~95,000 map tasks) and
    ~10,000 reducers: about 10^9 blocks of some 5 kB.
    """
    split = max(4 * MB, min(max_split_mb * MB, input_bytes // max(1, 3 * total_cores)))
    maps = max(1, input_bytes // split)
    by_bytes = int(input_bytes * shuffle_ratio) // (target_partition_mb * MB)
    shuffle = min(max(2 * total_cores, by_bytes), max(total_cores, max_blocks // maps))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(128, target_partition_mb) * MB),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }


def apply_engine_conf(spark: SparkSession, input_bytes: int | None = None) -> None:
    """The settings that the plans rely on, for any session; partition sizing
    too where the input's size is known."""
    apply_conf(spark, ENGINE_CONF)
    if input_bytes:
        apply_conf(spark, scale_conf(input_bytes, max(1, spark.sparkContext.defaultParallelism)))


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)
