"""Incremental bronze ingest with Structured Streaming.

The batch bronze step overwrites a full copy each run. At scale the same copy
(source rows unchanged plus ``_ingested_at``) is better done incrementally: a
file stream over the source table picks up only new files, stamps them, and
appends to the bronze table. The checkpoint (under the cluster's shared
``spark.checkpoint.dir``) records which files are done, so a restarted or
failed run neither loses nor duplicates a file. ``availableNow`` processes
what is there and stops, so it runs as a scheduled job.

The stamp is one timestamp per micro-batch, i.e. per write, as in batch.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.refine import INGESTED_AT
from ..session import ensure_checkpoint_dir


def bronze_stream(spark: SparkSession, folder: str, table: str, target: str,
                  checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start an ``availableNow`` stream copying the source table
    ``{folder}/{table}.parquet``, a file or a folder of files, into the catalog
    table ``target``. Returns the running query. Other tables of the folder are
    never read, whatever their names; a table without any file is an error."""
    path = os.path.join(folder, f"{table}.parquet")
    source = spark.read.parquet(path)  # fails if there is nothing at the path
    files = source.inputFiles()
    if not files:
        raise FileNotFoundError(f"no Parquet file in {path}")
    reader = spark.readStream.schema(source.schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if len(files) == 1 and files[0].rstrip("/").endswith(f"/{table}.parquet"):  # a single file
        reader, path = reader.option("pathGlobFilter", f"{table}.parquet"), folder
    stream = reader.load(path).withColumn(INGESTED_AT, F.current_timestamp())
    if checkpoint is None:
        base = ensure_checkpoint_dir(spark)
        if not base:
            raise ValueError("set spark.checkpoint.dir to a shared folder, or pass checkpoint=")
        checkpoint = os.path.join(base, "bronze_stream", target.replace(".", "_"))
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .toTable(target))


def ingest_available(spark: SparkSession, folder: str, table: str, target: str, **kw) -> None:
    """Run ``bronze_stream`` to completion."""
    q = bronze_stream(spark, folder, table, target, **kw)
    q.awaitTermination()
