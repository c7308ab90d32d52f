"""Where the source tables come from.

A *source* maps a table name to a DataFrame. Reads are lazy and go through
``spark.read.parquet`` / ``spark.table`` so Catalyst prunes columns and pushes
filters into the scan; nothing here touches data on the driver.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Source:
    """Base class: ``table(name)`` returns the raw table as a DataFrame."""

    spark: SparkSession

    def table(self, name: str) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def has(self, name: str) -> bool:  # pragma: no cover - interface
        raise NotImplementedError

    def size_bytes(self) -> int | None:
        """Bytes of the source's files, if they are known (for partition sizing)."""
        return None

    def __getitem__(self, name: str) -> DataFrame:
        return self.table(name)


# Reader DataFrames per (application, path, file stamp): reading the Parquet
# footers for the schema costs ~0.1 s per table per query build. Only local
# paths are cached, keyed by size and mtime, so a changed file is re-read.
_READERS: dict[tuple, DataFrame] = {}


def _stamp(path: str):
    if "://" in path or not os.path.exists(path):
        return None
    if os.path.isdir(path):
        entries = [os.stat(os.path.join(path, f)) for f in sorted(os.listdir(path))]
        return tuple((e.st_size, e.st_mtime_ns) for e in entries)
    st = os.stat(path)
    return (st.st_size, st.st_mtime_ns)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    stamp = _stamp(path)
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - e.g. Spark Connect has no SparkContext: no cache
        app = None
    if stamp is None or app is None:
        return spark.read.parquet(path)
    key = (app, path, stamp)
    if key not in _READERS:
        _READERS[key] = spark.read.parquet(path)
    return _READERS[key]


class ParquetSource(Source):
    """One Parquet file or directory per table: ``{root}/{name}.parquet``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def has(self, name: str) -> bool:
        # Only a local-path check; for object stores ``table`` simply fails.
        return "://" in self.root or os.path.exists(self.path(name))

    def table(self, name: str) -> DataFrame:
        # DataFrames are immutable plans: one per table is shared by every use.
        if name not in self._frames:
            self._frames[name] = read_parquet(self.spark, self.path(name))
        return self._frames[name]

    def size_bytes(self) -> int | None:
        """From the file listing alone; any file system that Spark reads."""
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
                 .option("pathGlobFilter", "*.parquet").load(self.root))
        return files.agg(F.sum("length")).first()[0]

    def __repr__(self) -> str:
        return f"ParquetSource({self.root!r})"


class CatalogSource(Source):
    """Tables of a catalog namespace, e.g. ``retail.tpch`` or ``bronze``."""

    def __init__(self, spark: SparkSession, namespace: str):
        self.spark = spark
        self.namespace = namespace

    def has(self, name: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.namespace}.{name}")

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.namespace}.{name}")

    def __repr__(self) -> str:
        return f"CatalogSource({self.namespace!r})"


class DerivedSource(Source):
    """Tables computed from another source by Spark (e.g. the fixture views).

    ``builders[name](base)`` returns the derived table; names without a
    builder fall through to ``base``.
    """

    def __init__(self, base: Source, builders: dict[str, Callable[[Source], DataFrame]]):
        self.spark = base.spark
        self.base = base
        self.builders = builders
        self._frames: dict[str, DataFrame] = {}

    def has(self, name: str) -> bool:
        return name in self.builders or self.base.has(name)

    def table(self, name: str) -> DataFrame:
        if name in self.builders:
            if name not in self._frames:
                self._frames[name] = self.builders[name](self.base)
            return self._frames[name]
        return self.base.table(name)


class FrameSource(Source):
    """Tables given directly as DataFrames (e.g. a view the caller built)."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame]):
        self.spark = spark
        self.frames = dict(frames)

    def has(self, name: str) -> bool:
        return name in self.frames

    def table(self, name: str) -> DataFrame:
        return self.frames[name]
