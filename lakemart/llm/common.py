"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, gives the optimizer file
    sizes. The folder comes from ``spark.checkpoint.dir``; a local one is set
    only when a local session names none (tests): on a cluster that is an error."""
    spark = df.sparkSession
    folder = ensure_checkpoint_dir(spark)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        folder = ensure_checkpoint_dir(spark, default=tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    path = f"{folder.rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows kept for evaluation: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Shared:
    """A broadcast value of bounded size, from which every Python worker builds
    its own object once (``make``); the id tells workers' objects apart. Values of
    the same ``key`` are equal: a worker keeps its object from one to the next."""

    held: dict[str, object] = {}

    def __init__(self, spark: SparkSession, value, make: Callable = lambda x: x, key: str | None = None):
        self.broadcast, self.make, self.id = spark.sparkContext.broadcast(value), make, key or uuid.uuid4().hex

    def get(self):
        if self.id not in Shared.held:
            while len(Shared.held) > 1:  # the latest two
                Shared.held.pop(next(iter(Shared.held)))
            Shared.held[self.id] = self.make(self.broadcast.value)
        return Shared.held[self.id]


def per_text(shared: Shared, rows: Callable, kind: str, arrow_type, limit: int = 4_000_000) -> Callable:
    """An Arrow UDF of a text column: ``rows(worker's object, texts)`` gives a
    value for each text, as a list or an Arrow array, called on slices of about
    ``limit`` characters. It is evaluated once, wherever its column is used."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        mine = shared.get()
        for column in columns:
            texts = column.to_pylist()
            out, at = [], 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size + len(texts[to] or "") <= limit):
                    size += len(texts[to] or "")
                    to += 1
                part = rows(mine, texts[at:to])
                out.append(part if isinstance(part, pa.Array) else pa.array(part, arrow_type))
                at = to
            yield pa.concat_arrays(out) if out else pa.array([], arrow_type)

    return F.arrow_udf(run, kind).asNondeterministic()


def fresh(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column is called so."""
    while name.lower() in (c.lower() for c in columns):
        name += "_"
    return name


def slices(batches, size_of, limit: int):
    """Cut each Arrow batch so that a slice's rows sum to about ``limit`` (a
    single larger row stays whole): bounded memory with very long texts."""
    for batch in batches:
        first, total = 0, 0
        for i, n in enumerate(size_of(batch)):
            if i > first and total + n > limit:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += n
        if batch.num_rows > first:
            yield batch.slice(first)


def text_bytes(column):
    """Byte length of each text of an Arrow string column (null: 0)."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()
