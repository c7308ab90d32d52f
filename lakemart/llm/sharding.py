"""Histogram sort into byte-balanced shards, with DataFrame functions only.

The sort key is (hash of the text, hash of the id, hash of the place in the
input), so equal texts are neighbours, a group that is larger than a shard can
still be divided, and so can a run of rows equal in id and text. The
splitters between shards are found by probing: the exact bytes and rows below
candidate boundaries are counted in one aggregate per round (first the leading
bits of all keys, then further bits of the few intervals that still hold a
target), until every splitter lies within the tolerance or on a single row.
A boundary between two texts is taken whenever one is within the tolerance.
Only then do rows move, once: shards are numbered by comparing with the
splitters, and a row's slot is the number of rows in its shard's earlier cells
(from aggregated counts) plus its number within its cell. Cells are ranges of
the id hash, so they are even whatever the texts are; a cell that a repeated
(or null) id makes too large is divided by the hash of the place.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

SHARDS = 40
OVERHEAD = 16
TOLERANCE = 0.002
BITS = 10
KEY_BITS = 63
CELL_ROWS = 20_000


@dataclass
class Splitter:
    """Rows with (text hash, id hash, place hash) from here on belong to the next shard."""

    text: int
    id: int = 0
    place: int = 0


def _weighed(keys: DataFrame, by: list[Column]) -> list:
    return keys.groupBy(*by).agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()


def _probe(keys: DataFrame, targets: list[int], tolerance: float, column: str, where: Column | None, below: int) -> tuple[list[int], list[tuple[int, int, int]]]:
    """For each target (ascending byte counts) a boundary of ``column`` as close
    to it as needed. Returns the boundaries, and for those where a single value
    of the column still spans the target: (number, value, bytes below it).

    ``below``: bytes before these rows."""
    found: dict[int, int] = {}
    heavy: list[tuple[int, int, int]] = []
    # intervals: value of the leading bits -> (bytes below it, targets inside)
    todo = {0: (below, dict(enumerate(targets)))}
    used = 0
    while todo:
        bits = min(BITS + 2 * (used == 0), KEY_BITS - used)
        used += bits
        rest = KEY_BITS - used
        rows = keys if where is None else keys.where(where)
        if used > bits:
            rows = rows.where(F.shiftrightunsigned(column, rest + bits).isin(list(todo)))
        counted = sorted((r["at"], r["bytes"], r["n"]) for r in _weighed(rows, [F.shiftrightunsigned(column, rest).alias("at")]))
        inner: dict[int, tuple[int, dict[int, int]]] = {}
        for parent, (start, mine) in todo.items():
            left = sorted(mine.items(), key=lambda x: x[1])
            at_byte = start
            last = (parent + 1) << bits
            for value, size, n in [c for c in counted if c[0] >> bits == parent]:
                end = at_byte + size
                while left and left[0][1] < end:
                    number, target = left.pop(0)
                    near_start = target - at_byte <= end - target
                    if min(target - at_byte, end - target) <= tolerance or (n == 1 and not rest):
                        found[number] = (value if near_start else value + 1) << rest
                    elif rest:
                        inner.setdefault(value, (at_byte, {}))[1][number] = target
                    else:
                        heavy.append((number, value, at_byte))
                at_byte = end
            for number, _ in left:  # a target at or beyond the last row
                found[number] = last << rest
        todo = inner
    return [found.get(i, -1) for i in range(len(targets))], heavy


def splitters(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[Splitter]:
    """The shards - 1 boundaries for near-equal bytes. ``keys``: text_hash, id_hash, place, size."""
    total = keys.agg(F.sum("size").alias("b")).first()["b"] or 0
    if not total:
        return [Splitter((1 << KEY_BITS) - 1)] * (shards - 1)
    targets = [round(total * i / shards) for i in range(1, shards)]
    slack = tolerance * total / shards
    at, heavy = _probe(keys, targets, slack, "text_hash", None, 0)
    out = [Splitter(a) for a in at]
    for value, inside in _spanned(heavy).items():  # one text spans the target: divide its rows by the id hash
        text = F.col("text_hash") == value
        numbers = [n for n, _ in inside]
        inner, runs = _probe(keys, [targets[n] for n in numbers], slack, "id_hash", text, inside[0][1])
        for number, i in zip(numbers, inner):
            out[number] = Splitter(value, i)
        for id_value, within in _spanned(runs).items():  # rows equal in id and text: by their places
            own = [numbers[k] for k, _ in within]
            last, same = _probe(keys, [targets[n] for n in own], slack, "place", text & (F.col("id_hash") == id_value), within[0][1])
            for k, v, _ in same:  # places with one hash
                last[k] = v
            for number, place in zip(own, last):
                out[number] = Splitter(value, id_value, place)
    return out


def _spanned(heavy: list[tuple[int, int, int]]) -> dict[int, list[tuple[int, int]]]:
    """The targets (number, bytes below) within each single value."""
    out: dict[int, list[tuple[int, int]]] = {}
    for number, value, start in heavy:
        out.setdefault(value, []).append((number, start))
    return out


def shard_number(bounds: list[Splitter]) -> Column:
    """How many splitters lie at or before the row's key."""
    text, id_, place = F.col("text_hash"), F.col("id_hash"), F.col("place")
    after = [F.when((text > s.text) | ((text == s.text) & ((id_ > s.id) | ((id_ == s.id) & (place >= s.place)))), 1).otherwise(0)
             for s in bounds]
    out = F.lit(0)
    for a in after:
        out = out + a
    return out.cast("int")


def shard(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD, tolerance: float = TOLERANCE,
          cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row.

    size: the text's UTF-8 bytes (null: none) plus ``overhead``. Shards have
    equal bytes up to the tolerance (a share of a shard) and one row's size.
    Equal texts are neighbours, split over shards only where a boundary needs
    it. Null texts are one group with crc null; null ids and repeated rows are
    rows like others: a run of rows equal in id and text is divided by count
    where a boundary needs it. Slots are gapless from 0; they follow the ids,
    but for the rows beside an id that fills a cell many times over, which
    follow their places in the input. Other columns are ignored, an
    empty table gives an empty result; with fewer rows than shards some shards
    stay empty."""
    text = F.col("text").cast("string")
    keys = staged(docs.select(
        "doc_id", (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.shiftrightunsigned(F.xxhash64(text), 1).alias("text_hash"),
        F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit(1)), 1).alias("id_hash"),
        F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id(), F.lit(2)), 1).alias("place")))
    bounds = splitters(keys, shards, tolerance)
    rows = keys.count()
    cells = max(1, math.ceil(rows / shards / cell_rows))
    placed = keys.select("doc_id", "size", "text_crc32", "text_hash", "id_hash", "place", shard_number(bounds).alias("shard"),
                         F.floor(F.col("id_hash") / (2.0**KEY_BITS / cells)).cast("int").alias("cell"))
    # cells that a repeated id overfills: few, and none at all where ids are unique; Spark broadcasts them by their size
    full = staged(placed.groupBy("shard", "cell").agg(F.count("*").alias("n")).where(F.col("n") > 4 * cell_rows)
                  .select("shard", "cell", F.ceil(F.col("n") / cell_rows).alias("parts")))
    part = F.coalesce(F.floor(F.col("place") / (2.0**KEY_BITS / F.col("parts"))), F.lit(0)).cast("int")
    placed = placed.join(full, ["shard", "cell"], "left").withColumn("part", part)
    counts = placed.groupBy("shard", "cell", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell", "part").rowsBetween(Window.unboundedPreceding, -1)
    base = staged(counts.select("shard", "cell", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    within = Window.partitionBy("shard", "cell", "part").orderBy("id_hash", "doc_id", "text_hash", "size", "text_crc32", "place")
    numbered = placed.withColumn("k", F.row_number().over(within) - 1)
    return numbered.join(base, ["shard", "cell", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("k")).cast("long").alias("slot"))


def digest(docs: DataFrame, **options) -> DataFrame:
    """``shard`` under the law of near-equal bytes."""
    return shard(docs, **options).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                                         F.lit(None).cast("int").alias("grown_shard"))
