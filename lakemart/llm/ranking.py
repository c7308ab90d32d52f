"""Ranked lexical search by reversed search: the queries are indexed, the
documents stream past.

The items' terms form an inverted index (term -> items that ask for it), which
is broadcast in blocks of a bounded number of postings. Each document's term
counts go once through the index and add up the scores of all items that share a
term with it; every worker keeps a bounded heap of the best documents per item.
The heaps are merged by a window over their few rows.

Two passes over the documents would be needed, as weights rest on counts of all
of them. Instead the first pass stages, per document, its length and the counts
of those terms that the block asks for, as numbers; lengths and document
frequencies come from there, and the heaps are filled from there.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Shared, slices, staged, text_bytes

TOP = 20
#: UTF-8 bytes of item text in a block of the index (an item's text is bytes, its postings fewer).
BLOCK_BYTES = 16_000_000
#: Cells (documents x items) that a worker scores at a time.
CELLS = 2_000_000
#: Fixed values of the score: scale, length norm, weights.
SCALE, DAMP, BASE, SLOPE, WEIGHT = 1_000_000_000, 12, 75, 25, 1000

#: Separators (all ASCII but letters and digits) become blanks, A-Z become a-z; bytes of other characters stay.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(TABLE).split() if text else []


def item_blocks(items: DataFrame, block_bytes: int):
    """Distinct (item_id, text) in blocks of about ``block_bytes`` (one longer item is a block of its own), by a hash of
    both; only one block at a time comes to the driver."""
    items = items.select("item_id", F.col("text").cast("string").alias("text")).where("text <> ''").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / block_bytes))
    for b in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == b).orderBy("item_id", "text").collect()
        rows = [(r["item_id"], c) for r in rows if (c := Counter(terms(r["text"].encode())))]
        if rows:
            yield rows


class Index:
    """Postings of a block: term number -> items and how often each asks for it."""

    def __init__(self, value):
        ends, self.items, self.times, self.weights, self.count = value
        self.begin, self.sizes = ends[:-1], np.diff(ends)


def _found(shared: Shared):
    """doc_id, n (terms of the document), numbers and counts of those in the index."""
    def run(batches):
        known: dict[bytes, int] = shared.get()
        for batch in slices(batches, lambda b: text_bytes(b.column(1)), 4 << 20):
            total, ends, numbers, counts = [], [0], [], []
            for text in batch.column(1).to_pylist():
                words = terms(text)
                total.append(len(words))
                tf = Counter(words)
                mine = sorted((known[t], t) for t in tf.keys() & known.keys())
                numbers += [i for i, _ in mine]
                counts += [tf[t] for _, t in mine]
                ends.append(len(numbers))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), pa.ListArray.from_arrays(at, pa.array(numbers, pa.int32())),
                                              pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))], names=["doc_id", "n", "terms", "tf"])

    return run


def length_norm(n: list[int], docs: int, length: int) -> np.ndarray:
    """100 - 25 + (25 * n * docs) div length of each document, without overflow."""
    return np.array([BASE + (SLOPE * x * docs) // length for x in n], dtype=np.int64)


class Heaps:
    """The best ``top`` (score, document) of each item: higher scores first, then
    smaller ids, a null id after all others."""

    LAST = np.iinfo(np.int64).max

    def __init__(self, items: int, top: int):
        self.top = top
        self.heaps: list[list[tuple]] = [[] for _ in range(items)]
        self.least = np.zeros(items, dtype=np.int64)  # what a newcomer has to beat
        self.worst = np.full(items, np.iinfo(np.int64).min)

    def offer(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``scores``: documents x items."""
        better = (scores > self.least) | ((scores == self.least) & (scores > 0) & (ids[:, None] < self.worst))
        for item in np.flatnonzero(better.any(axis=0)).tolist():
            heap = self.heaps[item]
            for d in np.flatnonzero(better[:, item]).tolist():
                entry = (int(scores[d, item]), -int(ids[d]), not null[d])
                if len(heap) < self.top:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.least[item], self.worst[item] = heap[0][0], -heap[0][1]

    def rows(self):
        for item, heap in enumerate(self.heaps):
            for score, place, known in heap:
                yield item, -place if known else None, score


def _best(shared: Shared, docs: int, length: int, top: int):
    """item, doc_id, score of each worker's heaps."""
    def run(batches):
        index: Index = shared.get()
        heaps = Heaps(index.count, top)
        step = max(1, CELLS // index.count)
        for batch in batches:
            ids, null = batch.column(0).fill_null(Heaps.LAST).to_numpy(), np.asarray(batch.column(0).is_null())
            norm = length_norm(batch.column(1).to_pylist(), docs, length)
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            ends = np.concatenate([[0], np.cumsum(sizes)])
            number = batch.column(2).flatten().to_numpy()
            tf = batch.column(3).flatten().to_numpy()
            of = np.repeat(np.arange(len(sizes)), sizes)
            part = index.weights[number] * ((SCALE * tf) // (WEIGHT * tf + DAMP * norm[of]))
            for at in range(0, len(sizes), step):
                to = min(at + step, len(sizes))
                mine = slice(ends[at], ends[to])
                posts = index.sizes[number[mine]]
                entry = np.repeat(index.begin[number[mine]] - (np.cumsum(posts) - posts), posts) + np.arange(posts.sum())
                scores = np.zeros((to - at) * index.count, dtype=np.int64)
                np.add.at(scores, np.repeat(of[mine] - at, posts) * index.count + index.items[entry], np.repeat(part[mine], posts) * index.times[entry])
                heaps.offer(scores.reshape(to - at, index.count), ids[at:to], null[at:to])
        rows = list(heaps.rows())
        if rows:
            item, doc, score = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item with a
    score above 0, equal scores by ascending doc_id (null after all others).

    Null and empty texts, and texts without a term, match nothing on either
    side and count for neither length. Rows that repeat a document are
    documents of their own; rows that repeat an item (id and text) are one item,
    equal ids with different texts several. Extra columns are ignored; an empty
    table on either side gives an empty result. Items of any number are
    searched, a block of ``block_bytes`` of their text at a time."""
    spark = docs.sparkSession
    id_type = items.schema["item_id"].dataType
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    out = None
    for block in item_blocks(items, block_bytes):
        one = _search_block(spark, base, block, id_type, top)
        out = one if out is None else out.unionByName(one)
    if out is None:
        schema = T.StructType([T.StructField("item_id", id_type), T.StructField("rank", T.IntegerType()),
                               T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
        out = spark.createDataFrame([], schema)
    return out


def _search_block(spark, base: DataFrame, block: list, id_type, top: int) -> DataFrame:
    numbers = {t: i for i, t in enumerate(sorted({t for _, c in block for t in c}))}
    found = staged(base.mapInArrow(_found(Shared(spark, numbers)), "doc_id long, n long, terms array<int>, tf array<long>"))
    docs, length = found.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    # as many rows as the block has terms, at most
    holders = dict(found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*")).collect())
    postings = sorted((numbers[t], k, times) for k, (_, c) in enumerate(block) for t, times in c.items())
    term, item, times = (np.array(x, dtype=np.int64) for x in zip(*postings))
    weights = np.array([math.floor(WEIGHT * math.log((2 * docs + 2) / (2 * holders.get(i, 0) + 1))) for i in range(len(numbers))], dtype=np.int64)
    ends = np.searchsorted(term, np.arange(len(numbers) + 1))
    index = Shared(spark, (ends, item, times, weights, len(block)), Index)
    best = found.where(F.size("terms") > 0).mapInArrow(_best(index, docs, length, top), "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ids = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", id_type)])
    names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(block)], ids)
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .join(names, "item").select("item_id", "rank", "doc_id", "score"))


#: The same rows from the definitions (for distinct item ids).
ORACLE_SQL = """
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM documents),
asks AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM benchmark) GROUP BY ALL),
counts AS (SELECT d, doc_id, term, count(*) AS tf FROM docs GROUP BY ALL),
lengths AS (SELECT d, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY d),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM lengths),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, total GROUP BY term, docs),
scores AS (SELECT item_id, doc_id, d, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) AS BIGINT) AS score
           FROM asks JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (d), total GROUP BY item_id, doc_id, d),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""
