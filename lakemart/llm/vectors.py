"""Nearest neighbours by low-dimensional stable projections and a kd-tree.

Largest inner product is turned into least distance: with M the largest norm, a
vector x becomes (x, sqrt(M^2 - |x|^2)) and a query (q, 0); then the squared
distance is |q|^2 + M^2 - 2<q, x>. The vectors are projected to a few dimensions
by a Gaussian (2-stable) matrix: a squared projected distance, divided by the
squared distance, is chi-square distributed. A query takes the leaves of a
kd-tree over the projections in the order of their least projected distance
and verifies their vectors exactly (double precision), until the chi-square
test says that a vector nearer than the k-th found would with probability
``confidence`` have been seen already.

Spark deals blocks of vectors against blocks of queries: a task holds one of
each, so its memory is bounded; the answers of a query over all blocks are
merged by a top-k aggregate. Equal vectors of a block are searched once and
keep their k + 1 least ids, which is all that can be among the k nearest.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIMENSIONS = 10
LEAF = 32
CONFIDENCE = 0.99
K = 20
BLOCK_VECTORS = 8192
BLOCK_QUERIES = 1024


def chi_square_quantile(p: float, m: int) -> float:
    """The p-quantile of the chi-square distribution with m degrees of freedom, by bisection."""

    def cdf(x: float) -> float:  # regularised lower incomplete gamma, series
        a, x = m / 2, x / 2
        if x <= 0:
            return 0.0
        term = total = 1.0 / a
        n = 0
        while term > total * 1e-15 and n < 10_000:
            n += 1
            term *= x / (a + n)
            total += term
        return min(1.0, total * math.exp(-x + a * math.log(x) - math.lgamma(a)))

    lo, hi = 0.0, m + 20.0 * math.sqrt(2 * m) + 20
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < p else (lo, mid)
    return hi


def projection(dimension: int, m: int, seed: int = 5) -> np.ndarray:
    return np.random.default_rng([seed, dimension, m]).standard_normal((dimension, m))


class Tree:
    """A kd-tree over projected points, kept as its leaves and their boxes."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.order = np.arange(len(points))
        self.bounds: list[tuple[int, int]] = []
        todo = [(0, len(points))]
        while todo:  # split at the median of the widest dimension
            lo, hi = todo.pop()
            part = points[self.order[lo:hi]]
            wide = np.ptp(part, axis=0)
            if hi - lo <= leaf or not wide.max() > 0:
                self.bounds.append((lo, hi))
                continue
            d, mid = int(np.argmax(wide)), (hi - lo) // 2
            self.order[lo:hi] = self.order[lo:hi][np.argpartition(part[:, d], mid)]
            todo += [(lo, lo + mid), (lo + mid, hi)]
        self.low = np.array([points[self.order[a:b]].min(0) for a, b in self.bounds])
        self.high = np.array([points[self.order[a:b]].max(0) for a, b in self.bounds])
        self.start = np.array([a for a, _ in self.bounds])
        self.size = np.array([b - a for a, b in self.bounds])

    def distances(self, q: np.ndarray) -> np.ndarray:
        """Squared projected distance of each query to each leaf's box."""
        out = np.zeros((len(q), len(self.bounds)))
        for d in range(q.shape[1]):
            x = q[:, d:d + 1]
            out += np.square(np.maximum(np.maximum(self.low[:, d] - x, x - self.high[:, d]), 0.0))
        return out


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, in double precision; equal rows give equal values wherever they stand."""
    return np.multiply(a, b).sum(axis=-1)


def search(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, most: float, k: int, m: int, leaf: int,
           confidence: float, step: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, score) of the k nearest found in a block, the query's own id left out."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    view = np.ascontiguousarray(x + 0.0).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel()
    _, first, group = np.unique(view, return_index=True, return_inverse=True)
    points = x[first]
    by_group = np.argsort(group, kind="stable")  # ids ascending within a group
    begin = np.concatenate([[0], np.cumsum(np.bincount(group))])
    norms = exact(points, points)
    lift = np.sqrt(np.maximum(most - norms, 0.0))
    matrix = projection(x.shape[1] + 1, m)
    tree = Tree(points @ matrix[:-1] + lift[:, None] * matrix[-1], leaf)
    near = tree.distances(q @ matrix[:-1])
    leaves = np.argsort(near, axis=1, kind="stable")
    near = np.take_along_axis(near, leaves, axis=1)
    limit = chi_square_quantile(confidence, m)
    base = exact(q, q) + most
    n = len(q)
    # the query itself may be one of the points: one more is kept, and it is left out at the end
    keep = k + 1
    best = np.full((n, keep), -np.inf)
    which = np.full((n, keep), -1)
    active = np.arange(n)
    at = 0
    total = leaves.shape[1]
    width = int(tree.size.max()) if total else 0
    spread = np.arange(width)
    while len(active) and at < total:
        if at:  # the k-th distance found, against the projected distance that is next
            kth = np.maximum(base[active] - 2 * best[active, -1], 0.0)
            active = active[~(near[active, at] > limit * kth)]
            if not len(active):
                break
        to = min(total, at + step)
        here = leaves[active, at:to]
        slot = tree.start[here][:, :, None] + spread
        real = spread < tree.size[here][:, :, None]
        slot = np.where(real, slot, 0).reshape(len(active), -1)
        found = tree.order[slot]
        score = np.einsum("qcd,qd->qc", points[found], q[active])
        score = np.where(real.reshape(len(active), -1), score, -np.inf)
        both = np.concatenate([best[active], score], 1)
        names = np.concatenate([which[active], found], 1)
        top = np.argpartition(-both, keep - 1, axis=1)[:, :keep]
        both, names = np.take_along_axis(both, top, 1), np.take_along_axis(names, top, 1)
        down = np.argsort(-both, axis=1, kind="stable")
        best[active], which[active] = np.take_along_axis(both, down, 1), np.take_along_axis(names, down, 1)
        at = to
    row, col = np.nonzero(which >= 0)
    point = which[row, col]
    score = exact(points[point], q[row])
    copies = np.minimum(begin[point + 1] - begin[point], keep)  # the least ids of equal vectors
    again = np.repeat(np.arange(len(row)), copies)
    nth = np.arange(len(again)) - np.repeat(np.cumsum(copies) - copies, copies)
    vec = ids[by_group[begin[point[again]] + nth]]
    row, score = row[again], score[again]
    other = query_ids[row] != vec
    row, vec, score = row[other], vec[other], score[other]
    order = np.lexsort((vec, -score, row))
    row, vec, score = row[order], vec[order], score[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    cut = rank < k
    return query_ids[row[cut]], vec[cut], score[cut]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, dimensions: int = DIMENSIONS, leaf: int = LEAF,
            confidence: float = CONFIDENCE, block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` (vec_id,
    embedding) the k vectors of other ids with the largest inner product found,
    ties to the smaller id; fewer, if there are fewer.

    Vectors that are null, empty, zero, or hold null or non-finite components take no
    part, neither do null ids and vectors of a length other than the most frequent (the
    longest of equals). Rows that repeat id and vector count once. Other
    columns are ignored; an empty table on either side gives an empty result."""
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        v = F.col("embedding").cast("array<double>")
        fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists("v", lambda c: c != 0)
        return df.select(F.col("vec_id").cast("long").alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL").where(fine)

    points, asked = usable(vectors), usable(queries)
    norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c * c)
    shape = points.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(norm).alias("most")).collect()
    result = "query_id long, vec_id long, score double"
    if not shape:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    chosen = max(shape, key=lambda r: (r["n"], r["d"]))
    size, rows, most = chosen["d"], chosen["n"], chosen["most"]
    points, asked = points.where(F.size("v") == size), asked.where(F.size("v") == size)
    across = max(1, math.ceil(rows / block_vectors))
    down = max(1, math.ceil(asked.count() / block_queries))

    # a cell of the grid holds one block of either; blocks are dealt by a hash of the id
    def dealt(df: DataFrame, own: int, other: int, is_query: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("id", F.lit(is_query)), F.lit(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        mine, theirs = ("row", "col") if is_query else ("col", "row")
        return df.select("id", "v", block.alias(mine), every.alias(theirs))

    def cell(left, right):
        import pandas as pd

        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        left, right = (d if d["id"].is_unique else d.loc[~d.assign(v=d["v"].map(lambda a: np.asarray(a).tobytes())).duplicated(["id", "v"])]
                       for d in (left, right))
        found = search(left["id"].to_numpy(), np.stack(left["v"].to_numpy()), right["id"].to_numpy(), np.stack(right["v"].to_numpy()),
                       most, k, dimensions, leaf, confidence)
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)))

    found = (dealt(points, across, down, False).groupBy("col", "row")
             .cogroup(dealt(asked, down, across, True).groupBy("col", "row")).applyInPandas(cell, result))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
