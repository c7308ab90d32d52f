from __future__ import annotations

import math

import numpy as np
import pytest

from lakemart.llm import vectors


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1) for i, v in rows],
                                 "vec_id long, embedding array<float>, query_id int")


def brute(rows, k):
    seen = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v) and any(v):
            seen.setdefault(i, np.array(v, dtype=np.float32).astype(float))
    out = {}
    for q, x in seen.items():
        if q % 20 == 0:
            out[q] = sorted(((-float((x * y).sum()), i) for i, y in seen.items() if i != q))[:k]
    return out


def run(spark, rows, **options):
    df = frame(spark, rows)
    got = {}
    for r in vectors.nearest(df, df.where("vec_id % 20 = 0"), **options).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_chi_square_quantiles():
    for p, m, want in ((0.95, 1, 3.8415), (0.95, 10, 18.307), (0.99, 6, 16.812), (0.5, 2, 1.3863)):
        assert vectors.chi_square_quantile(p, m) == pytest.approx(want, abs=1e-3)


@pytest.mark.parametrize("options", [{}, {"block_vectors": 100, "block_queries": 7}, {"leaf": 4, "dimensions": 6}])
def test_recall_against_brute_force(spark, options):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16) * rng.uniform(0.5, 2)) for i in range(600)]
    got, want = run(spark, rows, **options), brute(rows, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)


def test_copies_ties_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    hot = rng.normal(size=8)
    rows = [(i, hot) for i in range(200)] + [(200 + i, rng.normal(size=8)) for i in range(30)]
    rows += [(400, None), (420, [0.0] * 8), (440, [float("nan")] * 8), (460, [None] + [1.0] * 7), (480, [float("inf")] * 8), (None, hot), (500, [])]
    rows += [(0, hot)]  # a repeated row
    got, want = run(spark, rows, block_vectors=64), brute(rows, 20)
    assert set(got) == set(want)
    for q in range(0, 200, 20):  # ties go to the smaller id
        assert [i for _, i in got[q]] == [i for _, i in want[q]]


def test_few_rows_and_empty_tables(spark):
    assert run(spark, []) == {}
    assert run(spark, [(20, [1.0, 0.0])]) == {}
    got = run(spark, [(20, [1.0, 0.0]), (1, [-1.0, 2.0]), (2, [0.5, 0.5])])
    assert [i for _, i in got[20]] == [2, 1]
