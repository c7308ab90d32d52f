from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from lakemart.llm import ranking
from lakemart.llm.common import table
from llm_util import ODD


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=20):
    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in sorted({x for x in items if words(x[1])}, key=str):
        found = []
        for i, c in counted:
            m = 75 + (25 * sum(c.values()) * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if score > 0:
                found.append((-score, i is None, i))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:top], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus(prose):
    texts = [prose(3 + i % 50, i % 90) for i in range(200)] + ODD + ["Café 12 x1, ß", "same same"] + ["only here"] * 30
    return [(i, t) for i, t in enumerate(texts)] + [(None, "only here"), (5, "Only HERE"), (5, "Only HERE")]


@pytest.fixture(scope="module")
def items(prose):
    return ([(i, prose(4 + 3 * i, 40 + i)) for i in range(12)] + [(50, "only here"), (51, "CAFÉ café 12"), (52, None), (53, ""), (54, "..."),
            (55, "never seen zzzz"), (None, "same"), (50, "only here"), (56, "word " * 500)])


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, item int, rank int").repartition(4)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in ranking.search(d, q, **options).collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 60}])
def test_equals_brute_force(spark, corpus, items, options):
    assert run(spark, corpus, items, **options) == brute(corpus, items)


def test_few_cells_at_a_time(spark, corpus, items, monkeypatch):
    monkeypatch.setattr(ranking, "CELLS", 1)
    assert run(spark, corpus, items, top=3) == brute(corpus, items, 3)


def test_empty_tables(spark, corpus, items):
    assert run(spark, [], items) == [] and run(spark, corpus, []) == [] and run(spark, [(1, None)], items) == []


def test_heaps_keep_the_best_of_many_ties():
    rng = np.random.default_rng(1)
    scores, ids = rng.integers(0, 4, (500, 3)), rng.permutation(500).astype(np.int64)
    heaps = ranking.Heaps(3, 7)
    for at in range(0, 500, 11):
        part = slice(at, at + 11)
        heaps.offer(scores[part], ids[part], np.zeros(len(ids[part]), dtype=bool))
    for item in range(3):
        want = sorted((-int(s), int(i)) for s, i in zip(scores[:, item], ids) if s > 0)[:7]
        assert sorted((-s, i) for k, i, s in heaps.rows() if k == item) == want


def test_length_norm_does_not_overflow():
    assert ranking.length_norm([10**9], 10**12, 10**14).tolist() == [75 + 25 * 10**21 // 10**14]


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    got = {tuple(r) for r in ranking.search(table(spark, folder, "documents"), table(spark, folder, "benchmark")).collect()}
    assert got == {tuple(r) for r in con.sql(ranking.ORACLE_SQL).fetchall()}
