from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from lakemart.llm import sharding
from llm_util import ODD


def check(rows, texts, shards):
    assert len(rows) == len(texts)
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        t = texts[r["doc_id"]]
        assert r["size"] == 16 + len((t or "").encode())
        assert r["text_crc32"] == (None if t is None else zlib.crc32(t.encode()))
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [sizes[i] for i in range(shards)]


def test_near_equal_bytes_and_gapless_slots(docs_of, prose):
    rng = random.Random(1)
    texts = [prose(rng.randint(1, 60), i) for i in range(1500)] + ["copy " * 40] * 700 + [None] * 20 + ODD[:5]
    rows = sharding.shard(docs_of(texts).repartition(5), shards=8, cell_rows=50).collect()
    sizes = check(rows, texts, 8)
    mean, largest = sum(sizes) / 8, max(r["size"] for r in rows)
    assert all(abs(s - mean) <= 2 * (largest + sharding.TOLERANCE * mean) for s in sizes)
    # a text that fits stays whole but for the boundaries: every split text lies at a splitter
    where = defaultdict(set)
    for r in rows:
        where[texts[r["doc_id"]]].add(r["shard"])
    split = [t for t, s in where.items() if len(s) > 1]
    assert len(split) <= 7 and all(sorted(where[t]) == list(range(min(where[t]), max(where[t]) + 1)) for t in split)


def test_same_input_same_shards(docs_of, prose):
    texts = [prose(5 + i % 9, i) for i in range(300)]
    one = sorted(sharding.shard(docs_of(texts), shards=5).collect())
    assert one == sorted(sharding.shard(docs_of(texts).repartition(7), shards=5).collect())


@pytest.mark.parametrize("texts", [[], ["a"], [None, None], ["same"] * 30, ODD])
def test_few_rows(docs_of, texts):
    check(sharding.shard(docs_of(texts), shards=10).collect(), texts, 10)


def test_repeated_rows_and_digest(docs_of):
    rows = sharding.digest(docs_of(["x", "x", "y", None], ids=[3, 3, None, None])).collect()
    assert len(rows) == 4 and {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}


@pytest.mark.parametrize("ids", [[7] * 3000, [None] * 3000])
def test_equal_rows_are_divided(spark, docs_of, prose, ids):
    texts = ["one row again and again"] * 3000 + [prose(8, i) for i in range(1000)]
    docs = docs_of(texts, ids=ids + list(range(10_000, 11_000))).repartition(6)
    rows = sharding.shard(docs, cell_rows=20).collect()
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    mean, largest = sum(sizes.values()) / 40, max(r["size"] for r in rows)
    assert len(rows) == 4000 and len(sizes) == 40
    assert all(abs(s - mean) <= largest + sharding.TOLERANCE * mean for s in sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_no_python_in_the_plan(docs_of):
    df = sharding.digest(docs_of(["a", "b"]))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
