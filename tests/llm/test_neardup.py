from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from lakemart.llm import neardup
from llm_util import ODD


def shingle_set(text, n=5):
    """Shingles with their occurrences."""
    w = neardup.WORD.findall((text or "").lower())
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else Counter([tuple(w)] if w else [])


def linked(a, b):
    """Weighted Jaccard similarity of at least 0.8."""
    return bool(a and b) and sum((a & b).values()) >= 0.8 * sum((a | b).values()) - 1e-9


def brute(texts):
    """Components of all pairs at or above the similarity, or of equal texts."""
    sets = [shingle_set(t) for t in texts]
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if texts[i] is not None and (texts[i] == texts[j] or linked(a, b)):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return [top(i) for i in range(len(texts))]


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    k = 2000
    a = rng.integers(1, 2**63, 60).astype(np.uint64)
    w1, w2 = rng.uniform(0.2, 5, 60), rng.uniform(0.2, 5, 60)
    w1[:15], w2[45:] = 0, 0
    on1, on2 = w1 > 0, w2 > 0
    h = np.concatenate([a[on1], a[on2]])
    d = np.repeat([0, 1], [on1.sum(), on2.sum()])
    sig = neardup.dart_minhash(h, d, 3, k, np.concatenate([w1[on1], w2[on2]]))
    want = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.05
    assert (sig[0] != 0).all() and (sig[2] == 0).all()


def test_unit_weights_ignore_repeats():
    h = np.array([5, 9, 9, 12, 5, 9, 12], dtype=np.uint64)
    sig = neardup.dart_minhash(h, np.array([0, 0, 0, 0, 1, 1, 1]), 2, 64)
    assert (sig[0] == sig[1]).all()


@pytest.fixture(scope="module")
def corpus(prose):
    rng = random.Random(9)
    texts = [prose(rng.randint(30, 200), 100 + i) for i in range(40)]
    for i in range(40):  # copies with some words changed: from far above to far below the similarity
        w = texts[i].split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    return texts + texts[:10] + ODD + ["", "a b", "a b c", "A b c.", "*** !!!"]


def test_classes_match_brute_force(docs_of, corpus):
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs_of(corpus)).collect()}
    assert [got[i] for i in range(len(corpus))] == brute(corpus)


@pytest.mark.parametrize("block", [8, 1000])
def test_large_buckets_stay_whole(docs_of, prose, block):
    """A group of many near copies, in blocks smaller than its buckets and in one."""
    rng = random.Random(4)
    base = prose(150, 7).split()
    texts = [" ".join(base)]
    for i in range(120):
        w = list(base)
        for _ in range(1 + i % 7):
            w[rng.randrange(len(w))] = f"w{rng.randrange(50)}"
        texts.append(" ".join(w))
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs_of(texts), block=block).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


def test_one_bucket_of_two_thousand_near_copies(docs_of, prose):
    """The size of a bucket changes nothing in the result."""
    rng = random.Random(8)
    base = prose(60, 3).split()
    texts = []
    for i in range(2000):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(30)}"
        texts.append(" ".join(w))
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs_of(texts)).collect()}
    # the same components by brute force over the distinct texts
    first = {}
    for i, t in enumerate(texts):
        first.setdefault(t, i)
    want = dict(zip(first, brute(list(first))))
    ids = list(first.values())
    assert [got[i] for i in range(len(texts))] == [ids[want[t]] for t in texts]


def test_repeated_ids_with_different_texts_lose_no_document(spark, prose):
    a, b = prose(50, 1), prose(50, 2)
    docs = spark.createDataFrame([(5, a, 1), (5, b, 2), (3, a, 3), (9, b, 4), (5, a, 5)], "doc_id long, text string, _key int")
    rows = sorted((r["doc_id"], r["class_id"], r["representative"]) for r in neardup.classes(docs).collect())
    assert rows == [(3, 3, True), (5, 3, False), (5, 3, False), (5, 5, True), (9, 5, False)]
    kept = sorted(tuple(r) for r in neardup.keep_representatives(docs).collect())
    assert kept == [(3, a, 3), (5, b, 2)]


def test_occurrences_are_weights(docs_of, prose):
    """Equal sets of shingles with different occurrences are less similar; the brute force counts them too."""
    line = prose(12, 5)
    texts = [" ".join([line] * n) for n in (2, 3, 10, 11, 40)]
    assert [linked(shingle_set(texts[0]), shingle_set(t)) for t in texts[1:3]] == [False, False]
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs_of(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts) == [0, 1, 2, 2, 4]
    h, d, n = neardup.counted(np.array([7, 5, 7, 7], dtype=np.uint64), np.array([0, 0, 0, 1]))
    assert (h.tolist(), d.tolist(), n.tolist()) == ([5, 7, 7], [0, 0, 1], [1, 2, 1])
    assert len(set(neardup.elements(h, n).tolist())) == 3


def test_null_ids_empty_table_and_representatives(docs_of, corpus):
    assert neardup.classes(docs_of([])).count() == 0
    rows = neardup.classes(docs_of(["x y z", "x y z", None], ids=[None, 4, 5])).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in rows) == [("4", "4"), ("5", "5"), ("None", "None")]
    docs = docs_of(corpus + ["x y z", "x y z"], ids=[*range(len(corpus)), 5000, 5000])
    kept = neardup.keep_representatives(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect())
    assert ids == sorted({*brute(corpus)}) + [5000]
    lone = neardup.keep_representatives(docs_of(["x", "x"], ids=[None, 1]))
    assert lone.count() == 2  # a row without an id stays
