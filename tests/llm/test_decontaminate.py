from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from lakemart.llm import decontaminate
from llm_util import ODD


@pytest.fixture(scope="module")
def items(prose):
    return [prose(15 + 3 * i, 900 + i) for i in range(12)] + ["one two three four five six", "short item"]


def bench(spark, items):
    return spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(None, "a b c d e f"), (77, None), (78, "")], "item_id long, text string")


def brute(text, item):
    """The best ungapped run over all diagonals, by the operator's rule."""
    a = decontaminate.WORD.findall((text or "").lower())
    b = decontaminate.WORD.findall(item.lower())
    if len(b) < decontaminate.MIN_ITEM:
        return None
    best = None
    for d in range(-len(b) + 1, len(a)):
        lo, hi = max(0, -d), min(len(b), len(a) - d)
        x, y = decontaminate.best_run(np.array([a[d + i] == b[i] for i in range(lo, hi)]))
        same = sum(a[d + lo + i] == b[lo + i] for i in range(x, y))
        if y - x >= min(decontaminate.MIN_WORDS, len(b)) and same >= decontaminate.MIN_IDENTITY * (y - x):
            best = max(best or (0, 0), (same, y - x))
    return best


def test_planted_passages_are_found_and_clean_text_left(spark, docs_of, prose, items):
    rng = random.Random(2)
    texts = [prose(80, 50 + i) for i in range(20)]
    for i, item in enumerate(items[:13]):
        w = item.split()
        for _ in range(i % 3):  # substitutions
            w[rng.randrange(len(w))] = "other"
        texts.append(f"{prose(30, 300 + i)} {' '.join(w).upper() if i % 2 else ' '.join(w)}, {prose(20, 400 + i)}")
    texts += ODD + [items[0] + " " + items[0], items[3]]
    docs = docs_of(texts)
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(docs, bench(spark, items)).collect()}
    want = {(d, k): b for d, t in enumerate(texts) for k, item in enumerate(items) if (b := brute(t, item))}
    assert set(got) == set(want)
    for key, r in got.items():
        assert (r["equal"], r["words"]) == want[key]
        run = decontaminate.WORD.findall(texts[key[0]][r["start"]:r["end"]])
        assert len(run) == r["words"]
    kept = decontaminate.keep_unleaked(docs, bench(spark, items))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(range(len(texts))) - {d for d, _ in want})


def test_blocks_give_the_same_rows(spark, docs_of, items):
    docs = docs_of([items[4], items[7] + " x", None])
    one = sorted(decontaminate.leaks(docs, bench(spark, items)).collect())
    assert one and one == sorted(decontaminate.leaks(docs, bench(spark, items), block_chars=200).collect())


def test_empty_tables(spark, docs_of, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(docs_of(["a b c"]), none).count() == 0
    assert decontaminate.leaks(docs_of([]), bench(spark, items)).count() == 0
    assert decontaminate.keep_unleaked(docs_of(["a"]), none).count() == 1


def equal_words(text, item):
    """Whether some run of 12 words or more (a shorter item whole) on some diagonal has three quarters equal, by counting every run."""
    a, b = decontaminate.WORD.findall(text.lower()), decontaminate.WORD.findall(item.lower())
    least = min(12, len(b))
    for d in range(-len(b) + 1, len(a)):
        same = [a[d + i] == b[i] for i in range(max(0, -d), min(len(b), len(a) - d))]
        if any(4 * sum(same[i:j]) >= 3 * (j - i) for i in range(len(same)) for j in range(i + least, len(same) + 1)):
            return True
    return False


def test_substitutions_anywhere_in_an_overlap_are_found(spark, docs_of, prose):
    rng = random.Random(8)
    lengths = [5, 6, 7, 8, 9, 10, 11, 12, 12, 13, 14, 15, 18, 22]
    items = [prose(n, 7000 + i) for i, n in enumerate(lengths)]
    texts, whole = [], []
    for k, item in enumerate(items):
        n = len(item.split())
        for differ in range(n // 4 + 2):
            for _ in range(4):
                w = item.split()
                for i in rng.sample(range(n), differ):
                    w[i] = "other"
                whole.append((len(texts), k, differ <= n // 4))
                texts.append(f"{prose(rng.randrange(6), len(texts))} {' '.join(w)} {prose(rng.randrange(6), 99 + len(texts))}")
    for at in (0, 11):  # a part of 12 words, its first or last word changed
        w = items[-1].split()[5:17]
        w[at] = "other"
        texts.append(f"{prose(20, 5)} {' '.join(w)} {prose(20, 6)}")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(docs_of(texts), bench(spark, items)).collect()}
    assert set(got) == {(d, k) for d, t in enumerate(texts) for k, item in enumerate(items) if equal_words(t, item)}
    assert {(d, k) for d, k, found in whole if found} <= set(got)
    assert all(4 * r["equal"] >= 3 * r["words"] and r["words"] >= min(12, lengths[k]) for (_, k), r in got.items())


def test_no_seed_pattern_misses_a_run():
    for n in range(12, 21):
        hits = np.array([sum(1 << (o + i) for i, b in enumerate(m) if b == "1") for m in decontaminate.MASKS for o in range(n - len(m) + 1)])
        for zeros in itertools.combinations(range(n), n // 4):
            assert (hits & sum(1 << i for i in zeros) == 0).any()
    for n in range(5, 12):
        masks = decontaminate.whole_masks(n, 0.75)
        for zeros in itertools.combinations(range(n), n // 4):
            assert any(all(m[i] == "0" for i in zeros) for m in masks)
