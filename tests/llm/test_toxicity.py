from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from lakemart.llm import toxicity
from llm_util import ODD


def brute_marginals(e, trans, start):
    """P(toxic) by enumerating every labelling of one document."""
    n, total, on = len(e), 0.0, np.zeros(len(e))
    for y in itertools.product((0, 1), repeat=n):
        s = sum(e[i] for i in range(n) if y[i]) + (start if y[0] else 0) + sum(trans[a, b] for a, b in zip(y, y[1:]))
        w = np.exp(s)
        total += w
        on += w * np.array(y)
    return on / total


@pytest.mark.parametrize("block", [1, 2, 128])
def test_marginals_match_enumeration(block, monkeypatch):
    rng = np.random.default_rng(block)
    lengths = [1, 5, 8, 2]
    e = rng.normal(0, 2, sum(lengths))
    first = np.zeros(len(e), dtype=bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    trans, start = rng.normal(0, 1, (2, 2)), -0.7
    scan = toxicity._scan
    monkeypatch.setattr(toxicity, "_scan", lambda *a: scan(*a, block=block))
    got = toxicity.marginals(e, first, trans, start)
    want, at = [], 0
    for n in lengths:
        want += list(brute_marginals(e[at:at + n], trans, start))
        at += n
    assert np.allclose(got, want)


@pytest.fixture(scope="module")
def labelled(words):
    rng = random.Random(5)
    bad = ["zorgly", "blexor", "quixtra"]
    texts, toxic = [], []
    for i in range(240):
        w = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        if i % 3 == 0:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w)), rng.choice(bad) + rng.choice(["", "s", "ing"]))
        texts.append(" ".join(w))
        toxic.append(int(i % 3 == 0))
    return texts, toxic


def test_held_out_accuracy_spans_and_odd_rows(spark, docs_of, labelled):
    texts, toxic = labelled
    docs = docs_of(texts + ODD)
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)] + [(None, 0, 1), (3, None, None), (9999, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in toxicity.predictions(docs, labels).collect()}
    assert len(rows) == len(texts) + len(ODD)
    held = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(rows[i]["held_out"] == (i in held) for i in range(len(texts)))
    assert sum(rows[i]["predicted"] == toxic[i] for i in held) >= 0.95 * len(held)
    for i in held:  # the offsets are those of whole words
        for s in rows[i]["spans"]:
            assert texts[i][s["start"]:s["end"]].strip() and (s["start"] == 0 or texts[i][s["start"] - 1] == " ")
        if toxic[i] and rows[i]["predicted"]:
            assert any(b in texts[i][s["start"]:s["end"]] for s in rows[i]["spans"] for b in ("zorgly", "blexor", "quixtra"))
    for k in range(len(texts), len(texts) + len(ODD)):
        assert 0 <= rows[k]["score"] < 0.3 and rows[k]["predicted"] == 0
    assert all(rows[k]["spans"] == [] for k in range(len(texts), len(texts) + 4))


def test_without_labels_empty_table_and_clashing_columns(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = docs_of(["a b", None])
    assert [r["score"] for r in toxicity.predictions(docs, none).collect()] == [0.0, 0.0]
    assert toxicity.predictions(docs_of([]), none).count() == 0
    named = docs.withColumnRenamed("source", "_toxicity").withColumnRenamed("lang", "score")
    kept = toxicity.keep_clean(named, none)
    assert kept.columns == named.columns and kept.count() == 2


def test_copies_are_joined_only_at_high_similarity(prose):
    one = prose(90, 1).split()
    near = one[:40] + ["other"] + one[41:]
    shared = [" ".join(one[:45] + prose(45, 10 + i).split()) for i in range(8)]  # 3-shingle Jaccard about 0.3
    groups = toxicity.copy_groups([" ".join(one), " ".join(near), *shared])
    assert groups[0] == groups[1] and len(set(groups[1:])) == 1 + len(shared)


def test_copies_of_few_toxic_texts_do_not_make_everything_toxic(prose):
    bad = [prose(30, 1) + " zorgly blexor", prose(40, 2) + " quixtra zorgly"]
    clean = [prose(50, 100 + i) for i in range(400)]
    model = toxicity.fit_rows(clean + bad * 20, [0] * 400 + [1] * 40, 0.02)
    scores = toxicity.Scorer(model).score([prose(50, 3000 + i) for i in range(100)] + bad)[0]
    assert (scores[:100] < toxicity.THRESHOLD).mean() >= 0.98 and (scores[100:] >= toxicity.THRESHOLD).all()


def test_the_constant_is_the_share_of_all_labels(spark, docs_of, prose):
    texts = [prose(20, i) for i in range(120)]
    labels = spark.createDataFrame([(i, int(i % 30 == 0)) for i in range(120)], "doc_id long, toxic int")
    used = [i for i in range(120) if zlib.crc32(str(i).encode()) % 4 != 2]
    model = toxicity.fit(docs_of(texts), labels, rows_per_class=4)
    assert model.constant == pytest.approx(sum(i % 30 == 0 for i in used) / len(used)) and 0 < model.constant < toxicity.THRESHOLD


def test_rarer_words_are_labelled_when_chance_is_ruled_out():
    n = 1600
    tokens = [[f"w{i % 50}", "zorgly"] if i < 20 else [f"w{i % 50}"] for i in range(n)] + [[f"w{i % 50}"] for i in range(n)]
    toxic = np.array([1] * n + [0] * n)
    labels = toxicity.token_labels(tokens, toxic, np.arange(2 * n))  # in 1.25 % of the toxic documents
    assert all(list(l) == [False, True] for l in labels[:20]) and not any(l.any() for l in labels[20:])


def test_the_segment_bound_is_a_parameter(labelled):
    texts, toxic = labelled
    few, all_ = (toxicity.fit_rows(texts, toxic, max_segments=m) for m in (5, 4000))
    assert not np.array_equal(few.weights, all_.weights)
