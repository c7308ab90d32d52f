from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from lakemart.llm import langid
from llm_util import ODD

SOUNDS = {"xx": ("the and ing tion er".split()), "yy": ("der ung sch ein ich".split()), "zz": ("qué ado ción ll os".split())}


def sentence(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.mark.parametrize("n", [2, 3, 5, 7, 12, 30])
def test_codewords_differ_enough(n):
    c = langid.code(n)
    apart = min(int((c[i] != c[j]).sum()) for i in range(n) for j in range(i))
    assert c.shape[0] == n and (c.min(0) != c.max(0)).all()
    assert apart >= (2 ** (n - 2) if n <= 7 else 5)  # the exhaustive code's distance; else two wrong bits are mended


def test_grams_count_by_hand():
    x, has = langid.grams(["ab ab", None, "  12 !", "AB, ab"])
    assert has.tolist() == [True, False, False, True]
    assert np.allclose(x[0], x[3]) and not x[1].any() and np.isclose(np.linalg.norm(x[0]), 1)
    # one text alone or among others: the same vector
    assert np.allclose(x[0], langid.grams(["zzz", "ab ab"])[0][1])


def test_a_wrong_bit_is_corrected():
    langs = sorted(SOUNDS) * 30
    x, _ = langid.grams([sentence(l, 12, i) for i, l in enumerate(langs)])
    model = langid.fit_vectors(x, langs)
    model.weights[:, 0] = 0  # a classifier that knows nothing
    model.bias[0] = 0
    told = langid.Decoder(model).predict([sentence(l, 12, 1000 + i) for i, l in enumerate(langs)])
    assert [r["lang"] for r in told] == langs


def test_held_out_accuracy_and_odd_rows(docs_of):
    langs = [random.Random(i).choice(sorted(SOUNDS)) for i in range(300)]
    texts = [sentence(l, 3 + i % 20, i) for i, l in enumerate(langs)]
    docs = docs_of(texts + ODD, langs=langs + [None, "xx", "xx", "yy", None, None])
    rows = {r["doc_id"]: r for r in langid.predictions(docs).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(rows[i]["held_out"] == (i in held) for i in range(300))
    assert sum(rows[i]["lang_pred"] == langs[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    assert [rows[300 + k]["lang_pred"] == "und" for k in range(len(ODD))] == [True] * 4 + [False] * 2
    assert langid.predictions(docs_of([])).count() == 0


def test_no_rows_or_one_language(docs_of):
    assert [r["lang_pred"] for r in langid.predictions(docs_of(["abc", None], langs=[None, "xx"])).collect()] == ["und", "und"]
    rows = langid.predictions(docs_of(["abc def", "qqq", "1"], langs=["xx", "xx", None])).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in rows} == {0: "xx", 1: "xx", 2: "und"}


@pytest.mark.parametrize("n, rows", [(1_000, 1_600), (20_000, 1_600), (10**11, 1_600), (10**15, 1_600)])
def test_thinning_keeps_the_expected_rows_at_any_count(spark, n, rows):
    hashes = spark.range(200_000).select(F.xxhash64("id").alias("h"))
    # the hash's range is shrunk, as if it came from n rows: h // scale of a scale-th part of the least hashes
    scale = max(1, n // 200_000)
    near = F.expr(f"cast(floor((cast(h as decimal(38,0)) + 9223372036854775808) / {scale}) - 9223372036854775808 as bigint)")
    got = hashes.where(langid.thinned(near, n, rows)).count()
    want = min(200_000, 200_000 * scale * min(1, rows / n))
    assert abs(got - want) <= 6 * want**0.5


def test_a_language_of_billions_of_rows_stays_in_the_model(docs_of, monkeypatch):
    rows = {"many": 40, "few": 40}
    docs = docs_of([f"{'zu ze zi' if i % 2 else 'ka ko ku'} {i}" for i in range(80)], langs=["many" if i % 2 else "few" for i in range(80)])
    asked = []
    real = langid.thinned
    monkeypatch.setattr(langid, "thinned", lambda h, n, r: asked.append((n, r)) or real(h, n, r))
    assert sorted(langid.fit(docs).languages) == sorted(rows) and all(r == 1_600 for _, r in asked)
