from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def words():
    rng = random.Random(3)
    return ["".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(600)]


@pytest.fixture(scope="session")
def prose(words):
    def make(n, seed):
        rng = random.Random(seed)
        return " ".join(rng.choice(words) for _ in range(n))

    return make


@pytest.fixture
def docs_of(spark):
    """documents from texts (ids from 0), with a clashing extra column."""

    def make(texts, ids=None, langs=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, None if langs is None else langs[k], f"s{k % 3}", None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts))]
        return spark.createDataFrame(rows, DOCS)

    return make


