from __future__ import annotations

import re

from lakemart.llm import licenses
from llm_util import ODD

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [
    "Released under the MIT License.", "Under the MIT license under-the-mit license", "Licensed under the Apache License, Version 2.0.",
    "apache license version 20", "cc by nc; CC-BY-NC 4.0 cc by nd", "This work is licensed under the GNU General Public License, version 3.",
    "licensed under the gnu lesser general public license", "émit under the mit license", "[under]the{mit}license", "nothing of the kind",
    "Permission is hereby granted, free of charge, to any nice person obtaining a copy of this software and associated documentation files "
    "(the Software), to deal in the Software without restriction", "under the mit " * 50 + "license",
]


def brute(text):
    w = WORDS.findall((text or "").translate(LOW))
    places, labels = [], set()
    for label, phrase in licenses.BASE.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_matches_brute_force(docs_of):
    texts = TEXTS + ODD
    rows = {r["doc_id"]: r for r in licenses.scan(docs_of(texts)).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    assert rows[5]["labels"] == "gpl" and rows[6]["labels"] == "lgpl" and rows[9]["labels"] == ""
    assert rows[10]["labels"] == "mit" and rows[10]["n_base"] == 0  # a word put in: two neighbouring diagonals


def test_repeated_rows_null_ids_and_empty_table(docs_of):
    rows = licenses.scan(docs_of([TEXTS[0], TEXTS[0], TEXTS[0], None, None], ids=[4, 4, None, None, 4])).collect()
    assert sorted((str(r["doc_id"]), r["n_base"]) for r in rows) == [("4", 0), ("4", 1), ("4", 1), ("None", 0), ("None", 1)]
    assert licenses.scan(docs_of([])).count() == 0


def test_no_python_in_the_plan(docs_of):
    plan = licenses.scan(docs_of(["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
