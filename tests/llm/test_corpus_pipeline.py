"""The pipeline on a small corpus: every stage against a brute-force version."""

from __future__ import annotations

import os
import random
import tempfile
from collections import defaultdict

import pytest

import __spark_entry__ as E
import corpus_pipeline
from lakemart.llm import registry
from lakemart.llm.neardup import WORD

BAD = ("zorgly", "blexor")


@pytest.fixture(scope="module")
def sf_dir(spark, words):
    rng = random.Random(8)
    rows, labels = [], []
    items = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(4)]
    for i in range(160):
        w = [rng.choice(words) for _ in range(rng.randint(30, 90))]
        if i % 5 == 0:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(BAD))
        text = " ".join(w)
        if i % 20 == 7:
            text += " " + items[i // 20 % 4]
        if i % 20 == 8:
            text += f' token = "{i:04d}aaaabbbbccccddddeeeeffff0000"'
        rows.append((i, text))
        labels.append((i, 1, int(i % 5 == 0)))
    rows += [(1000 + i, rows[i][1]) for i in range(1, 30)]  # copies
    rows += [(2000, None), (2001, ""), (2002, "short")]
    d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.createDataFrame([(i, t, "xx", "s", None if t is None else len(t)) for i, t in rows],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, dict(rows), items


def test_stages(spark, sf_dir):
    d, texts, items = sf_dir
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, d)
        path = os.path.join(tempfile.mkdtemp(prefix="run-", dir="/tmp"), name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == columns
            kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = {i for i, t in texts.items() if not any(b in (t or "").split() for b in BAD)}
    assert set(kept["toxicity"]) == clean
    groups = defaultdict(list)
    for i in clean:
        groups[texts[i] if texts[i] is not None else ("null", i)].append(i)
    assert set(kept["near_duplicates"]) == {min(g) for g in groups.values()}
    assert set(kept["decontamination"]) == {i for i in kept["near_duplicates"] if not any(x in (texts[i] or "") for x in items)}
    assert set(kept["secrets"]) == set(kept["decontamination"])
    changed = {i for i, t in kept["secrets"].items() if t != texts[i]}
    assert changed == {i for i in kept["secrets"] if "token" in (texts[i] or "") and "ffff0000" in texts[i]}
    packed = docs.collect()
    assert {r["doc_id"] for r in packed} == set(kept["secrets"])
    assert all(WORD.findall(texts[i] or "x") for i in kept["secrets"] if i < 1000)


def test_run_and_registration(spark, sf_dir):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    queries = E.queries()
    assert set(registry.QUERIES) | {"pipeline"} <= set(queries)
    assert sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES) == list(range(1, 14))
    assert queries["pipeline"](spark, sf_dir[0]).count() > 0
