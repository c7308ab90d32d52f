from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import pytest

from lakemart.llm import divergence
from lakemart.llm.common import table
from llm_util import ODD

DOCS = "doc_id long, text string, lang string, source string, term string, n long"


def brute(rows, min_docs, top):
    """From the definitions, in Python's integers."""
    docs = [((lang or ""), (source or ""), Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))))
            for text, lang, source in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        held = Counter(t for x, _, c in docs if x == lang for t in c)
        kept = sorted(t for t, n in held.items() if n >= min_docs)
        of = defaultdict(Counter)
        for x, source, c in docs:
            if x == lang:
                of[source].update({t: n for t, n in c.items() if t in set(kept)})
        whole = sum(of.values(), Counter())
        share = lambda c: {t: 1 + 1_000_000_000 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        q, p = share(whole), {s: share(c) for s, c in of.items()}
        for s in of:
            far = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in of if o != s]
            own = [(q[t] - p[s][t], t.encode()) for t in kept if of[s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", far, None), ("term", own, top)):
                out |= {(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(sorted(found)[:limit], 1)}
    return out


@pytest.fixture(scope="module")
def rows(prose):
    out = []
    for i in range(150):
        out.append((prose(5 + i % 40, i) + (" Ünï_ß!x" if i % 3 else " x-Y 12z"), ["en", "de", None][i % 3], f"s{i % 7 if i % 2 else 0}"))
    out += [(t, "en", "odd") for t in ODD] + [("...", "en", "bare"), (None, "xx", None), ("a b", "xx", "s"), ("", "yy", "only")]
    return out + [("equal tie pair", "en", s) for s in ("ta", "tb")] * 12 + out[:1] * 40


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "clash", -1) for i, (t, lang, s) in enumerate(rows)], DOCS)


def got(df):
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("options", [{}, {"block_terms": 5, "block_sources": 2}])
def test_equals_brute_force(spark, rows, options):
    assert got(divergence.audit(frame(spark, rows).repartition(5), min_docs=4, top=10, **options)) == brute(rows, 4, 10)


def test_nothing_kept_and_empty_table(spark, rows):
    assert got(divergence.audit(frame(spark, rows), min_docs=10_000)) == brute(rows, 10_000, 50)
    assert divergence.audit(frame(spark, [])).count() == 0


def test_small_rooms_of_a_worker(spark, rows, monkeypatch):
    monkeypatch.setattr(divergence, "ROOM", 7)
    counts = divergence._count
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([x[1] or "" for x in rows]), pa.array([x[2] or "" for x in rows]),
                                        pa.array([(x[0] or "").encode() for x in rows])], names=["lang", "source", "text"])
    total = Counter()
    for out in counts([batch]):
        for r in out.to_pylist():
            total[r["lang"], r["source"], r["term"]] += r["n"]
    want = Counter()
    for text, lang, source in rows:
        for t in divergence.terms((text or "").encode()):
            want[lang or "", source or "", t.decode()] += 1
    assert {k: v for k, v in total.items() if v} == dict(want)
    assert {(x, s) for x, s, _ in total} == {(x[1] or "", x[2] or "") for x in rows}


def test_shares_are_exact_beyond_64_bits(spark):
    big = 10**12
    df = spark.createDataFrame([(big, 7 * big + 3, 1000)], "n long, total long, v long").select(divergence._p("n", "total", "v").alias("p"))
    assert df.first()["p"] == 1 + 1_000_000_000 * (big + 5) // (7 * big + 3 + 5000)


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    assert got(divergence.audit(table(spark, folder, "documents"))) == {tuple(r) for r in con.sql(divergence.ORACLE_SQL).fetchall()}
