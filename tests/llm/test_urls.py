from __future__ import annotations

import itertools
import math
import re
from collections import Counter

import pytest

from lakemart.llm import urls

URLS = [
    "https://www.example.com/en/1?x=1", "http://blog.example.com/en/2#top", "https://EXAMPLE.com/en/", "https://example.com/fr/1", "https://example.com",
    "https://notexample.com/en/1", "http://a.net/es/1", "http://a.net/fr/", "http://a.net/de/1", "http://net/es/x", "ftp://x.org/en/1", "no scheme", None, "",
    "://com/", "http://a.com?u=://b.net/es/", "http://Éa.com/En/", "http://a.net/es", "https://cheapcasino.example.org/de/1", "https://goodbooks.example.org/de/2",
    "http://example.com:80/en/1", "http://x.www.example.com/en/3/en",
]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def judge(host, path):
    best = None
    for verdict, h, p in urls.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, verdict)
    return best


@pytest.fixture
def pages(spark):
    text = "<p>the good books and a cheap casino win for good people with books and wine</p>"
    rows = [(i, u, text) for i, u in enumerate(URLS)] + [(100 + i, f"https://{'casino' if i % 3 == 0 else 'goodbooks'}{i}.example.org/de/{i}", text) for i in range(60)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_parts_and_rules_match_brute_force(pages):
    rows = {r["page_id"]: r for r in urls.filter_urls(pages).collect()}
    assert len(rows) == len(URLS) + 60
    for i, u in enumerate(URLS):
        r = rows[i]
        assert (r["host"], r["path"]) == parse(u)
        rule = judge(*parse(u))
        assert r["rule"] == (rule and rule[0])
        if rule:
            assert r["verdict"] == rule[1]
        assert r["verdict"] in ("allow", "block") and 0 <= r["score"] <= 1
    assert rows[18]["verdict"] == "block" and "casino" in rows[18]["words"].split()
    assert rows[19]["verdict"] == "allow" and {"good", "books"} <= set(rows[19]["words"].split())
    assert rows[12]["verdict"] == "allow" and rows[12]["score"] == 0.0


def test_viterbi_matches_enumeration():
    s = urls.Segmenter({"the": 50, "rest": 20, "therest": 1, "he": 9, "there": 12, "st": 2, "casino": 7, "win": 9})
    for run in ("therest", "casinowin", "thewin", "xwin", "hethere", "zz"):
        best = max((sum(map(s.price, cut)), cut) for cut in (
            [run[a:b] for a, b in zip((0, *m), (*m, len(run)))] for n in range(len(run)) for m in itertools.combinations(range(1, len(run)), n)))
        assert sum(map(s.price, s.split(run))) == pytest.approx(best[0])
    assert s.split("casinowin") == ["casino", "win"]


def test_no_seeds_repeated_rows_and_empty_table(spark, pages):
    plain = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (None, None)], "page_id long, url string")
    rows = urls.filter_urls(plain).collect()
    assert len(rows) == 3 and {r["verdict"] for r in rows} == {"allow"}
    assert urls.filter_urls(plain.where("false")).count() == 0
    named = pages.withColumn("host", pages["url"]).withColumn("rule", pages["url"])
    assert urls.filter_urls(named).count() == pages.count()


def test_scores_match_brute_force(pages):
    """Counts, segmentation and naive Bayes again, over collected rows."""
    rows = pages.collect()
    words = Counter(w for r in rows for w in re.split(r"[\W\d_]+", f"{re.sub('<[^>]*>', ' ', r['html'] or '')} {parse(r['url'])[1]}".lower()) if w)
    total = sum(words.values()) + 1
    least = max(1, math.ceil(total * urls.SEED_SHARE))
    s = urls.Segmenter({**words, **{w: max(least, words[w]) for w in urls.SEEDS}}, total)

    def tokens(url):
        host, path = parse(url)
        return ([f"h:{w}" for t in re.findall(r"[^\W\d_]+|\d+", host) for w in (s.split(t) if t[0].isalpha() else ["#"])]
                + [f"p:{t if t[0].isalpha() else '#'}" for t in re.findall(r"[^\W\d_]+|\d+", path.lower())])

    found = [tokens(r["url"]) for r in rows]
    block = [any(f"h:{w}" in t for w in urls.SEEDS) for t in found]
    b, a = (Counter(x for t, y in zip(found, block) if y == z for x in t) for z in (True, False))
    every = set(b) | set(a)
    weight = {x: math.log((b[x] + 1) / (b.total() + len(every))) - math.log((a[x] + 1) / (a.total() + len(every))) for x in every}
    prior = math.log(sum(block) / (len(block) - sum(block)))
    got = {r["page_id"]: r for r in urls.filter_urls(pages.repartition(5)).collect()}
    for r, t in zip(rows, found):
        score = 1 / (1 + math.exp(-max(-30, min(30, prior + sum(weight[x] for x in t))))) if t else 0.0
        mine = got[r["page_id"]]
        assert mine["words"] == " ".join(x[2:] for x in t if x[0] == "h")
        assert mine["score"] == pytest.approx(score, abs=1e-6)
        rule = judge(*parse(r["url"]))
        assert mine["verdict"] == (rule[1] if rule else "block" if score > urls.THRESHOLD else "allow")


def test_rare_words_change_no_verdict(spark, pages):
    rare = ["".join(p) for p in itertools.islice(itertools.product("bcdfghjk", "aeiou", "bcdfghjk", "aeiou", "bcdfghjk", "aeiou", "qxzv"), 200_000)]
    more = spark.createDataFrame([(None, None, " ".join(rare[i:i + 1000])) for i in range(0, len(rare), 1000)], pages.schema)

    def verdicts(df):
        return sorted((r["page_id"], r["verdict"], r["words"]) for r in urls.filter_urls(df).collect() if r["page_id"] is not None)

    assert verdicts(pages.unionByName(more)) == verdicts(pages)


def test_long_hosts_and_pages_of_one_class(spark):
    long = "casinobooks" * 300
    rows = [(1, f"http://{long}.org/a"), (2, "http://casino.org/b"), (3, "http://casino.net/es/x"), (4, None)]
    every = {r["page_id"]: r for r in urls.filter_urls(spark.createDataFrame(rows[:3], "page_id long, url string")).collect()}
    assert len(every) == 3 and all(r["score"] > 0.99 for r in every.values())
    some = {r["page_id"]: r for r in urls.filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert "casino" in some[1]["words"].split() and some[4]["verdict"] == "allow" and some[4]["score"] == 0.0
