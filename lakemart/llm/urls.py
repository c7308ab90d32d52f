"""URL filter: rules first, else words of the host and path judged by naive Bayes.

Host names run words together, so every host label is split by a unigram
Viterbi: the most probable sequence of words, with probabilities from the word
counts of all pages (texts and paths) and a price for unknown words that grows
with their length. Host words and path tokens are the features of a
multinomial naive Bayes model. Its training labels come from the pages
themselves: a page whose segmented host holds a seed word of unwanted sites is
an example to block, any other one to allow; what else goes with either is
counted over all pages.

No count is cut and none goes through the driver. Word counts are a table that
is joined to the substrings of each distinct run of letters in host names, so
Viterbi has just the words that a run can hold; token weights are a table that
is joined to the tokens of each distinct host and path, and added up as whole
numbers, so the order of adding doesn't matter.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Shared, per_text, staged

#: Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

#: Words that mark hosts of unwanted sites.
SEEDS = (
    "casino poker bet bets betting gamble gambling jackpot slots lottery pills pill viagra cialis pharma replica "
    "porn xxx adult escort dating spam phishing malware warez crack torrent ads adserver adware popup clickbait "
    "tracker track loan loans payday crypto giveaway").split()

#: The least share of all words that a seed counts as: it may be missing from clean texts.
SEED_SHARE = 1e-4
#: Letters of the longest word that a host label is split into.
LONGEST = 24
THRESHOLD = 0.5
#: Weights are added as whole numbers of this fraction.
UNIT = 1e-9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS, DIGITS, NAME = r"[\p{L}\p{Nl}\p{No}]+", r"\p{Nd}+", r"\A\p{L}"


def parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path. Host: what follows the first :// up to /, ?, # or
    the end, A-Z lower-cased; path: then up to ? or # or the end; both empty
    without ://."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = pages.withColumn("url", url).withColumn("rest", F.when(F.locate("://", "url") > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise(""))
    host = rest.withColumn("host", F.regexp_extract("rest", r"\A[^/?#]*", 0))
    path = host.withColumn("path", F.regexp_extract(F.expr("substring(rest, length(host) + 1)"), r"\A[^?#]*", 0))
    return path.withColumn("host", F.translate("host", _UPPER, _LOWER)).drop("rest")


def matched(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits host and path (as host + path), and its
    verdict; null where none fits. Of equally long rules the first counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        own = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits = own & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


class Segmenter:
    """Unigram Viterbi over runs of letters. ``total``: all words, if ``counts`` holds some of them only."""

    def __init__(self, counts: dict[str, int], total: int | None = None, longest: int = LONGEST):
        self.total = sum(counts.values()) + 1 if total is None else total
        self.log = {w: math.log(c / self.total) for w, c in counts.items()}
        self.longest = longest

    def price(self, w: str) -> float:
        p = self.log.get(w)
        # an unknown word: rarer than any counted one, ten times for each letter
        return p if p is not None else -math.log(self.total) - len(w) * math.log(10)

    def split(self, run: str) -> list[str]:
        n = len(run)
        best, back = [0.0] + [-math.inf] * n, [0] * (n + 1)
        for j in range(1, n + 1):
            for i in range(max(0, j - self.longest), j):
                p = best[i] + self.price(run[i:j])
                if p > best[j]:
                    best[j], back[j] = p, i
        out, j = [], n
        while j:
            out.append(run[back[j]:j])
            j = back[j]
        return out[::-1]


def word_counts(pages: DataFrame, seeds=SEEDS, seed_share: float = SEED_SHARE) -> tuple[DataFrame, int]:
    """Every word of all pages' texts (tags removed) and paths with its count (w,
    n), staged, and the number of all words. Not of the hosts: their names are run
    together. A seed counts as at least ``seed_share`` of the words."""
    cut = parts(pages)
    plain = F.regexp_replace(F.coalesce(F.col("html").cast("string"), F.lit("")), "<[^>]*>", " ") if "html" in pages.columns else F.lit("")
    source = F.lower(F.concat_ws(" ", plain, "path"))
    words = cut.select(F.explode(F.split(source, r"[^\p{L}]+")).alias("w")).where(F.length("w") > 0)
    counts = staged(words.groupBy("w").agg(F.count("*").alias("n")))
    total = (counts.agg(F.sum("n").alias("n")).first()["n"] or 0) + 1
    least = max(1, math.ceil(total * seed_share))
    wanted = pages.sparkSession.createDataFrame([(w, least) for w in sorted(set(seeds))], "w string, n long")
    return staged(counts.unionByName(wanted).groupBy("w").agg(F.max("n").alias("n"))), total


def _split(total: int, rows):
    return [Segmenter({f["w"]: f["n"] for f in r["found"] or ()}, total).split(r["run"]) for r in rows]


def host_words(hosts: DataFrame, counts: DataFrame, total: int, longest: int = LONGEST) -> DataFrame:
    """Staged, so that Spark knows its size: host, words (of each of the distinct
    ``hosts`` in order; digits are #).

    Each distinct run of letters meets the counts of its substrings of up to
    ``longest`` letters, then Viterbi splits it."""
    pieces = staged(hosts.select("host", F.posexplode(F.regexp_extract_all("host", F.lit(f"({LETTERS}|{DIGITS})"), 1)).alias("at", "run")))
    named = pieces.where(F.col("run").rlike(NAME)).select("run").distinct()
    begun = named.select("run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("i"))
    sized = begun.select("run", "i", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("run") - F.col("i") + 1))).alias("l"))
    known = (sized.select("run", F.expr("substring(run, i, l)").alias("w")).join(counts, "w")
             .groupBy("run").agg(F.collect_set(F.struct("w", "n")).alias("found")))
    shared = Shared(hosts.sparkSession, total)
    split = per_text(shared, _split, "array<string>", pa.list_(pa.string()))
    words = staged(named.join(known, "run", "left").select("run", split(F.struct("run", "found")).alias("words")))
    own = pieces.join(words, "run", "left").select("host", F.struct("at", F.coalesce("words", F.array(F.lit("#"))).alias("words")).alias("piece"))
    ordered = F.transform(F.sort_array(F.collect_list("piece")), lambda p: p["words"])
    return staged(own.groupBy("host").agg(F.flatten(ordered).alias("words")))


def features(cut: DataFrame, counts: DataFrame, total: int, seeds=SEEDS) -> DataFrame:
    """Staged: page_id, host, path, words (of the host), tokens (of the path), block
    (the training label). Numbers are alike: #."""
    words = host_words(cut.select("host").distinct(), counts, total)
    tokens = F.transform(F.regexp_extract_all(F.lower("path"), F.lit(f"({LETTERS}|{DIGITS})"), 1), lambda t: F.when(t.rlike(NAME), t).otherwise("#"))
    both = cut.join(words, "host", "left").withColumn("words", F.coalesce("words", F.array().cast("array<string>")))
    return staged(both.select("page_id", "host", "path", "words", tokens.alias("tokens"),
                              F.arrays_overlap("words", F.array(*[F.lit(s) for s in seeds])).alias("block")))


def _marked(tokens: str, mark: str) -> Column:
    """Tokens of hosts (h:) and of paths (p:), told apart."""
    return F.transform(tokens, lambda t: F.concat(F.lit(mark), t))


def fit(found: DataFrame) -> tuple[float, DataFrame | None]:
    """The log odds of the classes, block against allow, and a staged table
    (token, weight) with those of every token in units of UNIT; no table if the
    pages are of one class."""
    pages = {r["block"]: r["n"] for r in found.groupBy("block").agg(F.count("*").alias("n")).collect()}
    if not pages.get(True) or not pages.get(False):
        return (30.0 if pages.get(True) else -30.0), None
    by = staged(found.select("block", F.explode(F.concat(_marked("words", "h:"), _marked("tokens", "p:"))).alias("token")).groupBy("token")
                .agg(F.count_if("block").alias("b"), F.count_if(~F.col("block")).alias("a")))
    all_ = by.agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    b, a = (all_["b"] or 0) + all_["n"], (all_["a"] or 0) + all_["n"]
    weight = F.log((F.col("b") + 1) / F.lit(float(b))) - F.log((F.col("a") + 1) / F.lit(float(a)))
    return math.log(pages[True] / pages[False]), staged(by.select("token", F.round(weight / UNIT).cast("long").alias("weight")))


def _sums(found: DataFrame, weights: DataFrame, key: str, tokens: str, mark: str, name: str) -> DataFrame:
    """Staged: the summed weights of each distinct ``key`` (a host or a path)."""
    each = (found.where(F.size(tokens) > 0).select(key, tokens).distinct()
            .select(key, F.explode(_marked(tokens, mark)).alias("token")))
    return staged(each.join(weights, "token").groupBy(key).agg(F.sum("weight").alias(name)))


def filter_urls(pages: DataFrame, rules=RULES, seeds=SEEDS, seed_share: float = SEED_SHARE, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, words (of the host), score (of blocking).

    A null url, or one without ://, has an empty host and path, matches no rule
    and is allowed with score 0; so is any url without letters or digits. If every
    host holds a seed, or none does, there is nothing to learn from: all other
    pages get a score near 1, or near 0. Repeated rows give repeated results;
    other columns are ignored; an empty table gives an empty result."""
    counts, total = word_counts(pages, seeds, seed_share)
    found = features(parts(pages.select("page_id", "url")), counts, total, seeds)
    prior, weights = fit(found)
    judged = found.withColumn("sum", F.lit(0).cast("long"))
    if weights is not None:
        judged = (found.join(_sums(found, weights, "host", "words", "h:", "of_host"), "host", "left")
                  .join(_sums(found, weights, "path", "tokens", "p:", "of_path"), "path", "left")
                  .withColumn("sum", F.coalesce("of_host", F.lit(0)) + F.coalesce("of_path", F.lit(0))))
    x = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(prior) + F.col("sum") * F.lit(UNIT)))
    score = F.when(F.size("words") + F.size("tokens") == 0, 0.0).otherwise(1.0 / (1.0 + F.exp(-x)))
    rule, verdict = matched(rules)
    return judged.withColumn("score", score).select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("score") > threshold, "block").otherwise("allow")).alias("verdict"),
        F.concat_ws(" ", "words").alias("words"), "score")
