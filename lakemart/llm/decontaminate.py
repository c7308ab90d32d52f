"""Benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over a window of words; only the words under its ones
are hashed, so a substituted word under a zero does not break the hit. The
hashes of all benchmark windows form an index; every document window is looked
up in it under every mask. Any 12, 16 or 20 words of which three quarters are equal
hold a seed of MASKS unbroken (and so does any other longer run: a part of it is
such a run); items shorter than a run get masks of their own length that leave out
every choice of words that may differ. Around each hit the benchmark item is
laid on the document's diagonal and the whole overlap is judged on the words
themselves: it is a leak if any run of enough words in it has the share of equal
ones. Told is the best ungapped run (a match counts 1, a substitution -2) if it
is such a run, else the one with the most equal words above the share.

The benchmark is processed in blocks of bounded size (a hash of the item id),
one pass over the documents each; documents are never shuffled, so a passage
that a third of them share costs no more than any other.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, fresh, per_text
from .neardup import WORD, U, Words, mix

#: Together they hit every run of MIN_WORDS or more words with MIN_IDENTITY of them equal.
MASKS = ("1011111", "11101011", "101001111", "101011011", "1100110011", "11100010101", "110110000011", "110000010111")
#: Verified overlaps: words of the run (an item's length, if shorter) and the share of equal ones.
MIN_WORDS = 12
MIN_IDENTITY = 0.75
#: Items of fewer words cannot be told from chance and never match.
MIN_ITEM = 5
BLOCK_CHARS = 8_000_000

HITS = "array<struct<item_id:bigint,start:int,end:int,words:int,equal:int,places:int>>"
HITS_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                                 ("words", pa.int32()), ("equal", pa.int32()), ("places", pa.int32())]))


def window_hashes(h: np.ndarray, mask: str) -> np.ndarray:
    """A hash of the masked words of every window."""
    n = max(0, len(h) - len(mask) + 1)
    acc = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j, bit in enumerate(mask):
            if bit == "1":
                acc += h[j:j + n] * U(0x9E3779B97F4A7C15 * (2 * j + 1) % 2**64 | 1)
        return mix(acc)


def best_run(equal: np.ndarray) -> tuple[int, int]:
    """The run [from, to) with the largest sum of 1 per match and -2 per substitution; the first of equals."""
    s = np.concatenate([[0], np.cumsum(np.where(equal, 1, -2))])
    low = np.minimum.accumulate(s)
    to = int(np.argmax(s - low))
    at = int(np.flatnonzero(s[:to + 1] == low[to])[-1]) if to else 0
    return at, to


def long_run(equal: np.ndarray, least: int, identity: float) -> tuple[int, int] | None:
    """The run [from, to) of at least ``least`` words with the most equal words
    above the share ``identity``, the first of equals; None if every run is below it."""
    if len(equal) < least:
        return None
    s = np.concatenate([[0.0], np.cumsum(equal - identity)])
    gain = s[least:] - np.minimum.accumulate(s[:len(s) - least])
    to = int(np.argmax(gain))
    if gain[to] < -1e-9:
        return None
    return int(np.argmin(s[:to + 1])), to + least


def whole_masks(n: int, identity: float) -> list[str]:
    """Masks of ``n`` words; whichever words of an item differ (as many as
    ``identity`` allows), one mask has them all under zeros."""
    differ = max(0, math.floor(n * (1 - identity) + 1e-9))
    weight = max(1, min(4 if n < 10 else 5, n - differ))
    left = set(itertools.combinations(range(n), differ))
    choices = [(ones, {z for z in left if not set(z) & set(ones)}) for ones in itertools.combinations(range(n), weight)]
    out = []
    while left:
        ones, zeros = max(choices, key=lambda c: len(c[1] & left))
        left -= zeros
        out.append("".join("1" if i in ones else "0" for i in range(n)))
    return out


class Index:
    """The seeds of a block of benchmark items (id, text)."""

    def __init__(self, value):
        items, self.masks, self.min_words, self.min_identity = value
        self.words = Words()
        h, counts = self.words.hashes([t for _, t in items])
        ends = np.cumsum(counts)
        self.ids = [i for i, _ in items]
        self.items = [h[e - c:e] for e, c in zip(ends, counts)]
        # items shorter than a run or a seed's window are looked up whole
        span = max(self.min_words, *map(len, self.masks))
        shapes: dict[str, set[int]] = {m: set() for m in self.masks}
        for k, w in enumerate(self.items):
            if len(w) >= span:
                for mask in self.masks:
                    shapes[mask].add(k)
        for n in sorted({len(w) for w in self.items if MIN_ITEM <= len(w) < span}):
            for mask in whole_masks(n, self.min_identity) if n < self.min_words else self.masks:
                shapes.setdefault(mask, set()).update(k for k, w in enumerate(self.items) if len(w) == n)
        self.tables = []
        for mask, of in shapes.items():
            found = [(window_hashes(self.items[k], mask), k) for k in sorted(of)]
            if not found:
                continue
            keys = np.concatenate([x for x, _ in found])
            item = np.concatenate([np.full(len(x), k, dtype=np.int32) for x, k in found])
            pos = np.concatenate([np.arange(len(x), dtype=np.int32) for x, _ in found])
            order = np.argsort(keys, kind="stable")
            keys, item, pos = keys[order], item[order], pos[order]
            there = np.zeros(1 << 20, dtype=bool)
            there[(keys >> U(44)).astype(np.int64)] = True
            self.tables.append((mask, keys, item, pos, there))

    def lookup(self, h: np.ndarray):
        """(window position, item, position in the item) of every hit."""
        for mask, keys, item, pos, there in self.tables:
            x = window_hashes(h, mask)
            at = np.flatnonzero(there[(x >> U(44)).astype(np.int64)])
            lo, hi = np.searchsorted(keys, x[at], "left"), np.searchsorted(keys, x[at], "right")
            n = hi - lo
            if n.any():
                i = np.repeat(at, n)
                entry = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
                yield i, item[entry], pos[entry]

    def likely(self, h: np.ndarray, seeds: np.ndarray, begins: np.ndarray, ends: np.ndarray, limit: int = 2_000_000) -> np.ndarray:
        """The seeds (text, item, diagonal) on whose whole overlap there are as many equal words as a run needs."""
        flat = np.concatenate([*self.items, np.zeros(0, np.uint64)])
        sizes = np.array([len(w) for w in self.items], dtype=np.int64)
        d, k, x = seeds.T
        lo, hi = np.maximum(0, begins[d] - x), np.minimum(sizes[k], ends[d] - x)
        n = np.maximum(0, hi - lo)
        least = np.minimum(self.min_words, sizes[k])
        need = np.ceil(self.min_identity * least - 1e-9)
        of = (np.cumsum(sizes) - sizes)[k]
        keep = np.flatnonzero(n >= least)
        same = np.zeros(len(seeds), dtype=np.int64)
        cut = np.cumsum(n[keep]) // limit
        for part in np.split(keep, np.flatnonzero(np.diff(cut)) + 1) if len(keep) else ():
            m = n[part]
            begin = np.cumsum(m) - m
            at = np.repeat(lo[part] - begin, m) + np.arange(m.sum())
            equal = h[np.repeat(x[part], m) + at] == flat[np.repeat(of[part], m) + at]
            same[part] = np.add.reduceat(equal.astype(np.int64), begin)
        return seeds[(n >= least) & (same >= need)]

    def find(self, texts: list[str | None]) -> list[list[dict]]:
        h, counts = self.words.hashes(texts)
        ends = np.cumsum(counts)
        out: list[list[dict]] = [[] for _ in texts]
        hits = list(self.lookup(h))
        if not hits:
            return out
        at = np.concatenate([x[0] for x in hits])
        item = np.concatenate([x[1] for x in hits])
        diagonal = at - np.concatenate([x[2] for x in hits])
        doc = np.searchsorted(ends, at, side="right")
        seeds = self.likely(h, np.unique(np.stack([doc, item, diagonal], 1), axis=0), ends - counts, ends)
        runs: dict[tuple[int, int], set] = {}
        for d, k, x in seeds.tolist():
            w = self.items[k]
            first, last = int(ends[d] - counts[d]), int(ends[d])
            lo, hi = max(0, first - x), min(len(w), last - x)
            if hi <= lo:  # a window across two texts
                continue
            equal = h[x + lo:x + hi] == w[lo:hi]
            a, b = best_run(equal)
            least = min(self.min_words, len(w))
            if b - a < least or int(equal[a:b].sum()) < self.min_identity * (b - a):
                a, b = long_run(equal, least, self.min_identity) or (0, 0)
            if b > a:
                same = int(equal[a:b].sum())
                runs.setdefault((d, k), set()).add((same, x + lo + a - first, b - a))
        spans: dict[int, list] = {}
        for (d, k), found in sorted(runs.items()):
            if d not in spans:
                text = texts[d]
                low = text.lower()
                spans[d] = [m.span() for m in WORD.finditer(low if len(low) == len(text) else text)]
            same, start, n = max(found, key=lambda r: (r[0], -r[2], -r[1]))
            s = spans[d]
            here = (s[start][0], s[start + n - 1][1]) if len(s) == counts[d] else (0, len(texts[d]))
            out[d].append({"item_id": self.ids[k], "start": here[0], "end": here[1], "words": n, "equal": same,
                           "places": len(found)})
        return out


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> list[list[tuple[int, str]]]:
    """The items in blocks of about ``block_chars`` characters, collected one by one."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).na.drop()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = max(1, math.ceil(chars / block_chars))
    for b in range(count):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == b).distinct().orderBy("item_id", "text").collect()
        if rows:
            yield [(r["item_id"], r["text"]) for r in rows]


def _find(index: Index, texts):
    return index.find(texts)


def leaks(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS,
          min_identity: float = MIN_IDENTITY, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document and benchmark item that overlap: doc_id, item_id,
    start, end (code points of the best run, end exclusive), words and equal
    (length of the run, matching words), places (runs on different diagonals).
    ``masks`` of at most ``min_words`` words; the fixed ones miss no run of the fixed
    ``min_words`` and ``min_identity``, nor of more words or a larger share.

    Words are runs of letters, digits and underscores in lower case. Null and
    empty texts and null item ids never match; items under five words neither. Repeated
    documents give repeated rows; repeated equal items count once. Other columns
    are ignored; an empty table on either side gives an empty result."""
    out = None
    for items in blocks(benchmark, block_chars):
        shared = Shared(docs.sparkSession, (items, masks, min_words, min_identity), Index)
        one = (docs.select("doc_id", per_text(shared, _find, HITS, HITS_ARROW)(F.col("text").cast("string")).alias("hits"))
               .select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        out = docs.select("doc_id", F.explode(F.from_json(F.lit("[]"), HITS)).alias("hit")).select("doc_id", "hit.*")
    return out


def keep_unleaked(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS,
                  min_identity: float = MIN_IDENTITY, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that overlap no benchmark item, with their columns."""
    name = fresh("_leaks", docs.columns)
    for items in blocks(benchmark, block_chars):
        shared = Shared(docs.sparkSession, (items, masks, min_words, min_identity), Index)
        found = docs.withColumn(name, per_text(shared, _find, HITS, HITS_ARROW)(F.col("text").cast("string")))
        docs = found.where(F.size(name) == 0).drop(name)
    return docs
