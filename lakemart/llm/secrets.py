"""Secret scans: fixed patterns, and guess costs of credential-context values.

The patterns give the base spans. Besides, every value that stands in a
credential context (a key word, an assignment sign, a value) and reaches beyond
the base spans is priced as a whole: dynamic programming finds its cheapest segmentation into
common words (plain, capitalised or with digit look-alikes) and the blanks between
them, dates and years, repeats, keyboard walks and runs of the alphabet, and brute-force spans. A value
whose cheapest reading still takes 2^``min_bits`` guesses is a secret.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, fresh, per_text
from .words import WORDS

KINDS = ("assign", "access", "hex", "guess")
#: The base patterns and their least lengths.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_KEYS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
#: Bytes to x where a hex digit stands, for a quick look before HEX.
HEX_TABLE = bytes(120 if chr(i) in "0123456789abcdef" else 46 for i in range(256))

#: A key word of credentials, a sign, and a quoted or unbroken value.
CONTEXT = re.compile(
    r"""(?i:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth(?:orization)?|bearer|credentials?)["']?"""
    r"""(?:[ \t]*(?::=|=>|[:=])[ \t]*(?:(?i:bearer|basic)[ \t]+)?|(?<=earer)[ \t]+)(?:"([^"\r\n]+)"|'([^'\r\n]+)'|([^\s"'<>,;]+))""", re.ASCII)
CONTEXT_KEYS = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential")

MIN_BITS = 36.0
MIN_LENGTH = 8

#: Common password words, most frequent first, then the words of prose.
COMMON = [*(
    "password pass admin welcome login secret test guest root user changeme default qwerty letmein master monkey dragon "
    "football baseball shadow sunshine princess iloveyou hello love money summer winter spring autumn january february "
    "march april june july august september october november december monday friday sunday super star computer internet "
    "server access token key private public system service example sample demo temp my your the and for none null true "
    "false value here name email phone home work company team manager office").split(), *WORDS]
#: The rows of a keyboard.
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = dict(zip('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./"))
LOOK_ALIKE = {"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
YEAR = re.compile(r"(?:19|20)\d\d")

_KEYS = {c: (x, y) for y, row in enumerate(ROWS) for x, c in enumerate(row)}


def beside(a: str, b: str) -> bool:
    """Whether two keys touch on the keyboard."""
    p, q = _KEYS.get(SHIFTED.get(a, a.lower())), _KEYS.get(SHIFTED.get(b, b.lower()))
    return p is not None and q is not None and p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def char_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    if c.isalpha():
        return math.log2(26) if c.isascii() else math.log2(100)
    return math.log2(33)


class Pricer:
    """Cheapest readings of values. ``words``: most frequent first."""

    def __init__(self, words=COMMON):
        self.rank = {}
        for i, w in enumerate(words, 1):
            self.rank.setdefault(w.lower(), i)
        self.begins = {w[:i] for w in self.rank for i in range(1, len(w) + 1)}

    def word(self, s: str) -> float | None:
        """Bits of a dictionary word in any case, perhaps with look-alikes."""
        low = s.lower()
        plain = "".join(LOOK_ALIKE.get(c, c) for c in low)
        rank = self.rank.get(low)
        swaps = 0
        if rank is None:
            rank = self.rank.get(plain)
            swaps = sum(a != b for a, b in zip(low, plain))
        if rank is None:
            return None
        upper = sum(c.isupper() for c in s)
        case = 0 if not upper else 1 if upper == len(s) or (upper == 1 and s[0].isupper()) else min(upper, len(s) - upper) + 1
        return math.log2(rank + 1) + case + swaps

    def pieces(self, s: str) -> list[tuple[str, int, int, float]]:
        """Every reading other than brute force: (kind, start, end, bits)."""
        n = len(s)
        out = []
        low = [c.lower() for c in s]
        plain = ["".join(LOOK_ALIKE.get(x, x) for x in c) for c in low]
        for i in range(n):
            a = b = ""  # read on while some word begins so
            for j in range(i + 1, n + 1):
                a, b = a + low[j - 1], b + plain[j - 1]
                if a not in self.begins and b not in self.begins:
                    break
                if j - i >= 3 and (a in self.rank or b in self.rank):
                    out.append(("word", i, j, self.word(s[i:j])))
            if s[i] == " ":
                out.append(("blank", i, i + 1, 1.0))
            m = DATE.match(s, i)
            if m:
                out.append(("date", i, m.end(), math.log2(365 * 120) + (2 if m[1] or m[2] else 0)))
            m = YEAR.match(s, i)
            if m:
                out.append(("date", i, m.end(), math.log2(120)))
        for unit in (1, 2, 3, 4):  # maximal runs of a repeated unit
            i = 0
            while i + 2 * unit <= n:
                j = i + unit
                while j < n and s[j] == s[j - unit]:
                    j += 1
                if j - i >= max(3, 2 * unit):
                    out.append(("repeat", i, j, sum(map(char_bits, s[i:i + unit])) + math.log2(j - i)))
                    i = j - unit + 1
                else:
                    i += 1
        for kind, follows, first, turn in (
                ("walk", beside, math.log2(47), math.log2(3)),
                ("run", lambda a, b: abs(ord(b) - ord(a)) == 1 and a.isalnum() and b.isalnum(), math.log2(36), 0.0)):
            i = 0
            while i < n - 1:  # maximal chains
                j = i + 1
                while j < n and follows(s[j - 1], s[j]):
                    j += 1
                if j - i >= 3:
                    steps = [(ord(b) - ord(a)) for a, b in zip(s[i:j], s[i + 1:j])]
                    turns = 1 + sum(x != y for x, y in zip(steps, steps[1:])) if kind == "run" else j - i - 1
                    out.append((kind, i, j, first + math.log2(j - i) + (turns * turn if kind == "walk" else turns)))
                i = max(i + 1, j - 1)
        return out

    def cheapest(self, s: str) -> tuple[float, list[tuple[str, int, int]]]:
        """Least bits, and the segmentation that has them. Each segment after the
        first costs one bit more, for the guesser's choice of its kind."""
        n = len(s)
        ending: dict[int, list] = {}
        for piece in self.pieces(s):
            ending.setdefault(piece[2], []).append(piece)
        best = [0.0] + [math.inf] * n  # whatever the last segment is
        brute = [math.inf] * (n + 1)  # the last segment is brute force
        back: list = [None] * (n + 1)
        brute_from = [0] * (n + 1)
        for j in range(1, n + 1):
            one = char_bits(s[j - 1])
            fresh_start = best[j - 1] + one + (1 if j > 1 else 0)
            longer = brute[j - 1] + one
            brute[j], brute_from[j] = (longer, brute_from[j - 1]) if longer <= fresh_start else (fresh_start, j - 1)
            best[j], back[j] = brute[j], ("brute", brute_from[j])
            for kind, i, _, bits in ending.get(j, ()):
                cost = best[i] + bits + (1 if i else 0)
                if cost < best[j]:
                    best[j], back[j] = cost, (kind, i)
        parts, j = [], n
        while j:
            kind, i = back[j]
            parts.append((kind, i, j))
            j = i
        return best[n], parts[::-1]


class Scanner:
    def __init__(self, value):
        words, self.min_bits, self.min_length = value
        self.pricer = Pricer(words)

    def base(self, text: str, low: str) -> list[tuple[int, int, int, float]]:
        """(start, kind number, end, bits) of the fixed patterns."""
        out = []
        if any(k in low for k in ASSIGN_KEYS):
            out += [(m.start(), 0, m.end(), 0.0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
        if "AKIA" in text:
            out += [(m.start(), 1, m.end(), 0.0) for m in ACCESS.finditer(text)]
        if b"x" * 24 in text.encode("latin-1", "replace").translate(HEX_TABLE):
            out += [(m.start(), 2, m.end(), 0.0) for m in HEX.finditer(text)]
        return out

    def priced(self, text: str, low: str, base: list) -> list[tuple[int, int, int, float]]:
        out = []
        if any(k in low for k in CONTEXT_KEYS):
            taken = sorted((s, e) for s, _, e, _ in base)
            reach = list(accumulate((e for _, e in taken), max))  # ascending: where the spans so far end
            for m in CONTEXT.finditer(text):
                g = m.lastindex
                start, end = m.span(g)
                while g == 3 and end > start and text[end - 1] in ".)]}:!?":  # the sentence's, not the value's
                    end -= 1
                value = text[start:end]
                if len(value) < self.min_length:
                    continue
                at, k = start, bisect_right(reach, start)
                while k < len(taken) and taken[k][0] <= at < end:  # how far the base spans cover the value
                    at, k = max(at, taken[k][1]), k + 1
                if at >= end:
                    continue
                bits, _ = self.pricer.cheapest(value)
                if bits >= self.min_bits:
                    out.append((start, 3, end, bits))
        return out

    def scan(self, text: str | None) -> list[dict]:
        if not text:
            return []
        low = text.lower()
        base = self.base(text, low)
        return [{"start": s, "end": e, "kind": KINDS[k], "bits": bits}
                for s, k, e, bits in sorted(base + self.priced(text, low, base))]


SPANS = "array<struct<start:int,end:int,kind:string,bits:double>>"
SPANS_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("bits", pa.float64())]))


def _scan(scanner: Scanner, texts):
    return [scanner.scan(t) for t in texts]


def _masked(scanner: Scanner, texts):
    """The texts with their secrets masked; None where nothing changes."""
    out = []
    for t in texts:
        spans, parts, at = scanner.scan(t), [], 0
        for s in spans:
            if s["end"] > at:
                if s["start"] >= at:
                    parts += [t[at:s["start"]], MASK]
                at = s["end"]
        out.append("".join([*parts, t[at:]]) if spans else None)
    return out


MASK = "[SECRET]"


def _shared(docs: DataFrame, words, min_bits: float, min_length: int) -> Shared:
    return Shared(docs.sparkSession, (tuple(words), min_bits, min_length), Scanner)


def scan(docs: DataFrame, words=COMMON, min_bits: float = MIN_BITS, min_length: int = MIN_LENGTH, name: str = "secrets") -> DataFrame:
    """``docs`` with an array column ``name`` of spans (start, end, kind, bits) by
    start and kind: code points, end exclusive. Null and empty texts have none;
    all other columns and repeated rows stay."""
    shared = _shared(docs, words, min_bits, min_length)
    return docs.withColumn(name, per_text(shared, _scan, SPANS, SPANS_ARROW)(F.col("text").cast("string")))


def mask(docs: DataFrame, words=COMMON, min_bits: float = MIN_BITS, min_length: int = MIN_LENGTH) -> DataFrame:
    """``docs`` with every secret replaced by a fixed mark; n_chars, if there, follows."""
    shared = _shared(docs, words, min_bits, min_length)
    name = fresh("_masked", docs.columns)
    out = docs.withColumn(name, per_text(shared, _masked, "string", pa.string())(F.col("text").cast("string")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(name).isNotNull(), F.length(name).cast(kind)).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.coalesce(name, "text")).drop(name)


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    told = "x -> concat(x.kind, ':', x.start, ':', x.end)"
    found = scan(docs.select("doc_id", "text"), **options)
    return found.select(
        "doc_id",
        *[F.expr(f"cast(size(filter(secrets, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS[:3]],
        F.expr(f"sha2(concat_ws(',', transform(filter(secrets, x -> x.kind <> 'guess'), {told})), 256)").alias("base_sha256"),
        F.expr(f"concat_ws(',', transform(secrets, {told}))").alias("spans"))
