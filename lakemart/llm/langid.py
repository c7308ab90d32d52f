"""Language identification by error-correcting output codes.

Every language gets a codeword; one binary classifier per bit, logistic over
hashed character n-grams (1 to 4 letters, words framed by blanks), predicts the
bit. A text's language is the codeword with the least loss: the logistic losses
of its bits, weighted by how well each bit's classifier does on sample rows it
was not trained on. A small gap to the second codeword flags the text as
ambiguous.

Training rows: at most ``rows_per_lang`` texts of each language (the smallest by
a hash of the id), at most ``max_sample_chars`` characters long. Their n-gram
vectors are made in Spark tasks; only those reach the driver.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, held_out, per_text
from .neardup import U, mix

NOT_LETTERS = re.compile(r"[\W\d_]+")
BUCKETS = 1 << 12
ORDERS = (1, 2, 3, 4)
UNKNOWN = "und"
AMBIGUOUS = 0.2


def code(languages: int, seed: int = 11) -> np.ndarray:
    """languages x bits of 0/1. Up to 7: the exhaustive code (every split of the
    languages once); beyond, the best of some random codes by least distance."""
    if languages < 2:
        return np.zeros((languages, 0), dtype=int)
    if languages <= 7:
        columns = [c for c in itertools.product((0, 1), repeat=languages - 1) if any(c)]
        return np.array([(0, *c) for c in columns], dtype=int).T
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(languages)))
    best, apart = None, -1
    for _ in range(200):
        c = rng.integers(0, 2, (languages, bits))
        c = c[:, (c.min(0) != c.max(0))]
        d = min(int((c[i] != c[j]).sum()) for i in range(languages) for j in range(i))
        if d > apart:
            best, apart = c, d
    return best


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Unit-length vectors of damped hashed n-gram counts, and which texts have letters."""
    clean = [NOT_LETTERS.sub(" ", t.lower()).strip() if t else "" for t in texts]
    has = np.array([bool(c) for c in clean], dtype=bool)
    framed = [f" {c} " for c in clean]
    chars = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    counts = np.array([len(f) for f in framed], dtype=np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    out = np.zeros(len(texts) * BUCKETS)
    blank = chars == 32
    with np.errstate(over="ignore"):
        acc = np.zeros(len(chars), dtype=np.uint64)
        for n in range(1, max(ORDERS) + 1):
            size = len(chars) - n + 1
            if size <= 0:
                break
            acc = acc[:size] * U(0x100000001B3) + chars[n - 1:] + U(1)
            ok = doc[:size] == doc[n - 1:]
            if n > 2:  # within a word, its frame included
                for j in range(1, n - 1):
                    ok &= ~blank[j:j + size]
            else:
                ok &= ~(blank[:size] & blank[n - 1:])
            slot = (mix(acc[ok] ^ U(n * 0x51ED)) >> U(52)).astype(np.int64)
            out += np.bincount(doc[:size][ok] * BUCKETS + slot, minlength=len(out))
    x = np.log1p(out).reshape(len(texts), BUCKETS)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    return x.astype(np.float32), has


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # BUCKETS x bits
    bias: np.ndarray
    trust: np.ndarray  # of each bit's classifier


def fit_vectors(x: np.ndarray, langs: list[str], steps: int = 150) -> Model:
    names = sorted(set(langs))
    bits = code(len(names))
    at = {n: i for i, n in enumerate(names)}
    y = bits[[at[n] for n in langs]].astype(np.float32) if langs else np.zeros((0, 0), np.float32)
    count = bits.shape[1]
    w, b = np.zeros((BUCKETS, count), np.float32), np.zeros(count, np.float32)
    trust = np.ones(count)
    if count:
        # each language weighs the same
        share = {n: langs.count(n) for n in names}
        row = np.array([1.0 / share[n] for n in langs], np.float32)

        def descend(x, y, row, steps):
            row = (row / row.sum())[:, None]
            w, b = np.zeros((BUCKETS, count), np.float32), np.zeros(count, np.float32)
            vw, vb = np.zeros_like(w), np.zeros_like(b)
            for _ in range(steps):  # Nesterov
                aw, ab = w + 0.9 * vw, b + 0.9 * vb
                g = (1.0 / (1.0 + np.exp(-np.clip(x @ aw + ab, -30, 30))) - y) * row
                vw = 0.9 * vw - 8.0 * (x.T @ g + 1e-5 * aw)
                vb = 0.9 * vb - 8.0 * g.sum(0)
                w, b = w + vw, b + vb
            return w, b

        test = np.zeros(len(langs), dtype=bool)
        for n in names:
            test[[i for i, z in enumerate(langs) if z == n][::5]] = True
        if test.any() and not test.all():
            tw, tb = descend(x[~test], y[~test], row[~test], steps // 2)
            p = 1.0 / (1.0 + np.exp(-np.clip(x[test] @ tw + tb, -30, 30)))
            error = np.clip((((p > 0.5) != (y[test] > 0.5)) * row[test][:, None]).sum(0) / row[test].sum(), 0.005, 0.49)
            trust = np.log((1 - error) / error)
        w, b = descend(x, y, row, steps)
    return Model(names, bits, w, b, trust)


def thinned(hashed: Column, n: int, rows: int) -> Column:
    """Whether a 64-bit hash is among the least, so that about ``rows`` of ``n``
    rows are, however large ``n`` is; all rows where ``n`` is no larger."""
    if n <= rows:
        return F.lit(True)
    return hashed < F.lit(rows * 2**64 // n - 2**63).cast("long")


def fit(docs: DataFrame, rows_per_lang: int = 800, max_sample_chars: int = 20_000) -> Model:
    """Fit on text and lang of rows that aren't held out. Null langs, null texts
    and texts without letters are not learned from; without rows every text is
    ``und``; with one language all texts with letters get it."""
    known = (docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
             .where(~held_out("id")).where("text IS NOT NULL AND lang IS NOT NULL").where(F.length("text") <= max_sample_chars))
    # the bound holds inside the aggregate: a language's share is thinned by a hash of the id to about twice the
    # bound, then cut; the tail of a language that holds a third of all rows never meets in one task
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return fit_vectors(np.zeros((0, BUCKETS), np.float32), [])
    keep = F.lit(False)
    for lang, n in counts.items():
        keep = keep | ((F.col("lang") == lang) & thinned(F.xxhash64("id", "text"), n, 2 * rows_per_lang))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id", "text"), "id")
    thin = known.where(keep).withColumn("k", F.row_number().over(order)).where(F.col("k") <= rows_per_lang)
    shared = Shared(docs.sparkSession, None)
    rows = thin.select("lang", per_text(shared, _packed, "binary", pa.binary())(F.col("text")).alias("x")).collect()
    rows = sorted((r["lang"], bytes(r["x"])) for r in rows if r["x"] is not None)
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, (_, v) in enumerate(rows):
        half = len(v) // 6
        x[i, np.frombuffer(v[:2 * half], np.uint16)] = np.frombuffer(v[2 * half:], np.float32)
    return fit_vectors(x, [lang for lang, _ in rows])


def _packed(_, texts):
    """Sparse vectors: indexes (uint16), then values (float32); None without letters."""
    out = []
    for i in range(0, len(texts), 256):
        x, has = grams(texts[i:i + 256])
        for v, ok in zip(x, has):
            at = np.flatnonzero(v)
            out.append(at.astype(np.uint16).tobytes() + v[at].tobytes() if ok else None)
    return out


class Decoder:
    def __init__(self, model: Model):
        self.model = model

    def predict(self, texts: list[str | None]) -> list[dict]:
        m, out = self.model, []
        for i in range(0, len(texts), 256):
            part = texts[i:i + 256]
            x, has = grams(part)
            if not m.languages:
                out += [{"lang": UNKNOWN, "score": 0.0, "second": None, "ambiguous": True} for _ in part]
                continue
            margin = x @ m.weights + m.bias
            # loss of each bit if it were 1, or 0
            one, zero = np.logaddexp(0, -margin) * m.trust, np.logaddexp(0, margin) * m.trust
            loss = (one @ m.code.T + zero @ (1 - m.code.T)) / max(1e-9, m.trust.sum())
            order = np.argsort(loss, axis=1, kind="stable")
            low = loss - loss.min(1, keepdims=True)
            p = np.exp(-8.0 * low)
            p /= p.sum(1, keepdims=True)
            for k, ok in enumerate(has.tolist()):
                if not ok:
                    out.append({"lang": UNKNOWN, "score": 0.0, "second": None, "ambiguous": True})
                    continue
                a = order[k, 0]
                second = order[k, 1] if len(m.languages) > 1 else None
                out.append({"lang": m.languages[a], "score": float(min(1.0, p[k, a])),
                            "second": None if second is None else m.languages[second],
                            "ambiguous": bool(second is not None and p[k, a] - p[k, second] < AMBIGUOUS)})
        return out


RESULT = "struct<lang:string,score:double,second:string,ambiguous:boolean>"
RESULT_ARROW = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("second", pa.string()), ("ambiguous", pa.bool_())])


def _predict(decoder: Decoder, texts):
    return decoder.predict(texts)


def identify(docs: DataFrame, model: Model, name: str = "language") -> DataFrame:
    """``docs`` with a struct column ``name``: lang, score (0 to 1), second (the
    runner-up), ambiguous. Null texts and texts without letters are ``und`` with
    score 0. Only the text is read; other columns and repeated rows stay."""
    shared = Shared(docs.sparkSession, model, Decoder)  # BUCKETS x bits: fixed by the number of languages
    return docs.withColumn(name, per_text(shared, _predict, RESULT, RESULT_ARROW)(F.col("text").cast("string")))


def predictions(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, second, ambiguous of every document."""
    found = identify(docs.select("doc_id", "text"), fit(docs, **options))
    return found.select("doc_id", held_out().alias("held_out"), F.col("language.lang").alias("lang_pred"),
                        F.col("language.score").alias("score"), F.col("language.second").alias("second"),
                        F.col("language.ambiguous").alias("ambiguous"))
