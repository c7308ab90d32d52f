"""Toxic spans and document scores by a linear-chain conditional random field.

Fitting (driver, bounded sample). The labels are per document, so the training
tokens are labelled first: a token of a toxic document is toxic when its word
or one of its stems is far more frequent in toxic than in clean sample
documents. A two-state CRF (hashed word, stem and ending features; transition
and start weights) is trained on segments of half of the sample by gradient
descent on its exact likelihood (forward-backward). A logistic model fitted on
the other half turns a document's marginals into its score.

Scoring (tasks). Every whole text is tagged with exact forward-backward
marginals. The two-state recursions are Moebius maps, so they are evaluated in
blocks: maps composed inside each block, block boundaries chained, states
filled in; texts of any length cost the same per word.

The sample is at most ``rows_per_class`` labelled documents of each class, of
at most ``max_sample_chars`` characters each, the smallest by a hash of the id:
its size doesn't grow with the corpus.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, fresh, held_out, per_text

WORD = re.compile(r"\w+")
BUCKETS = 1 << 16
SEGMENT = 32
THRESHOLD = 0.3
TAGGED = 0.5


@dataclass
class Model:
    weights: np.ndarray  # of the hashed features, toxic against clean
    bias: float
    trans: np.ndarray  # 2 x 2, log
    start: float
    doc: np.ndarray  # logistic weights of (1, max marginal, log(1 + sum), density)
    constant: float | None = None  # the score if no CRF could be fitted


def keys(word: str) -> tuple[str, ...]:
    """The word and its stems; a stem stands for all words that begin so."""
    return (word, *(word[:n] + "-" for n in (4, 5, 6) if len(word) > n))


def features(word: str) -> list[int]:
    names = [*keys(word), "+" + word[-3:]]
    return [zlib.crc32(n.encode("utf-8", "surrogatepass")) % BUCKETS for n in names]


# ---- marginals -----------------------------------------------------------------

def _scan(a, b, c, d, reset, first, block: int = 128):
    """x_t = (a_t + b_t x_{t-1}) / (c_t + d_t x_{t-1}) in order, from ``first``
    wherever ``reset`` is set (there a_t/c_t is the value itself, b = d = 0)."""
    n = len(a)
    if not n:
        return np.zeros(0)
    b, d = np.where(reset, 0.0, b), np.where(reset, 0.0, d)
    a, c = np.where(reset, first, a), np.where(reset, 1.0, c)
    rows = -(-n // block)
    pad = rows * block - n

    def grid(x, fill):
        return np.concatenate([x, np.full(pad, fill)]).reshape(rows, block).T.copy()

    a, b, c, d = grid(a, 0.0), grid(b, 1.0), grid(c, 1.0), grid(d, 0.0)
    # composed maps of each block, as (a + b x) / (c + d x)
    pa, pb, pc, pd = a[0], b[0], c[0], d[0]
    for t in range(1, block):
        na, nb = a[t] * pc + b[t] * pa, a[t] * pd + b[t] * pb
        nc, nd = c[t] * pc + d[t] * pa, c[t] * pd + d[t] * pb
        s = 1.0 / (nc + nd + na + nb)
        pa, pb, pc, pd = na * s, nb * s, nc * s, nd * s
    x, begin = 1.0, np.empty(rows)
    for i, (qa, qb, qc, qd) in enumerate(zip(pa.tolist(), pb.tolist(), pc.tolist(), pd.tolist())):
        begin[i] = x
        x = (qa + qb * x) / (qc + qd * x)
    out = np.empty((block, rows))
    x = begin
    for t in range(block):
        x = (a[t] + b[t] * x) / (c[t] + d[t] * x)
        out[t] = x
    return out.T.ravel()[:n]


def marginals(e: np.ndarray, first: np.ndarray, trans: np.ndarray, start: float) -> np.ndarray:
    """P(toxic) of each token of concatenated documents. e: log potential of
    toxic against clean; first: whether a document begins at the token."""
    if not len(e):
        return np.zeros(0)
    pot = np.exp(np.clip(e, -30, 30))
    t = np.exp(np.clip(trans, -20, 20))
    ones = np.ones(len(e))
    forward = _scan(pot * t[0, 1], pot * t[1, 1], t[0, 0] * ones, t[1, 0] * ones, first, pot * np.exp(start))
    # backward: b_t from b_{t+1}; the last token of a document begins with 1
    nxt = np.append(pot[1:], 1.0)
    last = np.append(first[1:], True)
    back = _scan((t[1, 0] * ones)[::-1], (t[1, 1] * nxt)[::-1], (t[0, 0] * ones)[::-1], (t[0, 1] * nxt)[::-1],
                 last[::-1], 1.0)[::-1]
    odds = forward * back
    return odds / (1.0 + odds)


def summary(p: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document: (1, max marginal, log(1 + sum), density); all but the first 0
    without tokens. The sum is over tagged tokens: small marginals would add up
    to something in any long text."""
    out = np.zeros((len(counts), 4))
    out[:, 0] = 1
    some = np.flatnonzero(counts)
    if len(some):
        begin = (np.cumsum(counts) - counts)[some]
        total = np.add.reduceat(np.where(p >= TAGGED, p, 0.0), begin)
        out[some, 1] = np.maximum.reduceat(p, begin)
        out[some, 2] = np.log1p(total)
        out[some, 3] = total / counts[some]
    return out


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


# ---- fitting --------------------------------------------------------------------

def copy_groups(texts: list[str], alike: float = 0.7) -> np.ndarray:
    """A group number for each sample text; texts that agree in ``alike`` of their
    signature coordinates over their shingles are one group (bands find them).
    Copies of one text must not count as so many documents that use its words;
    texts that only share a passage stay apart."""
    from .neardup import Words, bands, dart_minhash, shingles

    count, rows = 16, 5
    up = np.arange(len(texts))

    def top(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    words, seen, signed = Words(), {}, np.zeros((len(texts), count * rows), dtype=np.uint64)
    for at in range(0, len(texts), 500):
        part = texts[at:at + 500]
        h, d = shingles(words, part, 3)
        some = np.bincount(d, minlength=len(part)) > 0
        found = dart_minhash(h, d, len(part), count * rows)
        signed[at:at + len(part)] = found
        for i, keys_of in enumerate(bands(found, count, rows).tolist(), at):
            for k in keys_of if some[i - at] else ():
                held, joined = seen.setdefault(k, []), False
                for j in held:
                    x, y = top(i), top(j)
                    if x != y and (signed[i] == signed[j]).mean() >= alike:
                        up[max(x, y)] = x = y = min(x, y)
                    joined |= x == y
                if not joined:
                    held.append(i)
    return np.array([top(i) for i in range(len(texts))], dtype=int)


def token_labels(tokens: list[list[str]], toxic: np.ndarray, groups: np.ndarray, odds: float = 1.5,
                 deviations: float = 5.0) -> list[np.ndarray]:
    """1 for the tokens of toxic documents whose word or stem marks toxicity: in
    more groups of toxic documents than its rate among clean ones explains, by
    ``deviations`` standard deviations. There are many stems, so chance must be
    ruled out: it must be in 1.5 % of the groups, or the chance that so many of
    the groups that hold it are toxic must be under one in the number of stems."""
    from collections import Counter, defaultdict

    of: dict[tuple[int, int], set] = defaultdict(set)
    for words, y, g in zip(tokens, toxic, groups):
        of[int(y), int(g)].update(words)
    df, n = (Counter(), Counter()), [0, 0]
    for (y, _), words in of.items():
        df[y].update({k for w in words for k in keys(w)})
        n[y] += 1
    n1, n0 = max(1, n[1]), max(1, n[0])

    def marks_it(k: str, c: int) -> bool:
        rate = (df[0][k] + 1) / (n0 + 2)
        return (c - n1 * rate > deviations * np.sqrt(n1 * rate * (1 - rate) + 1e-9)
                and np.log((c + 0.5) / (n1 + 1)) - np.log((df[0][k] + 0.5) / (n0 + 1)) > odds)

    def by_chance(k: str, c: int) -> float:
        m, p = c + df[0][k], n1 / (n1 + n0)
        return math.fsum(math.exp(math.lgamma(m + 1) - math.lgamma(i + 1) - math.lgamma(m - i + 1) + i * math.log(p) + (m - i) * math.log1p(-p))
                         for i in range(c, m + 1))

    least = max(4, 0.015 * n1)
    marks = {k for k, c in df[1].items() if c >= 4 and marks_it(k, c) and (c >= least or by_chance(k, c) < 1 / len(df[1]))}
    return [np.array([bool(y) and any(k in marks for k in keys(w)) for w in words], dtype=bool)
            for words, y in zip(tokens, toxic)]


def fit_crf(tokens: list[list[str]], labels: list[np.ndarray], steps: int = 80, clean_share: int = 3, seed: int = 7,
            max_segments: int = 4000):
    """Gradient descent on the exact likelihood of fixed-length segments: every
    segment with a toxic token (a random ``max_segments`` of them, if there are
    more: the driver's memory), and ``clean_share`` times as many without."""
    rng = np.random.default_rng(seed)
    hot, cold = [], []
    for words, y in zip(tokens, labels):
        for i in range(0, len(words), SEGMENT):
            (hot if y[i:i + SEGMENT].any() else cold).append((words[i:i + SEGMENT], y[i:i + SEGMENT]))
    hot = [hot[i] for i in rng.permutation(len(hot))[:max_segments]]
    keep = rng.permutation(len(cold))[:clean_share * max(len(hot), 50)]
    segments = hot + [cold[i] for i in keep]
    n = len(segments)
    known: dict[str, list[int]] = {}
    width = 5
    feats = np.full((n, SEGMENT, width), BUCKETS, dtype=np.int32)  # BUCKETS: no feature
    y = np.zeros((n, SEGMENT), dtype=np.int8)
    mask = np.zeros((n, SEGMENT), dtype=bool)
    for i, (words, lab) in enumerate(segments):
        for t, w in enumerate(words):
            f = known.get(w)
            if f is None:
                f = known[w] = features(w)
            feats[i, t, :len(f)] = f
        y[i, :len(words)] = lab
        mask[i, :len(words)] = True
    params = np.zeros(BUCKETS + 1 + 1 + 4 + 1)  # features, none, bias, transitions, start
    params[BUCKETS + 1] = -2.0
    m1, m2 = np.zeros_like(params), np.zeros_like(params)
    real = mask[:, 1:]
    for step in range(1, steps + 1):
        w, bias = params[:BUCKETS + 1], params[BUCKETS + 1]
        trans, start = params[BUCKETS + 2:BUCKETS + 6].reshape(2, 2), params[-1]
        e = w[feats].sum(-1) + bias
        unary = np.stack([np.zeros_like(e), e], -1)
        unary[:, 0, 1] += start
        # log-space forward and backward over the segments at once; beyond a segment's end nothing changes
        fw, bw = np.empty((n, SEGMENT, 2)), np.zeros((n, SEGMENT, 2))
        fw[:, 0] = unary[:, 0]
        for t in range(1, SEGMENT):
            nxt = np.logaddexp(fw[:, t - 1, :1] + trans[0], fw[:, t - 1, 1:] + trans[1]) + unary[:, t]
            fw[:, t] = np.where(mask[:, t, None], nxt, fw[:, t - 1])
        for t in range(SEGMENT - 2, -1, -1):
            go = unary[:, t + 1] + bw[:, t + 1]
            nxt = np.logaddexp(trans[:, 0] + go[:, :1], trans[:, 1] + go[:, 1:])
            bw[:, t] = np.where(mask[:, t + 1, None], nxt, 0.0)
        z = np.logaddexp(fw[:, -1, 0], fw[:, -1, 1])
        p = np.exp(fw[..., 1] + bw[..., 1] - z[:, None])
        diff = np.where(mask, p - y, 0.0)
        grad = np.zeros_like(params)
        grad[:BUCKETS + 1] = np.bincount(feats.ravel(), np.repeat(diff.ravel(), width), BUCKETS + 1)
        grad[BUCKETS] = 0
        grad[BUCKETS + 1] = diff.sum()
        for a in (0, 1):
            for b in (0, 1):
                pair = np.exp(fw[:, :-1, a] + trans[a, b] + unary[:, 1:, b] + bw[:, 1:, b] - z[:, None])
                seen = (y[:, :-1] == a) & (y[:, 1:] == b)
                grad[BUCKETS + 2 + 2 * a + b] = np.where(real, pair - seen, 0.0).sum()
        grad[-1] = diff[:, 0].sum()
        grad = grad / n + 1e-4 * params * (np.arange(len(params)) < BUCKETS)
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
        params -= 0.15 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    params[BUCKETS] = 0
    return params[:BUCKETS].copy(), float(params[BUCKETS + 1]), params[BUCKETS + 2:BUCKETS + 6].reshape(2, 2).copy(), float(params[-1])


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method with a ridge; the classes keep their sample weights."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        g = x.T @ (p - y) + l2 * w
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + l2 * np.eye(x.shape[1])
        move = np.linalg.solve(h, g)
        w -= move * min(1.0, 5.0 / (np.abs(move).max() + 1e-9))
        if np.abs(move).max() < 1e-6:
            break
    return w


def fit_rows(texts: list[str], toxic: list[int], share: float | None = None, max_segments: int = 4000) -> Model:
    """``share``: of toxic rows among all labelled ones (default: in the sample),
    the score if no word tells the classes apart, neither by groups of copies nor
    by single documents."""
    y = np.array(toxic, dtype=int)
    if share is None:
        share = float(y.mean()) if len(y) else 0.0
    blank = Model(np.zeros(BUCKETS), 0.0, np.zeros((2, 2)), 0.0, np.zeros(4), share)
    if len(y) < 4 or y.min() == y.max():
        return blank
    tokens = [WORD.findall(t.lower()) for t in texts]
    groups = copy_groups(texts)
    labels = token_labels(tokens, y, groups)
    if not any(l.any() for l in labels):  # too few groups: copies are all there is to learn from
        groups = np.arange(len(y))
        labels = token_labels(tokens, y, groups, odds=4.0)  # copies make their common words frequent
    half = np.zeros(len(y), dtype=bool)  # copies on one side
    for c in (0, 1):
        half |= (y == c) & np.isin(groups, np.unique(groups[y == c])[::2])
    if len(set(y[half])) < 2 or len(set(y[~half])) < 2:
        half[:] = False
        for c in (0, 1):
            half[np.flatnonzero(y == c)[::2]] = True
    if not any(l.any() for l, h in zip(labels, half) if h):
        return blank
    fitted = fit_crf([t for t, h in zip(tokens, half) if h], [l for l, h in zip(labels, half) if h],
                     max_segments=max_segments)
    model = Model(*fitted, np.zeros(4))
    scorer = Scorer(model)
    rest = [t for t, h in zip(tokens, half) if not h]
    p, counts = scorer.tag(rest)
    model.doc = fit_logistic(summary(p, counts), y[~half])
    return model


def fit(docs: DataFrame, labels: DataFrame, rows_per_class: int = 2000, max_sample_chars: int = 20_000,
        max_segments: int = 4000) -> Model:
    """Fit on a bounded sample of the labelled rows that aren't held out. Several
    labels of one document count as toxic if one does; null ids, null labels,
    null texts and other columns are ignored. Without rows of both classes, or
    words that tell them apart, the score is a constant: the share of toxic rows
    among all labelled ones, whatever the sample's (0 without rows). At most
    ``max_segments`` segments with a toxic token train the CRF."""
    known = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).na.drop()
             .where(~held_out("id")).groupBy("id").agg(F.max("toxic").alias("toxic")))
    labelled = known.agg(F.count("*").alias("n"), F.count_if(F.col("toxic") == 1).alias("toxic")).first()
    # TakeOrdered: at most rows_per_class rows of each class, whatever the corpus
    picked = None
    for c in (0, 1):
        one = known.where(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(rows_per_class)
        picked = one if picked is None else picked.unionByName(one)
    rows = picked.collect()
    if not rows:
        return fit_rows([], [])
    spark = docs.sparkSession
    ids = F.broadcast(spark.createDataFrame([(int(r["id"]), int(r["toxic"])) for r in rows], "id long, toxic int"))
    sample = (docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
              .where(F.length("text") <= max_sample_chars).join(ids, "id").dropDuplicates(["id"]).orderBy("id").collect())
    return fit_rows([r["text"] for r in sample], [r["toxic"] for r in sample], labelled["toxic"] / labelled["n"], max_segments)


# ---- scoring ----------------------------------------------------------------------

class Scorer:
    """Tags whole texts; word potentials are kept, the store is emptied when full."""

    def __init__(self, model: Model, room: int = 300_000):
        self.model, self.room = model, room
        self.words: dict[str, float] = {}

    def potential(self, word: str) -> float:
        v = self.words[word] = float(self.model.weights[features(word)].sum() + self.model.bias)
        return v

    def tag(self, tokens: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.words) > self.room:
            self.words.clear()
        get, make = self.words.get, self.potential
        e: list[float] = []
        for words in tokens:
            e.extend([make(w) if (v := get(w)) is None else v for w in words])
        counts = np.array([len(t) for t in tokens], dtype=np.int64)
        first = np.zeros(len(e), dtype=bool)
        first[(np.cumsum(counts) - counts)[counts > 0]] = True
        return marginals(np.array(e), first, self.model.trans, self.model.start), counts

    def score(self, texts: list[str | None]):
        """Scores, and per text the toxic spans (start, end, highest marginal)."""
        m = self.model
        if m.constant is not None:
            return np.full(len(texts), m.constant), [[] for _ in texts]
        tokens = [WORD.findall(t.lower()) if t else [] for t in texts]
        p, counts = self.tag(tokens)
        scores = sigmoid(summary(p, counts) @ m.doc)
        begin = np.cumsum(counts) - counts
        spans: list[list] = [[] for _ in texts]
        hits = np.flatnonzero(p >= TAGGED)
        if len(hits):
            for i in np.unique(np.searchsorted(begin + counts, hits, side="right")).tolist():
                spans[i] = toxic_spans(texts[i], p[begin[i]:begin[i] + counts[i]])
        return scores, spans


def toxic_spans(text: str, p: np.ndarray) -> list[tuple[int, int, float]]:
    """Neighbouring tagged words joined; offsets in code points, end exclusive."""
    if len(text.lower()) != len(text):  # lower case of another length: words by the text itself
        found = [m.span() for m in WORD.finditer(text)]
        if len(found) != len(p):
            return [(0, len(text), float(p.max()))]
    else:
        found = [m.span() for m in WORD.finditer(text.lower())]
    out: list[list] = []
    before = -2
    for i in np.flatnonzero(p >= TAGGED).tolist():
        if i == before + 1:
            out[-1][1] = found[i][1]
            out[-1][2] = max(out[-1][2], float(p[i]))
        else:
            out.append([*found[i], float(p[i])])
        before = i
    return [tuple(s) for s in out]


RESULT = "struct<score:double,spans:array<struct<start:int,end:int,score:double>>>"
RESULT_ARROW = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct(
    [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))])


def _rows(scorer: Scorer, texts: list[str | None]) -> list[dict]:
    scores, spans = scorer.score(texts)
    return [{"score": s, "spans": [dict(zip(("start", "end", "score"), x)) for x in sp]}
            for s, sp in zip(scores.tolist(), spans)]


def score(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """``docs`` with a struct column ``name``: score (0 to 1) and spans (start,
    end, score). Null and empty texts score as texts without words and have no
    spans. Repeated rows score alike. All other columns are kept."""
    shared = Shared(docs.sparkSession, model, Scorer)  # 0.5 MB, fixed by BUCKETS
    return docs.withColumn(name, per_text(shared, _rows, RESULT, RESULT_ARROW)(F.col("text").cast("string")))


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """doc_id, held_out, score, predicted, spans of every document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, **options))
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxicity.score").alias("score"),
                         (F.col("toxicity.score") >= threshold).cast("int").alias("predicted"),
                         F.col("toxicity.spans").alias("spans"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """The documents whose score is below the threshold, with their columns."""
    name = fresh("_toxicity", docs.columns)
    return score(docs, fit(docs, labels, **options), name).where(F.col(f"{name}.score") < threshold).drop(name)
