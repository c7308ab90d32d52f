"""Near-duplicate classes by DartMinHash signatures, banded joins and exact checks.

Signature. Every word shingle throws darts: a Poisson process of ranks over
each region of its weight axis ([0,1), [1,2), [2,4), ...), seeded by the
shingle alone, so equal shingles throw equal darts in every document. A
document keeps the darts below its weight whose rank is under t / total weight,
which are about t = k ln k + 2k darts however long it is; each dart falls on
one of k coordinates and a coordinate keeps its earliest. Documents with an
empty coordinate throw again with the rank limit doubled. Two documents agree
in a coordinate with the probability of their weighted Jaccard similarity.

Weights. A shingle weighs as often as it stands in the text. The exact check
counts an element for each occurrence, so that the plain Jaccard similarity of
these is the weighted one of the shingles.

Classes. Equal texts are folded first (``md5``): a node is a text, a copied text
costs one row. Signatures are cut into bands; equal bands are buckets. First
every bucket compares its members with its most central one (the member of the
largest buckets); pairs that agree in too few coordinates are left out, the
others verified exactly on their shingles, and components are formed. A bucket's
lead is then done with there. Buckets that are still larger than a block and
hold several components compare with further leads, as long as that finds
links. Whatever members of different components then share a bucket are compared
each with each, in blocks of bounded size, inside the group: a group hands on at
most one link for each component that it joins, and no pair is ever a row. All
links, labels and shingles stay in DataFrames.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, fresh, per_text, staged

WORD = re.compile(r"\w+")
SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
#: Bits of the sieve that keeps texts out of a join.
SIEVE = 1 << 26
#: Members of a bucket that are compared each with each in one group; more are dealt out in such blocks.
BLOCK = 512
#: Characters that a worker handles at a time.
SLICE = 2_000_000

U = np.uint64
_GOLD, _M1, _M2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x + _GOLD
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


class Words:
    """64-bit hashes of words; the store is emptied when full."""

    def __init__(self, _=None, room: int = 250_000):
        self.room, self.known = room, {}

    def new(self, w: str) -> int:
        v = self.known[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return v

    def hashes(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.room:
            self.known.clear()
        get, new = self.known.get, self.new
        out: list[int] = []
        counts = np.zeros(len(texts), dtype=np.int64)
        for i, t in enumerate(texts):
            if t:
                words = WORD.findall(t.lower())
                counts[i] = len(words)
                out.extend([get(w) or new(w) for w in words])
        return np.array(out, dtype=np.uint64), counts


def shingles(words: Words, texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document number of every shingle. A text of fewer words is one
    shingle of them all; a text without words has none."""
    h, counts = words.hashes(texts)
    begin = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(texts)), counts)
    with np.errstate(over="ignore"):
        n = len(h)
        full = max(0, n - size + 1)
        acc = np.zeros(full, dtype=np.uint64)
        for j in range(size):
            acc = acc * U(0x100000001B3) + h[j:j + full] * (U(2 * j + 3) * _GOLD | U(1))
        same = doc[:full] == doc[size - 1:size - 1 + full] if n >= size else np.zeros(0, dtype=bool)
        out, of = [mix(acc[same])], [doc[:full][same]]
        for i in np.flatnonzero((counts > 0) & (counts < size)).tolist():
            part = h[begin[i]:begin[i] + counts[i]]
            out.append(mix(np.array([int.from_bytes(hashlib.blake2b(part.tobytes(), digest_size=8).digest(), "little")], dtype=np.uint64)))
            of.append(np.array([i]))
    hashes, docs = np.concatenate(out), np.concatenate(of)
    order = np.argsort(docs, kind="stable")
    return hashes[order], docs[order]


def dart_minhash(hashes: np.ndarray, docs: np.ndarray, n: int, k: int, weights: np.ndarray | None = None) -> np.ndarray:
    """The n x k signatures of weighted sets given as (element hash, document,
    weight); rows of documents without elements are 0. An element may repeat
    with weight 1: it throws the same darts again."""
    w = np.ones(len(hashes)) if weights is None else np.asarray(weights, dtype=float)
    total = np.bincount(docs, w, n)
    some = total > 0
    limit = np.zeros(n)
    limit[some] = (k * math.log(k) + 2 * k) / total[some]
    best = np.full(n * k, np.inf)
    sig = np.zeros(n * k, dtype=np.uint64)
    todo = some.copy()
    with np.errstate(over="ignore"):
        while todo.any():
            mine = todo[docs]
            eh, ed, ew = hashes[mine], docs[mine], w[mine]
            region, low, high = 0, 0.0, 1.0
            while len(eh):
                seed, rank = mix(eh ^ (U(region) * _M2)), np.zeros(len(eh))
                of, wide, weight = ed, high - low, ew
                i = 0
                while len(seed):
                    r = mix(seed + U(i) * _M1)
                    rank = rank - np.log(((r >> U(11)).astype(float) + 1.0) * 2.0**-53) / wide
                    alive = rank < limit[of]
                    seed, rank, of, weight, r = seed[alive], rank[alive], of[alive], weight[alive], r[alive]
                    dart = mix(r ^ _GOLD)
                    put = slice(None)
                    if weights is not None:  # the dart's place on the weight axis
                        put = low + wide * (mix(dart) >> U(11)).astype(float) * 2.0**-53 < weight
                    at = of[put] * k + ((dart[put] >> U(33)) % U(k)).astype(np.int64)
                    np.minimum.at(best, at, rank[put])
                    first = best[at] == rank[put]
                    sig[at[first]] = dart[put][first]
                    i += 1
                more = ew > high
                eh, ed, ew = eh[more], ed[more], ew[more]
                region, low, high = region + 1, high, high * 2
            todo = some & np.isinf(best.reshape(n, k)).any(axis=1)
            limit[todo] *= 2
    return sig.reshape(n, k)


def bands(sig: np.ndarray, count: int, rows: int) -> np.ndarray:
    """The n x count keys of the bands, different in every band."""
    n = len(sig)
    part = sig[:, :count * rows].reshape(n, count, rows)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(mix(np.arange(count, dtype=np.uint64)), (n, count)).copy()
        for j in range(rows):
            key = mix(key ^ part[:, :, j])
    return key.view(np.int64)


SIGNED = "struct<bands:array<bigint>,short:array<tinyint>>"
SIGNED_ARROW = pa.struct([("bands", pa.list_(pa.int64())), ("short", pa.list_(pa.int8()))])


def counted(hashes: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (shingle, document) with their number of occurrences, by document."""
    if not len(hashes):
        return hashes, docs, np.zeros(0, dtype=np.int64)
    order = np.lexsort((hashes, docs))
    h, d = hashes[order], docs[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])]))
    return h[first], d[first], np.diff(np.append(first, len(h)))


def elements(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One element for each occurrence of a shingle: itself, and others made from it for the second and later ones."""
    of = np.repeat(hashes, counts)
    turn = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    with np.errstate(over="ignore"):
        return np.where(turn == 0, of, mix(of + turn.astype(np.uint64) * _M2))


def _band_rows(size: int, count: int, rows: int):
    def run(words: Words, texts):
        h, d, n = counted(*shingles(words, texts, size))
        sig = dart_minhash(h, d, len(texts), count * rows, n.astype(float))
        keys, short = bands(sig, count, rows), (sig & U(255)).astype(np.uint8).view(np.int8)
        has = np.bincount(d, minlength=len(texts)) > 0
        ends = np.concatenate([[0], np.cumsum(np.where(has, count, 0))]).astype(np.int32)
        fixed = (np.arange(len(texts) + 1) * count * rows).astype(np.int32)
        return pa.StructArray.from_arrays([
            pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[has].ravel())),
            pa.ListArray.from_arrays(pa.array(fixed), pa.array(short.ravel()))], fields=list(SIGNED_ARROW))

    return run


def _shingle_rows(size: int):
    """The elements of each text, sorted."""
    def run(words: Words, texts):
        h, d, n = counted(*shingles(words, texts, size))
        flat = elements(h, n).view(np.int64)
        of = np.repeat(d, n)
        flat = flat[np.lexsort((flat, of))]
        at = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(texts)))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(flat))

    return run


# ---- components ---------------------------------------------------------------------

def merge(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, comp) after joining the components of each edge (a, b):
    minimum labels over the contracted graph, with pointer jumping; every round
    is a few joins on staged tables, so a hot component is split by the skew join."""
    of = lambda c: labels.select(F.col("node").alias(c), F.col("comp").alias(c + "_comp"))
    pairs = (edges.join(of("a"), "a").join(of("b"), "b").where("a_comp <> b_comp")
             .select(F.col("a_comp").alias("s"), F.col("b_comp").alias("d")))
    both = staged(pairs.union(pairs.select("d", "s")).distinct())
    if both.isEmpty():
        return labels
    now = staged(both.select(F.col("s").alias("v")).distinct().withColumn("l", F.col("v")))
    while True:
        told = both.join(now, F.col("s") == F.col("v")).groupBy("d").agg(F.min("l").alias("m"))
        step = staged(now.join(told, F.col("v") == F.col("d"), "left")
                      .select("v", "l", F.least("l", "m").alias("n")))
        jump = step.select(F.col("v").alias("p"), F.col("n").alias("pn"))
        after = staged(step.join(jump, F.col("n") == F.col("p")).select("v", "l", F.least("n", "pn").alias("n")))
        done = after.where("n <> l").isEmpty()
        now = after.select("v", F.col("n").alias("l"))
        if done:
            break
    return staged(labels.join(now, F.col("comp") == F.col("v"), "left")
                  .select("node", F.coalesce("l", "comp").alias("comp")))


# ---- classes ----------------------------------------------------------------------

def _verified(pairs: DataFrame, known: DataFrame, similarity: float, least: int) -> DataFrame:
    """The distinct pairs (a, b) whose texts are similar enough: those that agree in
    ``least`` coordinates (a few bytes move for that), counted exactly (only then
    do the elements move)."""
    short = lambda c: known.select(F.col("node").alias(c), F.col("short").alias(c + "_short"))
    whole = lambda c: known.select(F.col("node").alias(c), F.col("set").alias(c + "_set"))
    agree = F.size(F.filter(F.zip_with("a_short", "b_short", lambda x, y: x == y), lambda same: same))
    likely = staged(_ordered(pairs).join(short("a"), "a").join(short("b"), "b").where(agree >= least).select("a", "b"))
    found = likely.join(whole("a"), "a").join(whole("b"), "b").withColumn("common", F.size(F.array_intersect("a_set", "b_set")))
    return staged(found.where(F.col("common") >= similarity * (F.size("a_set") + F.size("b_set") - F.col("common")) - 1e-9)
                  .select("a", "b"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _leads(members: DataFrame) -> DataFrame:
    """Each bucket's most central member: bucket, lead, lead_comp."""
    best = F.max(F.struct("weight", (-F.col("node")).alias("n"), "comp")).alias("m")
    return staged(members.groupBy("bucket").agg(best)
                  .select("bucket", (-F.col("m.n")).alias("lead"), F.col("m.comp").alias("lead_comp")))


def _open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (bucket, node, comp, n, weight) of the buckets that hold several components; n: members."""
    now = staged(members.select("bucket", "node", "weight").join(labels, "node"))
    several = staged(now.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"))
                     .where("lo < hi").select("bucket", "n"))
    return staged(now.join(several, "bucket").select("bucket", "node", "comp", "n", "weight"))


def _links(similarity: float, least: int):
    """Compares the members of a group each with each (of two blocks: those of
    one with those of the other) and gives links that join all components that
    any links join: at most one less than there are components."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        node, comp, side = (table[c].to_numpy() for c in ("node", "comp", "side"))
        short = table["short"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        sets = table["set"].combine_chunks()
        sets = sets if isinstance(sets, pa.ListArray) else pa.concat_arrays(sets.chunks)
        values, at = sets.flatten().to_numpy(), np.concatenate([[0], np.cumsum(np.diff(sets.offsets.to_numpy()))])
        size = np.diff(at)
        up = {c: c for c in comp.tolist()}

        def top(c):
            while up[c] != c:
                up[c] = c = up[up[c]]
            return c

        low, high = key[1].as_py(), key[2].as_py()
        a, b = [], []
        for i in np.flatnonzero(side == low).tolist():
            others = np.flatnonzero((side == high) & (comp != comp[i])) if high != low else i + 1 + np.flatnonzero(comp[i + 1:] != comp[i])
            if not len(others):
                continue
            near = np.minimum(size[others], size[i]) >= similarity * np.maximum(size[others], size[i]) - 1e-9
            others = others[near]
            others = others[(short[others] == short[i]).sum(axis=1) >= least]
            mine = values[at[i]:at[i + 1]]
            for j in others.tolist():
                x, y = top(comp[i]), top(comp[j])
                if x == y:
                    continue
                common = len(np.intersect1d(mine, values[at[j]:at[j + 1]], assume_unique=True))
                if common >= similarity * (size[i] + size[j] - common) - 1e-9:
                    up[max(x, y)] = min(x, y)
                    a.append(node[i])
                    b.append(node[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _settled(members: DataFrame, known: DataFrame, similarity: float, least: int, block: int) -> DataFrame:
    """Links between all members of a bucket in different components, exactly."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    dealt = (members.join(known.select("node", "short", "set"), "node").withColumn("side", F.pmod(F.hash("node"), blocks))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("bucket", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "node", "comp", "side", "short", "set"))
    return staged(dealt.groupBy("bucket", "low", "high").applyInArrow(_links(similarity, least), "a long, b long").distinct())


def _sieved(base: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose doc_id may be wanted, by a bit for each hash value: what is
    broadcast has a fixed size (SIEVE bits); the join that follows decides."""
    at = lambda df: df.select(F.pmod(F.xxhash64("doc_id"), F.lit(SIEVE)).alias("h"))
    ranges = (at(wanted).groupBy(F.expr("h div 32768").alias("r"))
              .agg(F.bitmap_construct_agg(F.col("h") % 32768).alias("bits")).collect())  # 4 kB each, SIEVE / 32768 at most
    bits = np.zeros(SIEVE // 8, dtype=np.uint8)
    for r in ranges:
        bits[r["r"] * 4096:(r["r"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    shared = Shared(base.sparkSession, bits)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        mine = shared.get()
        for column in columns:
            h = column.to_numpy(zero_copy_only=False)
            yield pa.array((mine[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1)

    may = F.arrow_udf(run, "boolean")(F.pmod(F.xxhash64("doc_id"), F.lit(SIEVE)))
    return base.where(may)


def _labelled(docs: DataFrame, similarity: float, shingle: int, band_count: int, band_rows: int, block: int) -> tuple[DataFrame, DataFrame]:
    """(all rows: doc_id, key), (texts: key, comp, least doc_id of the text); comp numbers the classes."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = Shared(docs.sparkSession, None, Words)
    key = F.unhex(F.md5(F.col("text").cast("binary")))
    signed = staged(base.select("doc_id", key.alias("key"),
                                per_text(shared, _band_rows(shingle, band_count, band_rows), SIGNED, SIGNED_ARROW, SLICE)(F.col("text")).alias("s"))
                    .select("doc_id", "key", "s.*"))
    # one row per distinct text; the signatures of equal texts are equal
    distinct = staged(signed.where("doc_id IS NOT NULL AND key IS NOT NULL").groupBy("key")
                      .agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"), F.first("short").alias("short"))
                      .withColumn("node", F.monotonically_increasing_id()))
    keys = distinct.select("node", F.explode("bands").alias("bucket"))
    shared_keys = staged(keys.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    keys = staged(keys.join(shared_keys, "bucket").select("bucket", "node", "n"))
    # near copies share many buckets: of those with the same members one is enough
    of = lambda salt: F.bit_xor(F.xxhash64("node", F.lit(salt)))
    alike = (keys.groupBy("bucket").agg(F.count("*").alias("n"), of(1).alias("x"), of(2).alias("y"))
             .groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket"), F.count("*").alias("alike")).select("bucket", "alike"))
    # a node stands in ``band_count`` buckets at most
    weight = F.sum(F.col("n") * F.col("alike")).over(Window.partitionBy("node")).alias("weight")
    keys = staged(keys.join(alike, "bucket").select("bucket", "node", "n", weight))
    nodes = staged(keys.select("node").distinct())
    labels = nodes.select("node", F.col("node").alias("comp"))
    if not nodes.isEmpty():
        # each text from one row: partitioned by what makes that row unique, so that repeats go without another exchange
        wanted = distinct.join(nodes, "node", "left_semi").select("node", F.col("least").alias("doc_id"), "key", "short")
        texts = _sieved(base, wanted).withColumn("key", key).join(wanted, ["doc_id", "key"]).dropDuplicates(["doc_id", "key"])
        known = staged(texts.select("node", "short", per_text(shared, _shingle_rows(shingle), "array<bigint>", pa.list_(pa.int64()), SLICE)(F.col("text")).alias("set")))
        # four standard deviations below the similarity
        coordinates = band_count * band_rows
        least = math.floor(similarity * coordinates - 4 * math.sqrt(similarity * (1 - similarity) * coordinates))
        members, rest, before = keys.select("bucket", "node", F.col("node").alias("comp"), "n", "weight"), None, None
        while True:  # stars: every round has the links of one more lead in each open bucket
            lead = _leads(members)
            met = staged(members.join(lead, "bucket").where("node <> lead"))
            links = _verified(met.where("comp <> lead_comp").select(F.col("node").alias("a"), F.col("lead").alias("b")), known, similarity, least)
            labels = merge(labels, links)
            left = _open(met, labels)
            members, small = left.where(F.col("n") > block), left.where(F.col("n") <= block)
            rest = small if rest is None else rest.unionByName(small)
            now = members.count()
            if not now or (before is not None and now > 0.75 * before):  # stars no longer close buckets
                break
            before = now
        members = _open(rest.unionByName(members), labels)
        labels = merge(labels, _settled(members, known, similarity, least, block))
    texts = distinct.join(labels, "node", "left").select("key", "least", F.coalesce("comp", "node").alias("comp"))
    return signed.select("doc_id", "key"), staged(texts)


def classes(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, band_count: int = BANDS,
            band_rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class), representative: one row
    per row of ``docs``.

    A class is a component of the texts linked by a weighted Jaccard similarity
    of their word shingles (weight: occurrences) of at least ``similarity``. Words
    are runs of letters, digits and underscores in lower case. Texts of fewer
    words than a shingle count as one shingle. Texts without words only equal
    copies; a null text is a class of its own. Rows that repeat an id with the same
    text get the same class; with different texts each row gets the class of its
    text (so two classes can have the same least id; their representatives are
    different rows). A null id takes no part and gets class null. Other columns
    are ignored, an empty table gives an empty result."""
    rows, texts = _labelled(docs, similarity, shingle, band_count, band_rows, block)
    ids = texts.groupBy("comp").agg(F.min(F.struct("least", "key")).alias("r"))
    named = staged(texts.join(ids, "comp").select("key", F.col("r.least").alias("class_id"), (F.col("r.key") == F.col("key")).alias("leads")))
    found = rows.join(named, "key", "left")
    class_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id"))
    return found.select("doc_id", class_id.alias("class_id"),
                        ((F.col("doc_id") == class_id) & F.coalesce("leads", F.lit(True))).alias("representative"))


def keep_representatives(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE, band_count: int = BANDS,
                         band_rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """One row of each class (its least doc_id and the text that goes with it; of
    equal such rows the one whose columns come first), with its columns. Rows
    without an id or text stay."""
    _, texts = _labelled(docs, similarity, shingle, band_count, band_rows, block)
    kept = staged(texts.groupBy("comp").agg(F.min(F.struct("least", "key")).alias("r")).select(F.col("r.least").alias("_least"), F.col("r.key").alias("_of")))
    key, number = fresh("_key", docs.columns), fresh("_number", docs.columns)
    known = docs.withColumn(key, F.unhex(F.md5(F.col("text").cast("string").cast("binary"))))
    apart = F.col("doc_id").isNull() | F.col(key).isNull()
    same = known.where(~apart).join(kept, (F.col("doc_id").cast("long") == F.col("_least")) & (F.col(key) == F.col("_of")), "left_semi")
    simple = [F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    order = Window.partitionBy("doc_id", key).orderBy(*simple)
    one = same.withColumn(number, F.row_number().over(order)).where(F.col(number) == 1).drop(number)
    return one.unionByName(known.where(apart)).drop(key)
