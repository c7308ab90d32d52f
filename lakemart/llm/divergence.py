"""Source divergence audit: how far the term distributions of a language's
sources lie apart, and by which terms a source stands out.

Terms. One ``bytes.translate`` lowers A-Z and blanks every separator of a text,
``bytes.split`` gives its terms and a Counter for each document their
frequencies. A worker adds the Counters up per (language, source), so what is
shuffled are term counts, not texts; a source with a third of all rows costs
each worker one dictionary.

Distances. p is integer arithmetic on counts. The L1 distances of all sources of
a language, which are the result, are taken in blocks: a bounded number of terms
of a bounded number of sources meets as many others as arrays in one group. A
term that no source of two blocks holds adds the same amount for each pair, and
is counted, not sent.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, staged

#: A term is kept in a language with so many documents that hold it.
MIN_DOCS = 30
SCALE, PRIOR = 1_000_000_000, 5
TOP = 50
#: Terms and sources of a block.
BLOCK_TERMS, BLOCK_SOURCES = 512, 256
#: Entries that a worker adds up before it hands them on.
ROOM = 400_000

#: Separators (all ASCII but letters) become blanks, A-Z become a-z; bytes of other characters stay.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

COUNTS = "lang string, source string, term string, docs long, n long"


def terms(text: bytes | None) -> list[bytes]:
    return text.translate(TABLE).split() if text else []


def _count(batches):
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("n", pa.int64())])
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows():
        for (lang, source), (docs, n) in held.items():
            # the group itself, even without terms, is the row of the empty term
            for at in range(0, len(n) + 1, ROOM):
                part = list(n.items())[at:at + ROOM]
                names = [t for t, _ in part] + [b""] * (at == 0)
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(names)), pa.array([source] * len(names)), pa.array(names, pa.binary()).cast(pa.string()),
                    pa.array([docs[t] for t, _ in part] + [0] * (at == 0), pa.int64()),
                    pa.array([k for _, k in part] + [0] * (at == 0), pa.int64())], schema=schema)
        held.clear()

    entries = 0
    for batch in slices(batches, lambda b: [len(x) if x else 0 for x in b.column(2).to_pylist()], 4 << 20):
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            group = held.get((lang, source))
            if group is None:
                group = held[lang, source] = (Counter(), Counter())
            found = Counter(terms(text))
            before = len(group[1])
            group[0].update(found.keys())
            group[1].update(found)
            entries += len(group[1]) - before
        if entries + len(held) > ROOM:
            yield from rows()
            entries = 0
    yield from rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, docs (documents that hold it), n (occurrences) of all
    documents; the empty term stands for the group itself. Null columns are ''."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    base = docs.select(text("lang").alias("lang"), text("source").alias("source"), text("text").cast("binary").alias("text"))
    return (base.mapInArrow(_count, COUNTS).groupBy("lang", "source", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("n")))


def _p(n: str, total: str, terms_kept: str) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * terms)), without overflow or rounding; 1 if there is nothing to divide by."""
    whole = f"{total} + {PRIOR} * {terms_kept}"
    return F.expr(f"CASE WHEN {whole} = 0 THEN 1L ELSE 1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({n} + {PRIOR} AS DECIMAL(20,0))) "
                  f"div CAST({whole} AS DECIMAL(20,0)) END")


def _distances(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Sums of |p - q| over the terms that stand in a group, for each pair of its
    sources: rows (source, term, p), a null term giving a source's p elsewhere."""
    source, term = table["source"].combine_chunks().dictionary_encode(), table["term"].combine_chunks().dictionary_encode()
    names = source.dictionary.to_pylist()
    s, p = source.indices.to_numpy(), table["p"].to_numpy()
    held = ~np.asarray(term.indices.is_null())
    elsewhere = np.zeros(len(names), dtype=np.int64)
    elsewhere[s[~held]] = p[~held]
    grid = np.repeat(elsewhere[:, None], len(term.dictionary), axis=1)
    grid[s[held], term.indices.filter(pa.array(held)).to_numpy()] = p[held]
    side = np.zeros(len(names), dtype=np.int64)
    side[s] = table["side"].to_numpy()
    low, high = key[2].as_py(), key[3].as_py()
    place = np.empty(len(names), dtype=np.int64)
    place[sorted(range(len(names)), key=names.__getitem__)] = np.arange(len(names))  # a pair has the same order in all blocks
    first, second, value = [], [], []
    for i in np.flatnonzero(side == low).tolist():
        others = np.flatnonzero((side == high) if high != low else place > place[i])
        first += [names[i]] * len(others)
        second += [names[j] for j in others.tolist()]
        value.append(np.abs(grid[others] - grid[i]).sum(axis=1))
    n = len(first)
    return pa.table({"lang": pa.array([key[0].as_py()] * n, pa.string()), "a": pa.array(first, pa.string()), "b": pa.array(second, pa.string()),
                     "value": pa.array(np.concatenate([*value, np.zeros(0, np.int64)]), pa.int64()),
                     "terms": pa.array([len(term.dictionary)] * n, pa.int64())})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, block_terms: int = BLOCK_TERMS,
          block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: for every (lang, source) group the distance to each other
    source of the language, all ranks. Part ``term``: the group's ``top`` terms
    whose share is above the language's, by the difference.

    Null text, lang and source count as ''. A group without terms has distances
    to the others and no terms; a language that keeps no term has distances 0.
    Ties go to the smaller item in UTF-8. Repeated rows count each; other columns
    are ignored; an empty table gives an empty result."""
    counts = staged(term_counts(docs))
    groups = counts.where("term = ''").select("lang", "source")
    words = counts.where("term <> ''")
    # a (language, term) has one row for each source: all of the language's in one pass
    alike = Window.partitionBy("lang", "term")
    kept = staged(words.select("*", F.sum("docs").over(alike).alias("lang_docs"), F.sum("n").over(alike).alias("lang_n"),
                               (F.min("source").over(alike) == F.col("source")).alias("first"))
                  .where(F.col("lang_docs") >= min_docs).select("lang", "source", "term", "n", "lang_n", "first"))
    # per language: kept terms, their occurrences, blocks; per group: occurrences, p of a term that it lacks
    size = (groups.groupBy("lang").agg(F.count("*").alias("sources"))
            .join(kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("lang_total")), "lang", "left")
            .select("lang", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
                    F.greatest(F.lit(1), F.ceil(F.coalesce("v", F.lit(0)) / block_terms)).cast("int").alias("term_blocks"),
                    F.ceil(F.col("sources") / block_sources).cast("int").alias("source_blocks")))
    known = staged(groups.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
                   .withColumn("total", F.coalesce("total", F.lit(0))).join(size, "lang")
                   .withColumn("side", F.pmod(F.hash("source"), F.col("source_blocks")))
                   .withColumn("elsewhere", _p("0", "total", "v")))
    rows = staged(kept.join(known, ["lang", "source"])
                  .select("lang", "source", "term", "term_blocks", "source_blocks", "side", _p("n", "total", "v").alias("p"),
                          _p("lang_n", "lang_total", "v").alias("q")))
    return _pairs(rows, known).unionByName(_terms(rows, top))


def _pairs(rows: DataFrame, known: DataFrame) -> DataFrame:
    placed = rows.select("lang", F.pmod(F.hash("term"), F.col("term_blocks")).alias("block"), "source", "side", "source_blocks", "term", "p")
    everywhere = known.select("lang", F.explode(F.sequence(F.lit(0), F.col("term_blocks") - 1)).alias("block"), "source", "side",
                              "source_blocks", F.lit(None).cast("string").alias("term"), F.col("elsewhere").alias("p"))
    other = F.explode(F.sequence(F.lit(0), F.col("source_blocks") - 1)).alias("other")
    met = (placed.unionByName(everywhere).select("*", other)
           .select("lang", "block", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), "side", "source", "term", "p"))
    near = (met.groupBy("lang", "block", "low", "high")
            .applyInArrow(_distances, "lang string, a string, b string, value long, terms long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms")))
    of = lambda c: known.select("lang", F.col("source").alias(c), F.col("elsewhere").alias("p" + c), *(["v"] if c == "a" else []))
    whole = staged(near.join(of("a"), ["lang", "a"]).join(of("b"), ["lang", "b"])
                   .select("lang", "a", "b", (F.col("value") + (F.col("v") - F.col("terms")) * F.abs(F.col("pa") - F.col("pb"))).alias("value")))
    both = whole.union(whole.select("lang", "b", "a", "value")).toDF("lang", "source", "item", "value")
    return _ranked(both, "pair")


def _terms(rows: DataFrame, top: int) -> DataFrame:
    above = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(above, "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


#: The same rows from the definitions.
ORACLE_SQL = """
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[a-z\\x{80}-\\x{10FFFF}]+') AS words FROM documents),
grp AS (SELECT DISTINCT lang, source FROM docs),
words AS (SELECT d, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
size AS (SELECT l.lang, count(k.term) AS v, coalesce(sum(k.n), 0) AS total FROM (SELECT DISTINCT lang FROM grp) l
         LEFT JOIN kept k ON k.lang = l.lang GROUP BY l.lang),
held AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT grp.lang, grp.source, coalesce(sum(n), 0) AS total FROM grp LEFT JOIN held USING (lang, source) GROUP BY ALL),
shares AS (SELECT g.lang, g.source, k.term, coalesce(h.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(h.n, 0) + 5)) // (g.total + 5 * s.v) AS p,
             1 + (1000000000::HUGEINT * (k.n + 5)) // (s.total + 5 * s.v) AS q
           FROM total g JOIN size s ON s.lang = g.lang JOIN kept k ON k.lang = g.lang
           LEFT JOIN held h ON h.lang = g.lang AND h.source = g.source AND h.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
          LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL),
told AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
         UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM told)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
