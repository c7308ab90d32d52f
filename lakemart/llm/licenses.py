"""License scans by diagonal voting, with DataFrame functions only.

Every rolling k-gram of words of every text is joined, by its hash and checked
on its words, to the positions of the same k-gram in the license templates. A
hit votes for the diagonal (text position - template position). Votes are
aggregated per text, template and diagonal; neighbouring diagonals (a word added
or left out moves the rest by one) are merged into a span, and a span counts
when the template words that its hits cover are enough and dense enough. The
base phrases are templates too: one stands wherever a diagonal holds all its
k-grams, so every word of it was compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Label -> words of the base phrases.
BASE = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}

#: Label -> well-known sentences of license notices.
TEMPLATES = {
    "mit": (
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
    ),
    "apache-2": (
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
    ),
    "lgpl": ("licensed under the gnu lesser general public license",),
    "agpl": ("licensed under the gnu affero general public license",),
    "bsd": (
        "licensed under the bsd license",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
    ),
    "mpl-2": ("this source code form is subject to the terms of the mozilla public license v 2 0",),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "cc-by": ("licensed under a creative commons attribution 4 0 international license",),
    "cc-by-sa": ("licensed under a creative commons attribution sharealike 4 0 international license",),
    "cc-by-nc": ("licensed under a creative commons attribution noncommercial 4 0 international license",),
}

GRAM = 3
#: Diagonals so close together belong to one span.
DRIFT = 2
#: The share of a template's words that a span must cover; of templates under SHORT words, all (there a single
#: word tells licenses apart).
COVERAGE = 0.75
SHORT = 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def with_words(docs: DataFrame, text: str, name: str) -> DataFrame:
    """``docs`` with the words of a text column: runs of letters, digits and
    whatever is not ASCII, after lower-casing A-Z. Null and wordless texts: an
    empty array. (Two steps, so that the split is evaluated once.)"""
    low = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), _UPPER, _LOWER)
    parts = docs.withColumn(name, F.split(low, _BREAK))
    # only the first and the last part can be empty
    first = F.when(F.element_at(name, 1) == "", 1).otherwise(0)
    last = F.when((F.element_at(name, -1) == "") & (F.size(name) > 1), 1).otherwise(0)
    return parts.withColumn(name, F.slice(name, first + 1, F.size(name) - first - last))


def templates(spark, base: dict[str, str] = BASE, full: dict[str, tuple[str, ...]] = TEMPLATES, k: int = GRAM) -> DataFrame:
    """(key, gram, template, label, is_base, tpos, length) of every k-gram of every template: a fixed list."""
    rows, number = [], 0
    for is_base, lists in ((True, {a: (b,) for a, b in base.items()}), (False, full)):
        for label, phrases in lists.items():
            for phrase in phrases:
                w = phrase.split()
                if len(w) < k:
                    raise ValueError(f"a template needs {k} words: {phrase!r}")
                rows += [(" ".join(w[i:i + k]), number, label, is_base, i, len(w)) for i in range(len(w) - k + 1)]
                number += 1
    cell = lambda r: F.struct(*[F.lit(v).alias(c) for v, c in zip(r, ("gram", "template", "label", "is_base", "tpos", "length"))])
    listed = spark.range(1).select(F.inline(F.array(*map(cell, rows))))
    return listed.withColumn("key", F.xxhash64("gram"))


def hits(docs: DataFrame, listed: DataFrame, k: int = GRAM) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its key and n_words, and one row per
    k-gram that stands in a template; a row without hits stays once, with nulls."""
    w = with_words(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")), "text", "w")
    n = F.size("w")
    gram = lambda i: F.concat_ws(" ", *[F.get("w", i + j) for j in range(k)])
    # the first entry keeps texts without k-grams
    grams = w.select("doc_id", "text_key", n.cast("long").alias("n_words"), F.concat(
        F.array(F.lit(None).cast("string")),
        F.when(n >= k, F.transform(F.sequence(F.lit(0), F.greatest(n - k, F.lit(0))), gram)).otherwise(F.array().cast("array<string>"))).alias("g"))
    # outer, though never empty: else a filter on the array is pushed below and makes it twice
    each = grams.select("doc_id", "text_key", "n_words", F.posexplode_outer("g").alias("at", "gram")).withColumn("key", F.xxhash64("gram"))
    t = F.broadcast(listed.withColumnRenamed("gram", "t_gram").withColumnRenamed("key", "t_key"))  # a fixed list
    found = each.join(t, (F.col("key") == F.col("t_key")) & (F.col("gram") == F.col("t_gram")), "left")
    return found.where("template IS NOT NULL OR at = 0").select(
        "doc_id", "text_key", "n_words", (F.col("at") - 1).alias("pos"), "template", "label", "is_base", "tpos", "length")


def spans(found: DataFrame, k: int = GRAM, drift: int = DRIFT) -> DataFrame:
    """Merged diagonals: doc_id, text_key, template, label, is_base, length,
    first, last (word positions, last inclusive), covered (template words hit),
    diagonals, complete (places where a single diagonal holds every k-gram) and
    the first and last of those places."""
    votes = (found.where("template IS NOT NULL").select("doc_id", "text_key", "template", "label", "is_base", "length", "pos", "tpos").distinct()
             .withColumn("diagonal", F.col("pos") - F.col("tpos")))
    row = ["doc_id", "text_key", "template", "label", "is_base", "length"]
    by = votes.groupBy(*row, "diagonal").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.count("*").alias("n"),
                                             F.collect_list("tpos").alias("tpos"))  # at most the template's length
    order = Window.partitionBy(*row).orderBy("diagonal")
    begins = F.when(F.col("diagonal") - F.lag("diagonal").over(order) <= drift, 0).otherwise(1)
    island = F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = F.col("n") == F.col("length") - (k - 1)
    merged = (by.withColumn("begins", begins).withColumn("island", island).groupBy(*row, "island").agg(
        F.min("first").alias("first"), (F.max("last") + (k - 1)).alias("last"),
        F.array_distinct(F.flatten(F.collect_list("tpos"))).alias("tpos"),
        F.count("*").alias("diagonals"),
        F.count_if(whole).alias("complete"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_complete"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last_complete")))
    # template words under at least one hit
    under = F.array_distinct(F.flatten(F.transform("tpos", lambda p: F.sequence(p, p + (k - 1)))))
    return merged.withColumn("covered", F.size(under)).drop("tpos", "island")


def scan(docs: DataFrame, base: dict[str, str] = BASE, full: dict[str, tuple[str, ...]] = TEMPLATES, k: int = GRAM,
         drift: int = DRIFT, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score
    of every row.

    Null and empty texts: no words, no labels ('') and score 0. score: the
    largest share of a template's words that a span covers, discounted by how
    far the span is drawn out. Rows that repeat both id and text give a row
    each; other columns are ignored; an empty table gives an empty result."""
    found = staged(hits(docs.select("doc_id", "text"), templates(docs.sparkSession, base, full, k), k))
    row = ["doc_id", "text_key"]
    # how often each (id, text) stands in the table: the entries before the first k-gram
    rows = found.where(F.col("pos") == -1).groupBy(*row).agg(F.count("*").alias("copies"), F.max("n_words").alias("n_words"))
    stretch = F.col("last") - F.col("first") + 1
    like = F.when(F.col("is_base"), F.col("complete") > 0).otherwise(
        (F.col("covered") >= F.when(F.col("length") < SHORT, 1.0).otherwise(coverage) * F.col("length")) & (stretch <= 1.5 * F.col("length") + drift))
    share = F.when(F.col("is_base"), 1.0).otherwise(
        F.col("covered") / F.col("length") * F.least(F.lit(1.0), F.col("length") / stretch))
    is_base = F.col("is_base")
    told = spans(found, k, drift).where(like).groupBy(*row).agg(
        F.sum(F.when(is_base, F.col("complete")).otherwise(0)).alias("n_base"),
        F.min(F.when(is_base, F.col("first_complete"))).cast("long").alias("first_word"),
        F.max(F.when(is_base, F.col("last_complete"))).cast("long").alias("last_word"),
        F.collect_set(F.when(is_base, F.col("label"))).alias("base"), F.collect_set("label").alias("all"),
        F.max(share).alias("score"))
    joined = rows.alias("r").join(told.alias("t"), F.col("r.doc_id").eqNullSafe(F.col("t.doc_id"))
                                  & (F.col("r.text_key") == F.col("t.text_key")), "left")
    text = lambda c: F.concat_ws(",", F.array_sort(c))
    return joined.select(
        F.col("r.doc_id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        text("base").alias("base_labels"), text("all").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")
