"""Corpus pipeline: from ``documents`` to packed training sequences.

STAGES, in order; each works on all that the one before kept, written as
Parquet and read again:

* toxicity: documents whose score reaches the threshold go;
* near_duplicates: one document of each class stays;
* decontamination: documents that overlap a benchmark item go;
* secrets: secrets are masked in the text (the documents stay);
* packing: the texts' tokens as pieces of fixed-length sequences.

All but the last return the columns of ``documents``. Rows with null texts are
kept by the filters (nothing can be found in them); an empty table passes
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import decontaminate, neardup, packing, secrets, toxicity
from lakemart.llm.common import staged, table
from lakemart.llm.registry import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_representatives(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_unleaked(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces with their ids (little-endian uint32) and the ids' checksum."""
    return packing.pack(docs, tokenizer_path()).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("packing", pack),
]

#: The stages are trained, hashed or tokenised: not expressible in SQL. The
#: tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
