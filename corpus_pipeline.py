"""A training corpus from ``documents``: language ID, exact dedup, near-dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept; ``run`` writes every
stage's result as Parquet in the shared checkpoint folder and reads it again.  All stages but the last return the
columns of ``documents``; mixing repeats rows as often as it takes them.

Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns have the results that the
operators define.  A stage keeps extra columns.  Documents that language ID rejects (no letters, or no language
clearly ahead) go; of equal texts the largest id stays; of near copies the smallest id stays; documents that mixing
takes no copy of go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import blocks, langid, mixing, neardup, packing
from textloom.llm.common import stored
from textloom.llm.queries import WORD_TOKENIZER
from textloom.session import small_batches, table

def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    known = docs.filter(~langid.is_held_out() & F.col("doc_id").isNotNull())
    model = langid.fit(known)
    return langid.keep_known(docs, model, langid.fit_limits(known, model))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return blocks.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return neardup.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.take(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs, WORD_TOKENIZER)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mixing", mixed), ("packing", packed)]

# Compression, encoding and sequential rounding have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
