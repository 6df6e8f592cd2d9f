"""Lexicon queries (SRC-09, PRJ-15, AGG-15/16, JOIN-05)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import lexicon as L
from textloom.plans import fixtures as FX
from textloom.plans.registry import query
from textloom.plans.sqlparts import toks, with_ctes
from textloom.session import Tables, spread


def _inverted(spark, sf_dir):
    return L.invert(FX.lexicon_entries(Tables(spark, sf_dir).documents), ["doc_id", "line_no", "pos"])


@query("lexicon_invert", with_ctes("SELECT haw, eng, n_eng FROM lex_inv", "lex_inv"))
def lexicon_invert(spark, sf_dir):
    """AGG-15 + PRJ-15: headword → translations by count, ties by first appearance."""
    return _inverted(spark, sf_dir).select("haw", "eng", F.col("n_eng").cast("bigint"))


@query("lexicon_fold_index", with_ctes(f"""
SELECT translate(haw, '{T.FOLD_FROM}', '{T.FOLD_TO}') AS folded,
       row_number() OVER (PARTITION BY translate(haw, '{T.FOLD_FROM}', '{T.FOLD_TO}') ORDER BY first, haw)::BIGINT
         AS entry_no, haw, eng
FROM lex_inv""", "lex_inv"))
def lexicon_fold_index(spark, sf_dir):
    """AGG-16 + STR-02: folded key → headword variants in first-appearance order."""
    return L.fold_index(_inverted(spark, sf_dir)).withColumn("entry_no", F.col("entry_no").cast("bigint"))


@query("lexicon_lookup", with_ctes(f"""
WITH idx AS (SELECT translate(haw, '{T.FOLD_FROM}', '{T.FOLD_TO}') AS folded, count(*) AS n_entries
             FROM lex_inv GROUP BY 1),
tk AS (SELECT doc_id, translate(translate(unnest({toks('text', 'pretok')}), '{T.LEFT_QUOTE}', '{T.OKINA}'),
              '{T.FOLD_FROM}', '{T.FOLD_TO}') AS folded FROM acc_docs)
SELECT doc_id, count(*)::BIGINT AS n_tokens, count(idx.folded)::BIGINT AS n_matched,
       coalesce(sum(n_entries), 0)::BIGINT AS n_entries
FROM tk LEFT JOIN idx USING (folded) GROUP BY doc_id""", "lex_inv", "acc_docs"))
def lexicon_lookup(spark, sf_dir):
    """JOIN-05: pre-tokenised document words looked up by folded key."""
    docs = spread(Tables(spark, sf_dir).documents.select("doc_id", "text"), "doc_id")
    index = L.fold_index(L.invert(FX.lexicon_entries(docs), ["doc_id", "line_no", "pos"]))
    tokens = FX.accented_docs(docs).select("doc_id", F.explode(T.tokens(F.col("text"), "pretok")).alias("tok"))
    return L.lookup_counts(tokens, index, "doc_id", "tok")
