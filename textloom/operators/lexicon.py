"""Bilingual lexicon inversion, folded index and lookup (AGG-15/16, JOIN-05, PRJ-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.session import cut_lineage

MOST_KEYS = 500_000  # keys of an index that is sent to every task, some 50 bytes each


def invert(entries: DataFrame, order_cols: list[str]) -> DataFrame:
    """AGG-15: (eng, haw) rows → one row per headword with its translations.

    Headwords are okina-normalised; all-upper-case (and empty) headwords are
    skipped.  Translations are ordered by count desc, ties by first appearance
    (``order_cols``).  Pairs are counted first (map-side combine), so each
    headword's list holds distinct translations only.
    Output: haw, eng (", "-joined), n_eng, first (struct of order_cols).
    """
    e = (entries.withColumn("haw", T.normalize_okina(F.col("haw")))
         .filter(~T.all_upper(F.col("haw"))))
    first = F.struct(*[F.col(c) for c in order_cols])
    pairs = e.groupBy("haw", "eng").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first"))
    per_head = pairs.groupBy("haw").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), "first", "eng"))).alias("l"),
        F.min("first").alias("first"))
    return per_head.select(
        "haw", F.array_join(F.transform("l", lambda x: x["eng"]), ", ").alias("eng"),
        F.size("l").alias("n_eng"), "first")


def fold_index(inverted: DataFrame) -> DataFrame:
    """AGG-16: diacritic-folded key → its headwords in first-appearance order (case kept).

    Output: folded, entry_no, haw, eng.  The window is per folded key, whose
    size is the number of spelling variants of one word.
    """
    w = Window.partitionBy("folded").orderBy("first", "haw")
    return (inverted.withColumn("folded", T.fold_diacritics(F.col("haw")))
            .withColumn("entry_no", F.row_number().over(w))
            .select("folded", "entry_no", "haw", "eng"))


def lookup_counts(tokens: DataFrame, index: DataFrame, doc_key: str, token_col: str, most_keys: int = MOST_KEYS
                  ) -> DataFrame:
    """JOIN-05: per document, tokens, tokens with a lexicon entry, and entries found.

    Tokens are folded the same way as the index keys; the index is reduced to one row per key and stored.  Up to
    ``MOST_KEYS`` keys go to every task, and tokens are counted where they are cut.  Beyond, tokens are pre-aggregated
    per (document, key) and meet the keys in a skew-aware shuffle join.
    """
    keyed = tokens.select(doc_key, T.fold_diacritics(T.normalize_okina(F.col(token_col))).alias("folded"))
    per_key = cut_lineage(index.groupBy("folded").agg(F.count(F.lit(1)).alias("n_entries")))
    if per_key.count() <= most_keys:
        keyed, per_key = keyed.withColumn("c", F.lit(1)), F.broadcast(per_key)
    else:
        keyed = keyed.groupBy(doc_key, "folded").agg(F.count(F.lit(1)).alias("c"))
        per_key = per_key.hint("shuffle_merge")
    j = keyed.join(per_key, "folded", "left")
    return j.groupBy(doc_key).agg(
        F.sum("c").cast("bigint").alias("n_tokens"),
        F.sum(F.when(F.col("n_entries").isNotNull(), F.col("c")).otherwise(0)).cast("bigint").alias("n_matched"),
        F.sum(F.coalesce(F.col("n_entries"), F.lit(0)) * F.col("c")).cast("bigint").alias("n_entries"))
