"""Profiling queries (AGG-01..14, WIN-07, SRT-03, SET-01/02)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import profile as P
from textloom.operators import sampling as S
from textloom.plans import fixtures as FX
from textloom.plans.registry import query
from textloom.plans.sqlparts import lit, toks, with_ctes
from textloom.plans.text_queries import HOST_RE
from textloom.session import Tables

SEED = 42


def doc_splits(spark, sf_dir):
    """SMP-04 split of documents, reused to give the synthetic corpus its splits."""
    docs = Tables(spark, sf_dir).documents.select("doc_id")
    return S.three_way_split(docs, ["doc_id"], (0.8, 0.1, 0.1), SEED)


def split_sentences_table(spark, sf_dir):
    """C.1 sentences with their split: (doc_id, line_no, sent_no, split, n_tokens)."""
    toks_ = FX.tagged_tokens(Tables(spark, sf_dir).documents)
    sents = toks_.groupBy("doc_id", "line_no", "sent_no").agg(F.count(F.lit(1)).alias("n_tokens"))
    return sents.join(doc_splits(spark, sf_dir), "doc_id")


@query("tag_distribution", with_ctes("""
SELECT upos, count(*)::BIGINT AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS pct
FROM tagged GROUP BY upos""", "tagged"))
def tag_distribution(spark, sf_dir):
    """AGG-01 + WIN-07: tokens per tag and percent of all tokens."""
    counts = FX.tagged_tokens(Tables(spark, sf_dir).documents).groupBy("upos").agg(
        F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", P.share_of_total(counts, "n", 2))


@query("split_summary", with_ctes("""
WITH s AS (SELECT t.doc_id, line_no, sent_no, split, count(*) AS n_tokens
           FROM tagged t JOIN doc_split d USING (doc_id) GROUP BY t.doc_id, line_no, sent_no, split)
SELECT split, count(*)::BIGINT AS n_sentences, sum(n_tokens)::BIGINT AS n_tokens,
       round(avg(n_tokens), 1) AS avg_len, max(n_tokens)::BIGINT AS max_len,
       round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS share_pct
FROM s GROUP BY split""", "tagged", "doc_split"))
def split_summary(spark, sf_dir):
    """AGG-02 + AGG-03: sentences, tokens, mean/max length and share per split."""
    s = split_sentences_table(spark, sf_dir)
    agg = s.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_sentences"), F.sum("n_tokens").cast("bigint").alias("n_tokens"),
        F.round(F.avg("n_tokens"), 1).alias("avg_len"), F.max("n_tokens").cast("bigint").alias("max_len"))
    return agg.withColumn("share_pct", P.share_of_total(agg, "n_sentences", 2))


@query("head_per_split", with_ctes("""
SELECT doc_id, line_no, sent_no, split, n_tokens FROM (
  SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id, line_no, sent_no) AS r FROM (
    SELECT t.doc_id, line_no, sent_no, split, count(*)::BIGINT AS n_tokens
    FROM tagged t JOIN doc_split d USING (doc_id) GROUP BY t.doc_id, line_no, sent_no, split))
WHERE r <= 5""", "tagged", "doc_split"))
def head_per_split(spark, sf_dir):
    """SRT-03: first five sentences of every split (window group limit, partial top-k)."""
    s = split_sentences_table(spark, sf_dir)
    w = Window.partitionBy("split").orderBy("doc_id", "line_no", "sent_no")
    return s.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= 5).drop("_r")


def _tags_by_split(spark, sf_dir):
    # Splits meet a document's counts, not its tokens.
    counts = FX.tagged_tokens(Tables(spark, sf_dir).documents).groupBy("doc_id", "upos").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(doc_splits(spark, sf_dir), "doc_id").groupBy("split", "upos").agg(F.sum("n").alias("n"))


@query("label_union", with_ctes("""
SELECT DISTINCT upos FROM tagged t JOIN doc_split d USING (doc_id)""", "tagged", "doc_split"))
def label_union(spark, sf_dir):
    """SET-01: union of the tag sets of all splits."""
    return _tags_by_split(spark, sf_dir).select("upos").distinct()


@query("unseen_labels", with_ctes("""
WITH t AS (SELECT t.upos, split FROM tagged t JOIN doc_split d USING (doc_id))
SELECT upos, count(*)::BIGINT AS n, upos IN (SELECT upos FROM t WHERE split = 'train') AS in_train
FROM t WHERE split = 'validation' GROUP BY upos""", "tagged", "doc_split"))
def unseen_labels(spark, sf_dir):
    """SET-02: validation tags with a flag for presence in train (one pass over tag counts per split)."""
    n = lambda split: F.sum(F.when(F.col("split") == split, F.col("n")).otherwise(0))
    return _tags_by_split(spark, sf_dir).groupBy("upos").agg(n("validation").alias("n"),
                                                            (n("train") > 0).alias("in_train")).filter("n > 0")


@query("value_counts_top", """
SELECT 'language' AS column_name, lang AS value, count(*)::BIGINT AS n FROM documents GROUP BY lang
UNION ALL
SELECT 'author', source, n FROM (
  SELECT source, count(*)::BIGINT AS n FROM documents GROUP BY source ORDER BY n DESC, source LIMIT 10)""")
def value_counts_top(spark, sf_dir):
    """AGG-05: language counts, and the ten most frequent authors (ties by name)."""
    docs = Tables(spark, sf_dir).documents
    lang = P.value_counts(docs, "lang").select(
        F.lit("language").alias("column_name"), F.col("lang").alias("value"), "n")
    auth = P.value_counts(docs, "source", top=10).select(
        F.lit("author").alias("column_name"), F.col("source").alias("value"), "n")
    return lang.unionByName(auth)


@query("distinct_counts", """
SELECT column_name, n_distinct, n_distinct < 20 AS is_categorical FROM (
  SELECT 'doc_id' AS column_name, count(DISTINCT doc_id)::BIGINT AS n_distinct FROM documents UNION ALL
  SELECT 'text', count(DISTINCT text)::BIGINT FROM documents UNION ALL
  SELECT 'lang', count(DISTINCT lang)::BIGINT FROM documents UNION ALL
  SELECT 'source', count(DISTINCT source)::BIGINT FROM documents UNION ALL
  SELECT 'n_chars', count(DISTINCT n_chars)::BIGINT FROM documents)""")
def distinct_counts(spark, sf_dir):
    """AGG-06: exact distinct count per column; categorical when fewer than 20 values."""
    return P.distinct_counts(Tables(spark, sf_dir).documents, 20)


@query("describe_numeric", """
SELECT lang, count(n_chars)::BIGINT AS count, avg(n_chars) AS mean, stddev_samp(n_chars) AS std,
       min(n_chars)::DOUBLE AS min, quantile_cont(n_chars, 0.25) AS p25, quantile_cont(n_chars, 0.5) AS p50,
       quantile_cont(n_chars, 0.75) AS p75, max(n_chars)::DOUBLE AS max
FROM documents GROUP BY lang""")
def describe_numeric(spark, sf_dir):
    """AGG-07: describe() of n_chars per language with exact interpolated quartiles."""
    return P.describe(Tables(spark, sf_dir).documents, "n_chars", "lang")


@query("five_number_by_lang", """
SELECT lang, min(n_chars)::DOUBLE AS min, quantile_cont(n_chars, 0.25) AS q1,
       quantile_cont(n_chars, 0.5) AS median, quantile_cont(n_chars, 0.75) AS q3, max(n_chars)::DOUBLE AS max
FROM documents GROUP BY lang""")
def five_number_by_lang(spark, sf_dir):
    """AGG-13: box-plot inputs per language."""
    return P.five_number(Tables(spark, sf_dir).documents, "n_chars", "lang")


@query("histogram_chars", """
WITH m AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM documents),
b AS (SELECT least(floor((n_chars - lo) / ((hi - lo) / 30)), 29)::INTEGER AS bin FROM documents, m)
SELECT bin, lo + bin * ((hi - lo) / 30) AS bin_lo, lo + (bin + 1) * ((hi - lo) / 30) AS bin_hi,
       count(*)::BIGINT AS n
FROM b, m GROUP BY bin, lo, hi""")
def histogram_chars(spark, sf_dir):
    """AGG-12: 30 equal-width bins of n_chars (last bin closed on the right)."""
    return P.histogram(Tables(spark, sf_dir).documents, "n_chars", 30)


@query("pages_per_host", f"""
SELECT host, n_pages, sum(n_pages) OVER ()::BIGINT AS total_pages FROM (
  SELECT regexp_extract(url, {lit(HOST_RE)}, 1) AS host, count(*)::BIGINT AS n_pages FROM pages GROUP BY 1)""")
def pages_per_host(spark, sf_dir):
    """AGG-08: pages per host and the grand total."""
    pages = Tables(spark, sf_dir).pages.select(F.regexp_extract("url", HOST_RE, 1).alias("host"))
    counts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    return counts.withColumn("total_pages", F.lit(counts.select(F.sum("n_pages")).scalar()).cast("bigint"))


@query("tokens_per_source", f"""
SELECT source, count(*)::BIGINT AS n_docs, sum(len({toks('text', 'word')}))::BIGINT AS n_tokens
FROM documents GROUP BY source""")
def tokens_per_source(spark, sf_dir):
    """AGG-09: \\w+ tokens summed per source."""
    docs = Tables(spark, sf_dir).documents
    return docs.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.size(T.tokens(F.col("text"), "word"))).cast("bigint").alias("n_tokens"))


@query("vocab_size", f"""
WITH w AS (SELECT lang, lower(unnest({toks('text', 'word')})) AS w FROM documents)
SELECT lang, count(DISTINCT w)::BIGINT AS vocab_size FROM w GROUP BY lang
UNION ALL SELECT '*', count(DISTINCT w)::BIGINT FROM w""")
def vocab_size(spark, sf_dir):
    """AGG-10: distinct lower-case \\w+ words per language and overall."""
    docs = Tables(spark, sf_dir).documents
    words = docs.select("lang", F.explode(T.tokens(F.lower("text"), "word")).alias("w"))
    per_lang_word = words.groupBy("lang", "w").agg(F.count(F.lit(1)).alias("_c"))
    per_lang = per_lang_word.groupBy("lang").agg(F.count(F.lit(1)).cast("bigint").alias("vocab_size"))
    overall = per_lang_word.select("w").distinct().agg(
        F.lit("*").alias("lang"), F.count(F.lit(1)).cast("bigint").alias("vocab_size"))
    return per_lang.unionByName(overall)


@query("words_by_language", with_ctes("""
SELECT CASE WHEN language = 'Ōlelo Hawaiʻi' THEN 'haw' WHEN language = 'en' THEN 'eng' ELSE language END AS language,
       sum(pages * 300)::BIGINT AS est_words, count(*)::BIGINT AS n_books
FROM catalogue GROUP BY 1""", "catalogue"))
def words_by_language(spark, sf_dir):
    """PRJ-08 recode + PRJ-23 word-count fallback + AGG-11 sum per language."""
    cat = FX.catalogue(Tables(spark, sf_dir).documents)
    cat = cat.withColumn("language", P.recode(F.col("language"), LANGUAGE_RECODE))
    return cat.groupBy("language").agg(
        F.sum(P.estimated_words(cat)).cast("bigint").alias("est_words"),
        F.count(F.lit(1)).alias("n_books"))


# The reference's language patch, plus one stand-in entry for the test tables.
LANGUAGE_RECODE = {"Ōlelo Hawaiʻi": "haw", "en": "eng"}


@query("column_profile", """
SELECT * FROM (VALUES
  ('doc_id', 'numeric'), ('text', 'text'), ('lang', 'text'), ('source', 'text'), ('n_chars', 'numeric')) t(column_name, kind)
JOIN (
  SELECT 'doc_id' AS column_name, count(*) - count(doc_id) AS n_null, count(DISTINCT doc_id) AS n_distinct FROM documents UNION ALL
  SELECT 'text', count(*) - count(text), count(DISTINCT text) FROM documents UNION ALL
  SELECT 'lang', count(*) - count(lang), count(DISTINCT lang) FROM documents UNION ALL
  SELECT 'source', count(*) - count(source), count(DISTINCT source) FROM documents UNION ALL
  SELECT 'n_chars', count(*) - count(n_chars), count(DISTINCT n_chars) FROM documents) s USING (column_name)
CROSS JOIN (SELECT count(*)::BIGINT AS n_rows, 5::BIGINT AS n_columns FROM documents)""")
def column_profile(spark, sf_dir):
    """AGG-14: rows, columns, numeric/text kind, nulls and distinct values per column."""
    return P.column_profile(Tables(spark, sf_dir).documents)
