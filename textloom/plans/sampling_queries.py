"""Sampling and split queries (SMP-01..08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.operators import sampling as S
from textloom.plans import fixtures as FX
from textloom.plans.registry import query
from textloom.plans.sqlparts import with_ctes
from textloom.session import Tables

SEED = 42


def _lines(spark, sf_dir):
    return FX.clean_lines(Tables(spark, sf_dir).documents)


def _md5(*cols: str) -> str:
    return f"md5('{SEED}:' || " + " || ':' || ".join(cols) + ")"


@query("head_fraction", with_ctes("""
SELECT doc_id, line_no, text FROM (
  SELECT *, row_number() OVER (ORDER BY doc_id, line_no) AS r, count(*) OVER () AS n FROM clean_lines)
WHERE r <= floor(n * 0.1::DOUBLE)""", "clean_lines"))
def head_fraction(spark, sf_dir):
    """SMP-01: first 10 % of the non-blank lines in corpus order."""
    return S.head_of_groups(_lines(spark, sf_dir), "doc_id", "line_no", 0.1)


@query("shuffled_fraction", with_ctes(f"""
SELECT doc_id, line_no, text FROM (
  SELECT *, row_number() OVER (ORDER BY {_md5('doc_id', 'line_no')}, doc_id, line_no) AS r,
         count(*) OVER () AS n FROM clean_lines)
WHERE r <= floor(n * 0.25::DOUBLE)""", "clean_lines"))
def shuffled_fraction(spark, sf_dir):
    """SMP-02: seeded shuffle of the lines, then the first 25 %."""
    return S.shuffled_fraction(_lines(spark, sf_dir), ["doc_id", "line_no"], 0.25, SEED)


@query("train_valid_split", with_ctes(f"""
SELECT doc_id, line_no, text, CASE WHEN r <= floor(n * 0.9::DOUBLE) THEN 'train' ELSE 'valid' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY {_md5('doc_id', 'line_no')}, doc_id, line_no) AS r,
             count(*) OVER () AS n FROM clean_lines)""", "clean_lines"))
def train_valid_split(spark, sf_dir):
    """SMP-03: seeded 90/10 train/valid split of the lines."""
    return S.train_valid_split(_lines(spark, sf_dir), ["doc_id", "line_no"], 0.9, SEED)


@query("three_way_split", f"""
SELECT doc_id, lang, CASE WHEN r <= greatest(1, floor(n * 0.8::DOUBLE)) THEN 'train'
                   WHEN r <= greatest(1, floor(n * 0.8::DOUBLE)) + greatest(1, floor(n * 0.1::DOUBLE))
                        THEN 'validation' ELSE 'test' END AS split
FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY {_md5('doc_id')}, doc_id) AS r,
             count(*) OVER () AS n FROM documents)""")
def three_way_split(spark, sf_dir):
    """SMP-04: seeded 80/10/rest split of documents."""
    docs = Tables(spark, sf_dir).documents.select("doc_id", "lang")
    return S.three_way_split(docs, ["doc_id"], (0.8, 0.1, 0.1), SEED)


@query("three_way_split_repaired", f"""
WITH b AS (SELECT item_id, row_number() OVER (ORDER BY {_md5('item_id')}, item_id) AS r,
                  count(*) OVER () AS n FROM benchmark),
s0 AS (SELECT *, greatest(1, floor(n * 0.8::DOUBLE)) AS t0, greatest(1, floor(n * 0.1::DOUBLE)) AS v0 FROM b),
s1 AS (SELECT *, greatest(1, n - t0 - v0) AS e0 FROM s0),
s2 AS (SELECT *, t0 + v0 + e0 - n AS o1 FROM s1),
s3 AS (SELECT *, CASE WHEN o1 > 0 THEN least(o1, t0 - 1) ELSE 0 END AS rt FROM s2),
s4 AS (SELECT *, CASE WHEN o1 - rt > 0 THEN least(o1 - rt, v0 - 1) ELSE 0 END AS rv FROM s3),
s5 AS (SELECT *, CASE WHEN o1 - rt - rv > 0 THEN least(o1 - rt - rv, e0 - 1) ELSE 0 END AS re FROM s4)
SELECT item_id, split FROM (
  SELECT item_id, CASE WHEN r <= t0 - rt THEN 'train' WHEN r <= t0 - rt + v0 - rv THEN 'validation'
                       WHEN r <= t0 - rt + v0 - rv + e0 - re THEN 'test' END AS split FROM s5)
WHERE split IS NOT NULL""")
def three_way_split_repaired(spark, sf_dir):
    """SMP-05: 80/10/10 split with overflow repair, on the benchmark sentences."""
    items = Tables(spark, sf_dir).benchmark.select("item_id")
    return S.three_way_split(items, ["item_id"], (0.8, 0.1, 0.1), SEED, repair=True)


@query("sample_n", f"SELECT doc_id, lang FROM documents ORDER BY {_md5('doc_id')}, doc_id LIMIT 25")
def sample_n(spark, sf_dir):
    """SMP-06: 25 seeded documents."""
    docs = Tables(spark, sf_dir).documents.select("doc_id", "lang")
    return S.sample_n(docs, ["doc_id"], 25, SEED)


@query("first_n_subset", with_ctes("""
SELECT doc_id, line_no, 'train' AS subset FROM (SELECT * FROM clean_lines ORDER BY doc_id, line_no LIMIT 1000)
UNION ALL
SELECT doc_id, line_no, 'valid' AS subset FROM (
  SELECT * FROM (SELECT * FROM clean_lines ORDER BY doc_id, line_no LIMIT 2000) ORDER BY doc_id, line_no LIMIT 200)""",
                                   "clean_lines"))
def first_n_subset(spark, sf_dir):
    """SMP-07: first 1000 lines; validation = first 200 of the first 2000 (overlapping)."""
    lines = _lines(spark, sf_dir).select("doc_id", "line_no")
    order = [F.col("doc_id"), F.col("line_no")]
    train = S.first_n(lines, order, 1000).withColumn("subset", F.lit("train"))
    valid = S.first_n(S.first_n(lines, order, 2000), order, 200).withColumn("subset", F.lit("valid"))
    return train.unionByName(valid)


@query("position_cap", with_ctes(f"""
SELECT doc_id, line_no, sent_no, tok_idx FROM (
  SELECT *, row_number() OVER (ORDER BY {_md5('doc_id', 'line_no', 'sent_no', 'tok_idx')},
                                doc_id, line_no, sent_no, tok_idx) AS r FROM preds)
WHERE r <= 10000""", "preds"))
def position_cap(spark, sf_dir):
    """SMP-08: at most 10,000 seeded scoring positions."""
    preds = FX.predictions(Tables(spark, sf_dir).documents).select("doc_id", "line_no", "sent_no", "tok_idx")
    return S.position_cap(preds, ["doc_id", "line_no", "sent_no", "tok_idx"], 10000, SEED)
