"""Masked-LM chain queries (AGG-27, JOIN-03, SET-03, SUB-05, SUB-07, ML-09, SRT-02, AGG-22, AGG-23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import maskedlm as ML
from textloom.operators import metrics as M
from textloom.plans import fixtures as FX
from textloom.plans.registry import query
from textloom.plans.sqlparts import register_cte, toks, with_ctes
from textloom.session import Tables, cut_lineage

SEED = 42
W = toks("lower(text)", "word")

register_cte("vocab", (), f"""
    SELECT word, n, (row_number() OVER (ORDER BY n DESC, word) - 1)::INTEGER AS id FROM (
      SELECT word, count(*) AS n FROM (SELECT unnest({W}) AS word FROM documents) GROUP BY word HAVING count(*) >= 2)""")
register_cte("bench_ids", ("vocab",), f"""
    SELECT item_id, pos, word, coalesce(id, (SELECT count(*) FROM vocab))::INTEGER AS id FROM (
      SELECT item_id, generate_subscripts(w, 1)::INTEGER AS pos, unnest(w) AS word
      FROM (SELECT item_id, {W} AS w FROM benchmark)) LEFT JOIN vocab USING (word)""")
register_cte("ctx_counts", ("clean_lines",), f"""
    SELECT prev, next, word, count(*) AS c FROM (
      SELECT list_concat(['{ML.BOS}'], w)[i] AS prev, w[i] AS word, list_concat(w, ['{ML.EOS}'])[i + 1] AS next
      FROM (SELECT w, unnest(generate_series(1, len(w))) AS i FROM (SELECT {W} AS w FROM clean_lines)
            WHERE len(w) >= 1))
    GROUP BY prev, next, word""")
register_cte("bench_pos", (), f"""
    SELECT item_id, i::INTEGER AS pos, w[i] AS word, list_concat(['{ML.BOS}'], w)[i] AS prev,
           list_concat(w, ['{ML.EOS}'])[i + 1] AS next
    FROM (SELECT item_id, w, unnest(generate_series(1, len(w))) AS i
          FROM (SELECT item_id, {W} AS w FROM benchmark) WHERE len(w) >= 3)""")
register_cte("bench_tri", ("ctx_counts", "bench_pos"), """
    SELECT c.* FROM ctx_counts c SEMI JOIN (SELECT DISTINCT prev, next FROM bench_pos) n USING (prev, next)""")


def _vocab(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents
    return ML.build_vocab(ML.word_frequency(ML.words(docs, ["doc_id"], "text"), 2))


def _bench_ids(spark, sf_dir):
    bench = Tables(spark, sf_dir).benchmark
    return ML.lookup_ids(ML.words(bench, ["item_id"], "text"), _vocab(spark, sf_dir))


def _model(spark, sf_dir):
    lines = FX.clean_lines(Tables(spark, sf_dir).documents)
    # Read by every level of the model, so counted once and kept as a table.
    return cut_lineage(ML.context_counts(lines, ["doc_id", "line_no"], "text"))


def _positions(spark, sf_dir):
    return ML.contexts_from_arrays(Tables(spark, sf_dir).benchmark, ["item_id"], "text", 3)


@query("word_frequency_min", f"""
SELECT word, count(*)::BIGINT AS n FROM (SELECT unnest({W}) AS word FROM documents) GROUP BY word
HAVING count(*) >= 2""")
def word_frequency_min(spark, sf_dir):
    """AGG-27: word counts kept at min_frequency 2 (input of vocabulary training)."""
    docs = Tables(spark, sf_dir).documents
    return ML.word_frequency(ML.words(docs, ["doc_id"], "text"), 2)


@query("vocab_lookup_unk", with_ctes("SELECT item_id, pos, word, id FROM bench_ids", "bench_ids"))
def vocab_lookup_unk(spark, sf_dir):
    """JOIN-03 + SET-03: benchmark words mapped to vocabulary ids, unknown words to <UNK> (= size)."""
    return _bench_ids(spark, sf_dir).select("item_id", "pos", "word", "id")


@query("mlm_masking", with_ctes(f"""
WITH v AS (SELECT count(*) AS v FROM vocab),
u AS (SELECT item_id, pos, id,
             ('0x' || substr(md5('{SEED}:' || item_id || ':' || pos), 1, 8))::BIGINT / 4294967296.0 AS u1,
             ('0x' || substr(md5('{SEED + 1}:' || item_id || ':' || pos), 1, 8))::BIGINT / 4294967296.0 AS u2,
             (('0x' || substr(md5('{SEED + 2}:' || item_id || ':' || pos), 1, 8))::BIGINT % v)::INTEGER AS rnd,
             (v + 1)::INTEGER AS mask_id
      FROM bench_ids, v)
SELECT item_id, pos,
       CASE WHEN NOT u1 < 0.15 THEN id WHEN u2 < 0.8 THEN mask_id WHEN u2 < 0.9 THEN rnd ELSE id END AS input_id,
       CASE WHEN u1 < 0.15 THEN id ELSE -100 END AS label
FROM u""", "bench_ids", "vocab"))
def mlm_masking(spark, sf_dir):
    """SUB-05: deterministic 15 % masking (80/10/10) with -100 labels elsewhere."""
    vsize = _vocab(spark, sf_dir).select(F.count(F.lit(1))).scalar()
    return ML.mask_tokens(_bench_ids(spark, sf_dir), ["item_id"], vsize, SEED, 0.15)


@query("mask_expand", with_ctes("SELECT item_id, pos, word, prev, next FROM bench_pos", "bench_pos"))
def mask_expand(spark, sf_dir):
    """SUB-07 + PRJ-16: one scoring row per word of each benchmark text longer than two words."""
    return _positions(spark, sf_dir)


@query("fill_mask_topk", with_ctes("""
WITH top3 AS (SELECT prev, next, word AS filler, c / sum(c) OVER (PARTITION BY prev, next) AS score,
                     row_number() OVER (PARTITION BY prev, next ORDER BY c DESC, word) AS rk FROM bench_tri),
bi AS (SELECT prev, word, sum(c) AS c FROM ctx_counts WHERE prev IN (SELECT prev FROM bench_pos) GROUP BY prev, word),
top2 AS (SELECT prev, word AS filler, c / sum(c) OVER (PARTITION BY prev) AS score,
                row_number() OVER (PARTITION BY prev ORDER BY c DESC, word) AS rk FROM bi),
uni AS (SELECT word, sum(c) AS c FROM ctx_counts GROUP BY word),
top1 AS (SELECT word AS filler, c / (SELECT sum(c) FROM uni) AS score, row_number() OVER (ORDER BY c DESC, word) AS rk
         FROM uni),
h3 AS (SELECT DISTINCT prev, next, true AS h3 FROM bench_tri),
h2 AS (SELECT DISTINCT prev, true AS h2 FROM bi),
p AS (SELECT b.*, h3.h3, h2.h2 FROM bench_pos b LEFT JOIN h3 USING (prev, next) LEFT JOIN h2 USING (prev))
SELECT item_id, pos, rk::INTEGER AS rank, filler, score FROM p JOIN top3 USING (prev, next) WHERE h3 AND rk <= 5
UNION ALL
SELECT item_id, pos, rk::INTEGER, filler, score FROM p JOIN top2 USING (prev) WHERE h3 IS NULL AND h2 AND rk <= 5
UNION ALL
SELECT item_id, pos, rk::INTEGER, filler, score FROM p, top1 WHERE h3 IS NULL AND h2 IS NULL AND rk <= 5""",
                                   "bench_tri", "bench_pos", "ctx_counts"))
def fill_mask_topk(spark, sf_dir):
    """ML-09 + SRT-02: five most likely fillers for every masked benchmark position."""
    return ML.fill_mask(_positions(spark, sf_dir), ["item_id"], _model(spark, sf_dir), 5)


@query("fill_mask_texts", with_ctes(f"""
WITH top3 AS (SELECT prev, next, word AS filler, c / sum(c) OVER (PARTITION BY prev, next) AS score,
                     row_number() OVER (PARTITION BY prev, next ORDER BY c DESC, word) AS rk FROM bench_tri),
bi AS (SELECT prev, word, sum(c) AS c FROM ctx_counts WHERE prev IN (SELECT prev FROM bench_pos) GROUP BY prev, word),
top2 AS (SELECT prev, word AS filler, c / sum(c) OVER (PARTITION BY prev) AS score,
                row_number() OVER (PARTITION BY prev ORDER BY c DESC, word) AS rk FROM bi),
uni AS (SELECT word, sum(c) AS c FROM ctx_counts GROUP BY word),
top1 AS (SELECT word AS filler, c / (SELECT sum(c) FROM uni) AS score, row_number() OVER (ORDER BY c DESC, word) AS rk
         FROM uni),
h3 AS (SELECT DISTINCT prev, next, true AS h3 FROM bench_tri),
h2 AS (SELECT DISTINCT prev, true AS h2 FROM bi),
n AS (SELECT item_id, max(pos) AS n FROM bench_pos GROUP BY item_id),
p AS (SELECT b.*, h3.h3, h2.h2 FROM bench_pos b JOIN n USING (item_id) LEFT JOIN h3 USING (prev, next) LEFT JOIN h2 USING (prev)
      WHERE item_id % 2 = 0 AND pos = n // 2 + 1),
f AS (SELECT item_id, pos, rk::INTEGER AS rank, filler, score FROM p JOIN top3 USING (prev, next) WHERE h3 AND rk <= 5
UNION ALL
SELECT item_id, pos, rk::INTEGER, filler, score FROM p JOIN top2 USING (prev) WHERE h3 IS NULL AND h2 AND rk <= 5
UNION ALL
SELECT item_id, pos, rk::INTEGER, filler, score FROM p, top1 WHERE h3 IS NULL AND h2 IS NULL AND rk <= 5)
SELECT *, NULL::VARCHAR AS hint FROM f
UNION ALL
SELECT item_id, NULL, NULL, NULL, NULL, '{ML.NO_MASK}' FROM benchmark WHERE item_id NOT IN (SELECT item_id FROM p)""",
                                    "bench_tri", "bench_pos", "ctx_counts"))
def fill_mask_texts(spark, sf_dir):
    """ML-09 + SRT-02: benchmark texts with [MASK] for their middle word filled, those of every other item; a text without
    [MASK] gives a hint row."""
    bench = Tables(spark, sf_dir).benchmark
    words = T.tokens(F.col("text"), "word")
    masked = F.array_join(F.transform(words, lambda w, i: F.when(i == F.floor(F.size(words) / 2), ML.MASK).otherwise(w)), " ")
    texts = bench.select("item_id", F.when((F.col("item_id") % 2 == 0) & (F.size(words) >= 3), masked)
                         .otherwise(F.col("text")).alias("text"))
    return ML.fill_texts(texts, ["item_id"], "text", _model(spark, sf_dir), 5)


@query("masked_lm_metrics", with_ctes("""
WITH lv AS (SELECT prev, next, c, count(*) AS m FROM bench_tri GROUP BY prev, next, c),
ab AS (SELECT prev, next, c, coalesce(sum(m) OVER (PARTITION BY prev, next ORDER BY c DESC
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM lv),
tot AS (SELECT prev, next, sum(m) AS n_cand FROM lv GROUP BY prev, next),
g AS (SELECT b.*, t.c FROM bench_pos b LEFT JOIN bench_tri t USING (prev, next, word)),
r AS (SELECT CASE WHEN g.c IS NOT NULL THEN ab.above + 1 ELSE coalesce(tot.n_cand, 0) + 1 END AS rank
      FROM g LEFT JOIN ab USING (prev, next, c) LEFT JOIN tot USING (prev, next))
SELECT count(rank)::BIGINT AS n, coalesce(avg((rank = 1)::INTEGER::DOUBLE), 0.0) AS accuracy,
       coalesce(avg((rank <= 5)::INTEGER::DOUBLE), 0.0) AS top5, coalesce(avg(1.0 / rank), 0.0) AS mrr FROM r""",
                                      "bench_tri", "bench_pos"))
def masked_lm_metrics(spark, sf_dir):
    """AGG-22 + WIN-04 for the context model: masked accuracy, top-5 and MRR on the benchmark."""
    r = ML.gold_ranks(_positions(spark, sf_dir), ["item_id"], _model(spark, sf_dir))
    return M.rank_report(r)


@query("pseudo_perplexity", with_ctes("""
WITH tot AS (SELECT prev, next, sum(c) AS n_ctx FROM bench_tri GROUP BY prev, next),
v AS (SELECT count(DISTINCT word) AS v FROM ctx_counts),
lp AS (SELECT ln((coalesce(t.c, 0) + 0.1::DOUBLE) / (coalesce(tot.n_ctx, 0) + 0.1::DOUBLE * v)) AS logp
       FROM bench_pos b LEFT JOIN bench_tri t USING (prev, next, word) LEFT JOIN tot USING (prev, next), v)
SELECT count(logp)::BIGINT AS n_tokens, coalesce(exp(-avg(logp)), 'inf'::DOUBLE) AS pseudo_perplexity FROM lp""",
                                      "bench_tri", "bench_pos", "ctx_counts"))
def pseudo_perplexity(spark, sf_dir):
    """AGG-23: exp(-mean log P(word | neighbours)) over benchmark words; +inf with none."""
    lp = ML.gold_logprob(_positions(spark, sf_dir), ["item_id"], _model(spark, sf_dir), 0.1)
    return M.pseudo_perplexity(lp)
