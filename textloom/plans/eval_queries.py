"""Metric, run-log and leaderboard queries (AGG-18..24, WIN-01/04/05/08, RUN-01..04, JSN-02/03, STM-07)."""

from __future__ import annotations

from pyspark.sql import functions as F

from textloom.functions import jsonx
from textloom.operators import metrics as M
from textloom.operators import profile as P
from textloom.operators import runs as R
from textloom.plans import fixtures as FX
from textloom.plans.registry import query
from textloom.plans.sqlparts import register_cte, with_ctes
from textloom.session import Tables, stored_for
from textloom.sources import sinks

SK = FX.SENT_KEYS

register_cte("runs", (), """
    SELECT o_orderkey AS run_id, CASE WHEN o_orderstatus = 'O' THEN 'lm' ELSE 'pos' END AS experiment,
           'm' || o_custkey AS model, o_orderdate AS start_time, o_orderpriority AS priority,
           o_orderstatus AS status, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_totalprice END AS price
    FROM orders""")
register_cte("latest", ("runs",), """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY experiment, model
                                               ORDER BY start_time DESC, run_id DESC) AS r FROM runs)
    WHERE r = 1""")
register_cte("board", ("latest",), """
    WITH lm AS (SELECT model, price / 1e5::DOUBLE AS eval_loss, price / 1e3::DOUBLE AS pseudo_perplexity,
                       CASE WHEN price IS NOT NULL THEN (run_id % 97) / 97.0::DOUBLE END AS masked_acc,
                       CASE WHEN price IS NOT NULL THEN (run_id % 89) / 89.0::DOUBLE END AS top5,
                       CASE WHEN price IS NOT NULL THEN (run_id % 83) / 83.0::DOUBLE END AS mrr
                FROM latest WHERE experiment = 'lm'),
    pos AS (SELECT model, price / 6e5::DOUBLE AS pos_acc, price / 7e5::DOUBLE AS eval_f1
            FROM latest WHERE experiment = 'pos')
    SELECT 'm' || c_custkey AS model, c_mktsegment AS family, eval_loss, pseudo_perplexity, masked_acc, top5, mrr,
           pos_acc, eval_f1, eval_loss AS perplexity_raw, exp(eval_loss) AS perplexity
    FROM customer LEFT JOIN lm ON lm.model = 'm' || c_custkey LEFT JOIN pos ON pos.model = 'm' || c_custkey""")


def _runs(spark, sf_dir):
    """The stored run log of the orders, written on first use and appended to (nothing new) afterwards."""
    orders = Tables(spark, sf_dir).orders
    path = f"{stored_for(orders, 'run-log')}/runs"
    runs = FX.runs(orders)
    if sinks.run_log(spark, path) is None:
        sinks.append_runs(runs, path)
    return sinks.run_log(spark, path, runs)


def _board(spark, sf_dir):
    return R.leaderboard(FX.models(Tables(spark, sf_dir).customer), _runs(spark, sf_dir), "lm", "pos")


@query("latest_run_metric", with_ctes("""
SELECT experiment, model, run_id, start_time,
       CASE WHEN experiment = 'lm' THEN price / 1e5::DOUBLE ELSE price / 6e5::DOUBLE END AS metric
FROM latest""", "latest"))
def latest_run_metric(spark, sf_dir):
    """WIN-01 + SRC-12: newest run per (experiment, model) and its headline metric (null if the run lacks it)."""
    lat = R.latest_runs(_runs(spark, sf_dir))
    m = F.when(F.col("experiment") == "lm", R.metric("metrics", "eval_loss")) \
        .otherwise(R.metric("metrics", "eval_accuracy"))
    return lat.select("experiment", "model", "run_id", "start_time", m.alias("metric"))


@query("leaderboard", with_ctes("SELECT * FROM board", "board"))
def leaderboard(spark, sf_dir):
    """RUN-01 + JOIN-11 + PRJ-20 + AGG-24 + SRT-01: one row per configured model."""
    return _board(spark, sf_dir)


_DISPLAY = ", ".join(f"coalesce(printf('%.4f', round_even({c} * 10000.0, 0) / 10000.0), '–') AS {c}"
                     for c in R.DISPLAY_COLS)


# Model families of the reference's category map stand in for market segments.
FAMILIES = {"AUTOMOBILE": "from scratch", "BUILDING": "multilingual", "FURNITURE": "distilled", "HOUSEHOLD": "classical"}


@query("model_families", f"""
SELECT CASE {' '.join(f"WHEN c_mktsegment = '{k}' THEN '{v}'" for k, v in FAMILIES.items())} ELSE c_mktsegment END AS family,
       count(*) AS n_models FROM customer GROUP BY 1""")
def model_families(spark, sf_dir):
    """PRJ-20: models per family by the category map; a category that is not in it keeps its name."""
    models = FX.models(Tables(spark, sf_dir).customer)
    return models.groupBy(P.recode(F.col("family"), FAMILIES).alias("family")).agg(F.count(F.lit(1)).alias("n_models"))


@query("leaderboard_display", with_ctes(f"SELECT model, {_DISPLAY} FROM board", "board"))
def leaderboard_display(spark, sf_dir):
    """RUN-02 + PRJ-19: rounded (half-even, 4 places) text table with '–' for missing."""
    return R.display_table(_board(spark, sf_dir))


@query("leaderboard_chart", with_ctes("""
SELECT * FROM board WHERE perplexity_raw IS NOT NULL OR pos_acc IS NOT NULL""", "board"))
def leaderboard_chart(spark, sf_dir):
    """RUN-03 + PRJ-18: models with at least one plotted metric."""
    return R.chart_input(_board(spark, sf_dir))


@query("hyperparam_listing", with_ctes("""
WITH p AS (SELECT model, 'name' AS key, model AS value FROM latest WHERE experiment = 'pos' UNION ALL
           SELECT model, 'priority', priority FROM latest WHERE experiment = 'pos' UNION ALL
           SELECT model, 'status', status FROM latest WHERE experiment = 'pos')
SELECT m.model, p.key, coalesce(p.value, 'no runs found') AS value
FROM (SELECT 'm' || c_custkey AS model FROM customer) m LEFT JOIN p USING (model)""", "latest"))
def hyperparam_listing(spark, sf_dir):
    """RUN-04 + SRT-04: latest POS run's parameters per model, sorted by key."""
    t = Tables(spark, sf_dir)
    return R.hyperparams(FX.models(t.customer).select("model"), FX.runs(t.orders), "pos")


@query("epoch_delta", """
SELECT event_id, user_id, value - coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS delta
FROM events""")
def epoch_delta(spark, sf_dir):
    """WIN-05: change of a cumulative reading against the previous one per run (first minus 0), skew-safe."""
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "value")
    return R.sequence_delta(ev, "user_id", ["ts", "event_id"], "value").select("event_id", "user_id", "delta")


@query("version_retention", """
WITH v AS (SELECT DISTINCT o_custkey AS project, CASE WHEN o_custkey % 7 <> 0 AND o_orderkey % 17 <> 0
                                                      THEN o_orderkey END AS version FROM orders),
p AS (SELECT project, max(version) AS newest, count(version) AS n FROM v GROUP BY project)
SELECT project, version, CASE WHEN n >= 2 AND version < newest THEN 'deleted' ELSE 'kept' END AS status
FROM v JOIN p USING (project) WHERE version IS NOT NULL
UNION ALL SELECT project, coalesce(newest, 0) + 1, 'new' FROM p""")
def version_retention(spark, sf_dir):
    """WIN-08: names N and vN are versions, others are not; a project without any starts at 1."""
    o = Tables(spark, sf_dir).orders
    key = F.col("o_orderkey").cast("string")
    names = o.select("o_custkey", F.when((F.col("o_custkey") % 7 == 0) | (F.col("o_orderkey") % 17 == 0),
                                         F.concat(F.lit("tmp"), key))
                     .when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("v"), key)).otherwise(key).alias("name"))
    return R.retention(names, "o_custkey", "name")


@query("flatten_props", """
SELECT event_id, key, CASE WHEN json_type(props, '$.' || key) = 'BOOLEAN'
                           THEN CASE WHEN json_extract(props, '$.' || key)::BOOLEAN THEN 1.0 ELSE 0.0 END
                           ELSE json_extract(props, '$.' || key)::DOUBLE END AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)
WHERE json_type(props, '$.' || key) IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'BOOLEAN')""")
def flatten_props(spark, sf_dir):
    """JSN-02: numeric leaves of the event payloads under dotted keys."""
    ev = Tables(spark, sf_dir).events
    return jsonx.flatten_numbers(ev, ["event_id"], "props")


@query("config_access", """
SELECT event_id, coalesce(json_extract_string(props, '$.k'), '-1') AS k,
       coalesce(json_extract_string(props, '$.feature_flags.notifications.enabled'), 'false') AS notify
FROM events""")
def config_access(spark, sf_dir):
    """JSN-03: nested lookups with defaults."""
    ev = Tables(spark, sf_dir).events
    return ev.select("event_id", jsonx.get_with_default(F.col("props"), "k", "-1").alias("k"),
                     jsonx.get_with_default(F.col("props"), "feature_flags.notifications.enabled", "false")
                     .alias("notify"))


_REPORT_SQL = """
WITH conf AS (SELECT gold, pred, count(*) AS n FROM {src} GROUP BY gold, pred),
lab AS (SELECT label, sum(g) AS gold_n, sum(p) AS pred_n, sum(tp) AS tp FROM (
          SELECT gold AS label, n AS g, 0 AS p, CASE WHEN gold = pred THEN n ELSE 0 END AS tp FROM conf
          UNION ALL SELECT pred, 0, n, 0 FROM conf) GROUP BY label),
per AS (SELECT tp, pred_n - tp AS fp, gold_n - tp AS fn FROM lab),
m AS (SELECT avg(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END) AS macro_f1,
             avg(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END) AS macro_precision,
             avg(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END) AS macro_recall,
             sum(tp) AS stp, sum(fp) AS sfp, sum(fn) AS sfn FROM per),
t AS (SELECT sum(n) AS n, sum(CASE WHEN gold = pred THEN n ELSE 0 END) AS correct FROM conf),
x AS (SELECT n::BIGINT AS n, correct / n AS accuracy, macro_f1, macro_precision, macro_recall,
             CASE WHEN stp + sfp = 0 THEN 0.0 ELSE stp / (stp + sfp) END AS micro_precision,
             CASE WHEN stp + sfn = 0 THEN 0.0 ELSE stp / (stp + sfn) END AS micro_recall FROM t, m)
SELECT {cols} FROM (SELECT *, CASE WHEN micro_precision + micro_recall = 0 THEN 0.0
                   ELSE 2 * micro_precision * micro_recall / (micro_precision + micro_recall) END AS micro_f1 FROM x)"""


@query("accuracy_macro_f1", with_ctes(_REPORT_SQL.format(src="preds", cols="n, accuracy, macro_f1"), "preds"))
def accuracy_macro_f1(spark, sf_dir):
    """AGG-19: accuracy and macro-F1 over the label union, synthetic predictions."""
    p = FX.predictions(Tables(spark, sf_dir).documents)
    return M.classification_report(p).select("n", "accuracy", "macro_f1")


@query("binary_f1", _REPORT_SQL.format(
    src="(SELECT quality AS gold, CASE WHEN n_chars >= 1500 THEN 1 ELSE 0 END AS pred "
        "FROM labels JOIN documents USING (doc_id))", cols="n, accuracy, macro_f1"))
def binary_f1(spark, sf_dir):
    """AGG-19 on the binary quality labels against a length rule."""
    t = Tables(spark, sf_dir)
    j = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    p = j.select(F.col("quality").alias("gold"), F.when(F.col("n_chars") >= 1500, 1).otherwise(0).alias("pred"))
    return M.classification_report(p).select("n", "accuracy", "macro_f1")


@query("precision_recall_micro", with_ctes(_REPORT_SQL.format(
    src="preds", cols="accuracy, micro_precision, micro_recall, micro_f1, macro_precision, macro_recall"), "preds"))
def precision_recall_micro(spark, sf_dir):
    """AGG-20: token-level micro and macro precision / recall / F1."""
    p = FX.predictions(Tables(spark, sf_dir).documents)
    return M.classification_report(p).select("accuracy", "micro_precision", "micro_recall", "micro_f1",
                                             "macro_precision", "macro_recall")


@query("sentence_exact_match", with_ctes("""
SELECT count(*)::BIGINT AS n_sentences, coalesce(avg(ok::INTEGER::DOUBLE), 0.0) AS exact_match
FROM (SELECT bool_and(gold = pred) AS ok FROM preds GROUP BY doc_id, line_no, sent_no)""", "preds"))
def sentence_exact_match(spark, sf_dir):
    """AGG-21: share of sentences tagged entirely right."""
    return M.sentence_exact_match(FX.predictions(Tables(spark, sf_dir).documents), SK)


@query("sentence_certainty", with_ctes("""
SELECT doc_id, line_no, sent_no, coalesce(min(round(score, 4)), 0.0) AS certainty
FROM preds GROUP BY doc_id, line_no, sent_no""", "preds"))
def sentence_certainty(spark, sf_dir):
    """AGG-18: minimum rounded token score per sentence."""
    return M.sentence_certainty(FX.predictions(Tables(spark, sf_dir).documents), SK)


@query("uncertainty_queue", with_ctes("""
SELECT doc_id, line_no, sent_no, certainty FROM (
  SELECT doc_id, line_no, sent_no, coalesce(min(round(score, 4)), 0.0) AS certainty
  FROM preds GROUP BY doc_id, line_no, sent_no)
ORDER BY certainty, doc_id, line_no, sent_no LIMIT 20""", "preds"))
def uncertainty_queue(spark, sf_dir):
    """STM-07: the 20 least certain sentences to label next (top-k report)."""
    c = M.sentence_certainty(FX.predictions(Tables(spark, sf_dir).documents), SK)
    return c.orderBy("certainty", *SK).limit(20)


@query("rank_metrics", """
WITH x AS (SELECT label, (i - 1) AS dim, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i
           FROM embeddings),
e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(v) AS m FROM e GROUP BY label, i),
lg AS (SELECT e.vec_id, e.label AS gold, c.label, sum(e.v * c.m) AS logit FROM e JOIN c USING (i)
       GROUP BY e.vec_id, e.label, c.label),
rk AS (SELECT vec_id, 1 + count(*) FILTER (WHERE l.logit > g.logit) AS rank
       FROM lg l JOIN (SELECT vec_id, logit FROM lg WHERE label = gold) g USING (vec_id) GROUP BY vec_id)
SELECT count(rank)::BIGINT AS n, coalesce(avg((rank = 1)::INTEGER::DOUBLE), 0.0) AS accuracy,
       coalesce(avg((rank <= 5)::INTEGER::DOUBLE), 0.0) AS top5, coalesce(avg(1.0 / rank), 0.0) AS mrr FROM rk""")
def rank_metrics(spark, sf_dir):
    """AGG-22 + WIN-04 on candidates C.6: gold rank among all label logits → accuracy, top-5, MRR."""
    cand = FX.candidates(Tables(spark, sf_dir).embeddings)
    return M.rank_report(cand.select(M.rank_of_gold(F.col("logits"), F.col("gold")).alias("rank")))


@query("label_softmax", """
WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label, i, avg(v) AS m FROM e GROUP BY label, i),
lg AS (SELECT e.vec_id, c.label, sum(e.v * c.m) AS logit FROM e JOIN c USING (i) GROUP BY e.vec_id, c.label)
SELECT vec_id, arg_max(label, logit) AS pred, 1 / sum(exp(logit - m)) AS prob
FROM lg JOIN (SELECT vec_id, max(logit) AS m FROM lg GROUP BY vec_id) USING (vec_id) GROUP BY vec_id""")
def label_softmax(spark, sf_dir):
    """MTH-01: per embedding, the best label and its softmax probability."""
    cand = FX.candidates(Tables(spark, sf_dir).embeddings)
    logits, labels = (F.col("logits")[f] for f in ("logit", "label"))  # a field of every element
    return cand.select("vec_id", M.best_label(logits, labels).alias("b")).select(
        "vec_id", F.col("b.label").alias("pred"), F.col("b.prob").alias("prob"))


@query("metric_log", with_ctes("""
SELECT l.run_id, l.experiment, key, (row_number() OVER (
         PARTITION BY l.experiment, model, key ORDER BY start_time, l.run_id) - 1)::INTEGER AS step, value FROM (
  SELECT run_id, experiment, 'eval_loss' AS key, price / 1e5::DOUBLE AS value FROM runs WHERE experiment = 'lm'
  UNION ALL SELECT run_id, experiment, 'pseudo_perplexity', price / 1e3::DOUBLE FROM runs WHERE experiment = 'lm'
  UNION ALL SELECT run_id, experiment, 'eval_masked_accuracy', (run_id % 97) / 97.0::DOUBLE FROM runs
            WHERE experiment = 'lm' AND price IS NOT NULL
  UNION ALL SELECT run_id, experiment, 'eval_masked_top5', (run_id % 89) / 89.0::DOUBLE FROM runs
            WHERE experiment = 'lm' AND price IS NOT NULL
  UNION ALL SELECT run_id, experiment, 'eval_masked_mrr', (run_id % 83) / 83.0::DOUBLE FROM runs
            WHERE experiment = 'lm' AND price IS NOT NULL
  UNION ALL SELECT run_id, experiment, 'eval_accuracy', price / 6e5::DOUBLE FROM runs WHERE experiment = 'pos'
  UNION ALL SELECT run_id, experiment, 'eval_f1', price / 7e5::DOUBLE FROM runs WHERE experiment = 'pos') l
JOIN runs USING (run_id) WHERE value IS NOT NULL""", "runs"))
def metric_log(spark, sf_dir):
    """RUN-05 + SNK-06 rows: every logged metric of every run as (run, key, step, value)."""
    return R.metric_log(_runs(spark, sf_dir))
