"""Streaming and pool queries (SRC-13, STM-01..08, JOIN-12)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from textloom.plans.registry import query
from textloom.plans.sqlparts import register_cte, tag_sql, trim, with_ctes
from textloom.session import Tables, ensure_checkpoint_dir
from textloom.sources.store import Store
from textloom.streaming import annotation_loop as AL
from textloom.streaming import feed as FD
from textloom.streaming import retrain as RT


register_cte("chat", (), """
    SELECT conv_id, turn, role, CASE WHEN conv_id % 4 = 1 AND turn >= 2
           THEN first_value(text) OVER (PARTITION BY conv_id ORDER BY turn) ELSE text END AS text
    FROM conversations""")


def _events(spark, sf_dir):
    return FD.annotation_events(Tables(spark, sf_dir).conversations)


# Events in the order in which a project's pool takes them: rows, imported rows, trainings, clearings.
register_cte("pool_events", ("chat",), f"""
    SELECT *, row_number() OVER (PARTITION BY project ORDER BY event_seq, sub) AS i FROM (
      SELECT conv_id // 100 AS project, conv_id * 1000 + turn * 2 AS event_seq, 0 AS sub, 'row' AS kind, text,
             '[{{"start": 0, "end": ' || length(first) || ', "labels": ["' || {tag_sql('first', '1')} ||
             '"]}}, {{"start": 0, "end": ' || length(text) || ', "labels": ["X"]}}]' AS label_json
      FROM (SELECT *, regexp_extract(text, '[\\p{{L}}\\p{{N}}_]+|[^\\s]') AS first FROM chat)
      WHERE role IN ('user', 'assistant') AND NOT (conv_id % 10 = 5 AND turn = 1) AND {trim('text')} <> ''
      UNION ALL
      SELECT conv_id // 100, conv_id * 1000 + 980, sub, 'row', text,
             '[{{"start": 0, "end": ' || length(text) || ', "labels": ["X"]}}]'
      FROM (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1)::INTEGER AS sub FROM chat
            WHERE conv_id % 13 = 0) WHERE {trim('text')} <> ''
      UNION ALL
      SELECT DISTINCT conv_id // 100, conv_id * 1000 + 990, 0, 'train', NULL, NULL FROM chat WHERE conv_id % 7 = 0
      UNION ALL
      SELECT DISTINCT conv_id // 100, conv_id * 1000 + 995, 0, 'clear', NULL, NULL FROM chat WHERE conv_id % 11 = 0)""")


_STREAM_SQL = f"""
WITH RECURSIVE st AS (
  SELECT DISTINCT project, 0::BIGINT AS i, []::STRUCT(event_seq BIGINT, sub INTEGER, "text" VARCHAR, label_json VARCHAR)[] AS pool,
         0::BIGINT AS batch_id, []::STRUCT(event_seq BIGINT, sub INTEGER, "text" VARCHAR, label_json VARCHAR)[] AS gone,
         false AS forced, 0::BIGINT AS next_batch FROM pool_events
  UNION ALL
  SELECT project, i, CASE WHEN kind = 'clear' OR goes THEN [] ELSE grown END, next_batch, CASE WHEN goes THEN grown ELSE [] END,
         kind = 'train', CASE WHEN goes THEN next_batch + 1 ELSE next_batch END
  FROM (SELECT *, len(grown) >= {AL.POOL_THRESHOLD} OR kind = 'train' AND len(grown) >= {AL.FORCE_MIN} AS goes FROM (
    SELECT e.project, e.i, e.kind, st.next_batch,
           CASE WHEN e.kind = 'row' AND NOT list_contains(list_transform(pool, lambda p: p."text"), e.text)
                THEN list_append(pool, struct_pack(event_seq := e.event_seq, sub := e.sub, "text" := e.text,
                                                   label_json := e.label_json)) ELSE pool END AS grown
    FROM st JOIN pool_events e ON e.project = st.project AND e.i = st.i + 1)))
"""


@query("stream_pool", with_ctes(_STREAM_SQL + """
SELECT project, batch_id, r.event_seq, r.sub, r."text" AS text, r.label_json, forced
FROM (SELECT project, batch_id, forced, unnest(gone) AS r FROM st)""", "pool_events"))
def stream_pool(spark, sf_dir):
    """STM-01..05: the event feed streamed through the per-project pool; one row per emitted example."""
    path = FD.write_feed(_events(spark, sf_dir), 4)
    ann, _dead = AL.normalise(FD.read_feed(spark, path))
    return FD.run_available(AL.pool_stream(ann))


@query("retrain_status", with_ctes(_STREAM_SQL + """
SELECT project, batch_id, batch_id + 1 AS version, 'done' AS status, len(gone) AS n_rows FROM st WHERE len(gone) > 0""",
                                   "pool_events"))
def retrain_status(spark, sf_dir):
    """STM-06 + STM-04 + WIN-08: the streamed batches retrained, those of a trigger together (label counts per batch, and
    the ML-06 tagger refitted and stored); status and rows per batch."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/retrain-{uuid.uuid4().hex}"
    ann, _dead = AL.normalise(FD.read_feed(spark, FD.write_feed(_events(spark, sf_dir), 4)))
    store = Store(spark, f"{base}/tagger")
    RT.retrain_stream(AL.pool_stream(ann), base, train_all=RT.tagger_trainer(store)).awaitTermination()
    status = RT.read_table(spark, base, "status", RT.STATUS)
    rows = RT.read_table(spark, base, "emitted", RT.EMITTED).groupBy(*RT.KEYS).agg(F.count(F.lit(1)).alias("n_rows"))
    return status.join(rows, RT.KEYS).select(*RT.KEYS, "version", "status", "n_rows")


@query("stream_label_counts", with_ctes(f"""
WITH t AS (SELECT *, regexp_extract(text, '[\\p{{L}}\\p{{N}}_]+|[^\\s]') AS first FROM chat
           WHERE {trim('text')} <> ''),
l AS (SELECT {tag_sql('first', '1')} AS label FROM t
      WHERE role IN ('user', 'assistant') AND NOT (conv_id % 10 = 5 AND turn = 1)
      UNION ALL SELECT 'X' FROM t WHERE role IN ('user', 'assistant') AND NOT (conv_id % 10 = 5 AND turn = 1)
      UNION ALL SELECT 'X' FROM t WHERE conv_id % 13 = 0)
SELECT label, count(*)::BIGINT AS n FROM l WHERE label IS NOT NULL GROUP BY label""", "chat"))
def stream_label_counts(spark, sf_dir):
    """STM-08: incremental label counts over the streamed annotations (complete mode)."""
    path = FD.write_feed(_events(spark, sf_dir), 4)
    ann, _dead = AL.normalise(FD.read_feed(spark, path))
    return FD.run_available(AL.label_counts(ann), mode="complete")


@query("import_events_flatten", with_ctes(f"""
SELECT * FROM (SELECT conv_id * 1000 + 980 AS event_seq,
                      (row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1)::INTEGER AS sub,
                      conv_id // 100 AS project, text, 1 AS n_spans, false AS dead
               FROM chat WHERE conv_id % 13 = 0) WHERE {trim('text')} <> ''
UNION ALL
SELECT conv_id * 1000 + turn * 2, 0, conv_id // 100, NULL, 0, true
FROM conversations WHERE conv_id % 10 = 5 AND turn = 1 AND role IN ('user', 'assistant')""", "chat"))
def import_events_flatten(spark, sf_dir):
    """STM-02 on import bundles: first annotation of every imported task, plus dead letters."""
    ann, dead = AL.normalise(_events(spark, sf_dir))
    imp = ann.filter(F.col("event") == AL.IMPORT_EVENT).select(
        "event_seq", "sub", "project", "text", F.size("spans").alias("n_spans"), F.lit(False).alias("dead"))
    bad = dead.select("event_seq", F.lit(0).alias("sub"), "project", F.lit(None).cast("string").alias("text"),
                      F.lit(0).alias("n_spans"), F.lit(True).alias("dead"))
    return imp.unionByName(bad)


_POOL_SQL = f"""
WITH RECURSIVE ev AS (
  SELECT conv_id // 100 AS project, conv_id, turn, text,
         row_number() OVER (PARTITION BY conv_id // 100 ORDER BY conv_id, turn) AS i
  FROM chat WHERE role IN ('user', 'assistant') AND NOT (conv_id % 10 = 5 AND turn = 1) AND {trim('text')} <> ''),
st AS (
  SELECT DISTINCT project, 0::BIGINT AS i, []::VARCHAR[] AS pool, 0::BIGINT AS next_batch, 0::BIGINT AS batch_id,
         false AS admitted FROM ev
  UNION ALL
  SELECT e.project, e.i, CASE WHEN list_contains(pool, e.text) THEN pool WHEN len(pool) >= 24 THEN []
                              ELSE list_append(pool, e.text) END,
         CASE WHEN NOT list_contains(pool, e.text) AND len(pool) >= 24 THEN next_batch + 1 ELSE next_batch END,
         next_batch, NOT list_contains(pool, e.text)
  FROM st JOIN ev e ON e.project = st.project AND e.i = st.i + 1),
n AS (SELECT project, max(next_batch) AS n FROM st GROUP BY project)"""


@query("pool_admission", with_ctes(_POOL_SQL + """
SELECT project, conv_id, turn, CASE WHEN admitted AND batch_id < n THEN batch_id END AS batch_id,
       CASE WHEN NOT admitted THEN 'rejected' WHEN batch_id < n THEN 'emitted' ELSE 'pooled' END AS status
FROM st JOIN ev USING (project, i) JOIN n USING (project)""", "chat"))
def pool_admission(spark, sf_dir):
    """JOIN-12 + STM-03/04: what the streamed pool does with each annotation (no control events): a text in the pool
    is rejected, 25 admitted ones are emitted, the incomplete tail stays pooled."""
    ev = _events(spark, sf_dir).filter(F.col("event").isin(*AL.COLLECT_EVENTS))
    ann, _dead = AL.normalise(FD.read_feed(spark, FD.write_feed(ev, 4)))
    rows = FD.run_available(AL.admission_stream(ann))
    full = rows.filter("admitted").groupBy("project").agg(F.floor(F.count(F.lit(1)) / AL.POOL_THRESHOLD).alias("full"))
    out = F.col("admitted") & (F.col("batch_id") < F.col("full"))
    return rows.join(full, "project").select(
        "project", F.floor(F.col("event_seq") / 1000).alias("conv_id"),
        (F.col("event_seq") % 1000 / 2).cast("bigint").alias("turn"), F.when(out, F.col("batch_id")).alias("batch_id"),
        F.when(~F.col("admitted"), "rejected").when(out, "emitted").otherwise("pooled").alias("status"))


@query("pool_snapshot", with_ctes(_POOL_SQL + """
SELECT project, n AS next_batch, row_number() OVER (PARTITION BY project ORDER BY i)::INTEGER AS pos, conv_id, turn, text
FROM st JOIN ev USING (project, i) JOIN n USING (project) WHERE admitted AND batch_id = n""", "chat"))
def pool_snapshot(spark, sf_dir):
    """SNK-07 + STM-05: the rows that wait in the pools after the feed (no control events), read from the query's state."""
    ev = _events(spark, sf_dir).filter(F.col("event").isin(*AL.COLLECT_EVENTS))
    ann, _dead = AL.normalise(FD.read_feed(spark, FD.write_feed(ev, 4)))
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pool-{uuid.uuid4().hex}"
    FD.run_available(AL.pool_stream(ann), base=base)
    return AL.pool_snapshot(spark, f"{base}/checkpoint").select(
        "project", "next_batch", "pos", F.floor(F.col("event_seq") / 1000).alias("conv_id"),
        (F.col("event_seq") % 1000 / 2).cast("bigint").alias("turn"), "text")
