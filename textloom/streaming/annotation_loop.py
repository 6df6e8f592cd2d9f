"""Annotation event loop on Structured Streaming (STM-01..08, JOIN-12, SNK-07).

Events arrive as JSON payloads (three accepted shapes plus an import bundle).
``normalise`` turns them into (text, spans) rows — malformed payloads go to a
dead-letter stream.  ``pool_stream`` keeps, per project, a pool of admitted
annotations in keyed state: a text already in the pool is rejected, the pool
is emitted as one training batch when it reaches the threshold (or when a
forced START_TRAINING finds at least ``force_min`` rows) and is then cleared;
CLEAR_POOL empties it.  State lives in the checkpoint, so a restarted query
resumes with its pool.  Events of one project are applied in arrival order
(``event_seq``), which is what makes the pool semantics sequential per
project; different projects run in parallel.
"""

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from textloom.functions import text as T

# Event names the loop reacts to (others are ignored).
COLLECT_EVENTS = ("ANNOTATION_CREATED", "ANNOTATION_UPDATED")
IMPORT_EVENT = "PROJECT_IMPORT_DONE"   # stand-in name for an import bundle
TRAIN_EVENT = "START_TRAINING"
CLEAR_EVENT = "CLEAR_POOL"
POOL_THRESHOLD = 25
FORCE_MIN = 3

EVENT_SCHEMA = "event_seq long, project long, event string, payload string"

_SPAN = "struct<value:struct<start:int,end:int,labels:array<string>>>"
_SHAPE = (f"struct<annotation:struct<result:array<{_SPAN}>>, task:struct<data:struct<text:string>>, "
          f"result:array<{_SPAN}>, tasks:array<struct<data:struct<text:string>, "
          f"annotations:array<struct<result:array<{_SPAN}>>>>>>")


def normalise(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """STM-01 + STM-02: route and normalise payloads.

    Returns (annotations, dead_letters).  annotations: event_seq, sub, project,
    event, text, spans (array<struct<start,end,label>>, label = first label);
    control events (train/clear) pass with null text.  Import bundles yield the
    first annotation of every task.  Rows with blank text or no labelled spans
    are skipped; payloads matching no shape are dead letters.
    """
    is_list = F.trim(F.col("payload")).startswith("[")
    items = F.when(is_list, F.from_json("payload", f"array<{_SHAPE}>")) \
        .otherwise(F.array(F.from_json("payload", _SHAPE)))
    ev = events.select("event_seq", "project", "event", "payload", items.alias("items"))
    collect = ev.filter(F.col("event").isin(*COLLECT_EVENTS)).select(
        "event_seq", "project", "event", "payload", F.posexplode_outer("items").alias("sub", "it"))
    text = F.col("it.task.data.text")
    result = F.coalesce(F.col("it.annotation.result"), F.col("it.result"))
    imp = ev.filter(F.col("event") == IMPORT_EVENT).select(
        "event_seq", "project", "event", "payload",
        F.posexplode_outer(F.col("items")[0]["tasks"]).alias("sub", "tk"))
    imp_rows = imp.select("event_seq", "sub", "project", "event", "payload",
                          F.col("tk.data.text").alias("text"), F.col("tk.annotations")[0]["result"].alias("result"))
    rows = collect.select("event_seq", "sub", "project", "event", "payload", text.alias("text"),
                          result.alias("result")).unionByName(imp_rows)
    good_shape = F.col("text").isNotNull() | F.col("result").isNotNull()
    dead = rows.filter(~good_shape).select("event_seq", "project", "event", "payload")
    spans = F.filter(F.transform("result", lambda r: F.struct(
        r["value"]["start"].alias("start"), r["value"]["end"].alias("end"),
        F.element_at(r["value"]["labels"], 1).alias("label"))), lambda s: s["label"].isNotNull())
    ann = (rows.filter(good_shape).select("event_seq", "sub", "project", "event", "text", spans.alias("spans"))
           .filter((T.utrim(F.coalesce(F.col("text"), F.lit(""))) != "") & (F.size("spans") > 0)))
    control = events.filter(F.col("event").isin(TRAIN_EVENT, CLEAR_EVENT)).select(
        "event_seq", F.lit(0).alias("sub"), "project", "event", F.lit(None).cast("string").alias("text"),
        F.lit(None).cast("array<struct<start:int,end:int,label:string>>").alias("spans"))
    return ann.unionByName(control), dead


POOL_OUT = ("project long, batch_id long, event_seq long, sub int, text string, label_json string, "
            "forced boolean")
ADMISSION_OUT = "project long, event_seq long, sub int, batch_id long, admitted boolean"
POOL_STATE = "pool string, next_batch long"


class Pool:
    """The rows of one project that wait for training: at most ``threshold``, whatever the history is."""

    def __init__(self, rows: list | None = None, next_batch: int = 0):
        self.rows = rows or []
        self.next_batch = next_batch

    def admit(self, row: tuple) -> bool:
        """Take (event_seq, sub, text, label_json) unless its text is in the pool just now."""
        if any(r[2] == row[2] for r in self.rows):
            return False
        self.rows.append(row)
        return True

    def flush(self) -> list:
        rows, self.rows = self.rows, []
        self.next_batch += 1
        return rows


def _pool_step(threshold: int, force_min: int, report: bool):
    """State step of one project.  Emits flushed batches, or with ``report`` a row per annotation: the batch it
    waits for and whether it was admitted."""

    def step(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        raw, next_batch = state.get if state.exists else ("[]", 0)
        pool, out = Pool([tuple(r) for r in json.loads(raw)], next_batch), []

        def flush(forced):
            batch = pool.next_batch
            rows = pool.flush()
            if not report:
                out.extend((key[0], batch, *r, forced) for r in rows)

        # A project's rows of one trigger, which the feed bounds.
        for r in pd.concat(list(pdfs), ignore_index=True).sort_values(["event_seq", "sub"]).itertuples(index=False):
            if r.event == CLEAR_EVENT:
                pool.rows = []
            elif r.event == TRAIN_EVENT:
                if len(pool.rows) >= force_min:
                    flush(True)
            else:
                spans = [{"start": int(s["start"]), "end": int(s["end"]), "labels": [s["label"]]} for s in r.spans]
                admitted = pool.admit((int(r.event_seq), int(r.sub), r.text, json.dumps(spans)))
                if report:
                    out.append((key[0], int(r.event_seq), int(r.sub), pool.next_batch, admitted))
                if len(pool.rows) >= threshold:
                    flush(False)
        state.update((json.dumps(pool.rows), pool.next_batch))
        names = [c.split()[0] for c in (ADMISSION_OUT if report else POOL_OUT).split(", ")]
        yield pd.DataFrame(out, columns=names)

    return step


def pool_stream(annotations: DataFrame, threshold: int = POOL_THRESHOLD, force_min: int = FORCE_MIN
                ) -> DataFrame:
    """STM-03 + STM-04 + STM-05: per-project keyed pool; emits each flushed batch."""
    return annotations.groupBy("project").applyInPandasWithState(
        _pool_step(threshold, force_min, False), POOL_OUT, POOL_STATE, "append", GroupStateTimeout.NoTimeout)


def admission_stream(annotations: DataFrame, threshold: int = POOL_THRESHOLD, force_min: int = FORCE_MIN) -> DataFrame:
    """JOIN-12: which annotations the pool admits (a text may come back once the pool is emptied)."""
    return annotations.groupBy("project").applyInPandasWithState(
        _pool_step(threshold, force_min, True), ADMISSION_OUT, POOL_STATE, "append", GroupStateTimeout.NoTimeout)


def pool_snapshot(spark: SparkSession, checkpoint: str) -> DataFrame:
    """SNK-07: what waits in the pools of a (finished or running) query, read from its state with the state data source:
    project, next_batch, pos (from 1), event_seq, sub, text, label_json."""
    state = spark.read.format("statestore").load(checkpoint)
    rows = state.select(F.col("key.project").alias("project"), F.col("value.groupState.*"))
    # An entry of the stored pool is an array of its four values.
    entries = F.from_json("pool", "array<array<string>>")
    one = rows.select("project", "next_batch", F.posexplode(entries).alias("pos", "e"))
    return one.select("project", "next_batch", (F.col("pos") + 1).alias("pos"), F.col("e")[0].cast("long").alias("event_seq"),
                      F.col("e")[1].cast("int").alias("sub"), F.col("e")[2].alias("text"), F.col("e")[3].alias("label_json"))


def label_counts(annotations: DataFrame) -> DataFrame:
    """STM-08: running count per label over all collected spans (streaming aggregate)."""
    return (annotations.filter(F.col("spans").isNotNull())
            .select(F.explode("spans").alias("s")).groupBy(F.col("s.label").alias("label"))
            .agg(F.count(F.lit(1)).alias("n")))
