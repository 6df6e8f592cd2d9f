"""Retraining on emitted pool batches (STM-04, STM-06, SNK-07): a ``foreachBatch`` job with a status table.

Everything lives in one folder on the shared file system:

    emitted/       rows of every batch that left the pool, by trigger
    pending/       rows of the batches that were not finished at the end of a trigger, by trigger
    log/           status: one row per attempt (project, batch_id, version, 'done' | 'failed', error), by trigger;
                   versions: one row per change (project, version, 'new' | 'deleted'); an attempt writes both at once
    corpus/        CoNLL-U files per project and batch
    models/        what the trainer writes, one folder per project and version

A batch is finished when its status is 'done'.  Until then its rows are carried from trigger to trigger and tried
again (also after a restart), so a failed training loses nothing.  A trigger reads its own rows and the pending ones of
the trigger before, never the history.  A micro-batch that Spark delivers twice overwrites its rows and skips the batches
that its first delivery finished.

All pending batches of a trigger are trained together, in a fixed number of Spark jobs.  If that fails, each half of them
is tried, down to single batches, so that one bad batch holds up no other and a few cost few attempts.  A trainer that
takes one batch at a time (``train``) gets a loop.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.operators import annotate as A
from textloom.operators import runs as R
from textloom.operators import taggers as TG
from textloom.session import at_once, cut_lineage
from textloom.sources.store import Store

EMITTED = "project long, batch_id long, event_seq long, sub int, text string, label_json string, forced boolean"
STATUS = "project long, batch_id long, version long, status string, error string"
VERSIONS = "project long, version long, status string"
PLAN = "project long, batch_id long, version long, status string"
FAILURES = (PySparkException, Py4JError, ValueError)
KEYS = ["project", "batch_id"]
SENT = ["project", "batch_id", "event_seq", "sub"]


def read_table(spark: SparkSession, base: str, name: str, schema: str, epoch: int | None = None) -> DataFrame:
    """One of the job's tables (of one trigger, or of all); empty as long as nothing was written to it."""
    path = f"{base}/log/table={name}" if name in ("status", "versions") else f"{base}/{name}"
    path += "" if epoch is None else f"/epoch={epoch}"
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*[c.split()[0] for c in schema.split(", ")])


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def _unfinished(rows: DataFrame, status: DataFrame) -> DataFrame:
    done = status.filter("status = 'done'").select(*KEYS).distinct()
    return rows.dropDuplicates(SENT).join(done, KEYS, "left_anti")


def pending(spark: SparkSession, base: str) -> DataFrame:
    """Emitted rows of batches that are not finished, over the whole history."""
    return _unfinished(read_table(spark, base, "emitted", EMITTED), read_table(spark, base, "status", STATUS))


def due(spark: SparkSession, base: str, epoch: int) -> DataFrame:
    """What a trigger has to train: its own rows and those that the trigger before left, but for finished batches."""
    rows = read_table(spark, base, "emitted", EMITTED, epoch) \
        .unionByName(read_table(spark, base, "pending", EMITTED, epoch - 1))
    return _unfinished(rows, read_table(spark, base, "status", STATUS, epoch))


def _record(base: str, epoch: int, status: DataFrame, versions: DataFrame | None = None) -> None:
    """Append to both logs in one write, so that neither is there without the other."""
    rows = status.withColumn("table", F.lit("status"))
    if versions is not None:
        rows = rows.unionByName(versions.withColumn("table", F.lit("versions")), allowMissingColumns=True)
    rows.withColumn("epoch", F.lit(epoch)).write.mode("append").partitionBy("table", "epoch").parquet(f"{base}/log")


def labelled_tokens(rows: DataFrame) -> DataFrame:
    """SRC-05 + JOIN-02: tokens of the rows' texts with the label of their span."""
    return A.span_labels(rows, SENT, "text", "label_json")


def _said(e: Exception) -> str:
    return f"{type(e).__name__}: {str(e)[:500]}"


def _blocks(tokens: DataFrame, rows: DataFrame) -> DataFrame:
    sid = F.concat_ws("-", "event_seq", "sub")
    return A.to_conllu_blocks(tokens.join(rows.select(*SENT, "text"), SENT), SENT, sid, F.col("text"),
                              upos_col="label")


def write_corpus(tokens: DataFrame, rows: DataFrame, path: str) -> None:
    """SNK-02 of one batch."""
    A.write_conllu(_blocks(tokens, rows), path)


def write_corpora(tokens: DataFrame, rows: DataFrame, path: str) -> None:
    """SNK-02 of many batches: the files that ``write_corpus`` makes of each; those of earlier attempts are replaced."""
    _blocks(tokens, rows).select(F.concat("block", F.lit("\n")).alias("value"), "project",
                                 F.col("batch_id").alias("batch")) \
        .repartition("project", "batch").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .option("lineSep", "\n").partitionBy("project", "batch").text(path)


def alive_versions(spark: SparkSession, base: str) -> DataFrame:
    log = read_table(spark, base, "versions", VERSIONS)
    return log.groupBy("project", "version").agg(F.max((F.col("status") == "deleted").cast("int")).alias("gone")) \
        .filter("gone = 0").select("project", "version")


def plan_versions(todo: DataFrame, alive: DataFrame, keep_after: int) -> DataFrame:
    """WIN-08 for many batches: what ``runs.retention`` gives when a project's batches come one after the other.

    Output: project, batch_id, version, status ('new', or 'deleted' with a null batch_id).  A group holds the numbers of
    a project's versions and pending batches.
    """
    def plan(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        have = sorted(pdf["version"].dropna().astype(int))
        out = []
        for batch_id in sorted(pdf["batch_id"].dropna().astype(int)):
            new = (have[-1] if have else 0) + 1
            if len(have) >= keep_after:
                out += [(key[0], None, v, "deleted") for v in have[:-1]]
                have = have[-1:]
            have.append(new)
            out.append((key[0], batch_id, new, "new"))
        return pd.DataFrame(out, columns=["project", "batch_id", "version", "status"]).astype({"batch_id": "Int64"})

    none = F.lit(None).cast("long")
    both = todo.select(*KEYS, none.alias("version")) \
        .unionByName(alive.select("project", none.alias("batch_id"), "version"))
    return both.groupBy("project").applyInPandas(plan, PLAN)


def retrain_all(spark: SparkSession, base: str, train_all: Callable[[DataFrame, str], None], keep_after: int = 2,
                epoch: int | None = None) -> None:
    """Try all batches that a trigger has to train (without one: all pending ones) together, and if that fails, those of
    the first half and those of the second, and so on; a batch that fails alone is recorded as failed."""
    rows = cut_lineage(pending(spark, base) if epoch is None else due(spark, base, epoch))
    epoch = -1 if epoch is None else epoch
    todo = rows.select(*KEYS).distinct()
    if todo.isEmpty():
        return
    if _attempt(spark, base, epoch, rows, train_all, keep_after) is None:
        return
    keys = [(r["project"], r["batch_id"]) for r in todo.orderBy(*KEYS).collect()]
    left = _halves(keys) or [keys]
    while left:
        some = left.pop(0)
        low, high = (F.struct(*[F.lit(v).cast("long").alias(k) for k, v in zip(KEYS, key, strict=True)])
                     for key in (some[0], some[-1]))
        part = rows.filter(F.struct(*KEYS).between(low, high))
        error = _attempt(spark, base, epoch, part, train_all, keep_after)
        if error is not None and len(some) > 1:
            left = _halves(some) + left  # oldest first
        elif error is not None:
            plan = plan_versions(part.select(*KEYS).distinct(), alive_versions(spark, base), keep_after)
            _record(base, epoch, plan.filter("status = 'new'").select(
                *KEYS, "version", F.lit("failed").alias("status"), F.lit(error).alias("error")))


def _halves(keys: list) -> list[list]:
    half = len(keys) // 2
    return [keys[:half], keys[half:]] if half else []


def _attempt(spark: SparkSession, base: str, epoch: int, rows: DataFrame,
             train_all: Callable[[DataFrame, str], None], keep_after: int) -> str | None:
    """Corpus, models, versions and status of the batches of ``rows``; what went wrong, if anything."""
    plan = cut_lineage(plan_versions(rows.select(*KEYS).distinct(), alive_versions(spark, base), keep_after))
    new = plan.filter("status = 'new'").select(*KEYS, "version")
    try:
        tokens = cut_lineage(labelled_tokens(rows))
        write_corpora(tokens, rows, f"{base}/corpus")
        train_all(tokens.join(new, KEYS), f"{base}/models")
    except FAILURES as e:
        return _said(e)
    _record(base, epoch, new.select(*KEYS, "version", F.lit("done").alias("status"),
                                    F.lit(None).cast("string").alias("error")),
            plan.select("project", "version", "status"))
    return None


def retrain_once(spark: SparkSession, base: str, train: Callable[[DataFrame, str], None], keep_after: int = 2,
                 epoch: int | None = None) -> None:
    """Try every batch that is due by itself, oldest first; a dozen Spark jobs for each."""
    rows = cut_lineage(pending(spark, base) if epoch is None else due(spark, base, epoch))
    epoch = -1 if epoch is None else epoch
    for key in rows.select(*KEYS).distinct().orderBy(*KEYS).collect():
        project, batch_id = key["project"], key["batch_id"]
        one = rows.filter((F.col("project") == project) & (F.col("batch_id") == batch_id))
        known = alive_versions(spark, base).filter(F.col("project") == project).select("project", F.col("version").cast("string").alias("name")) \
            .unionByName(spark.range(1).select(F.lit(project).cast("long").alias("project"),
                                               F.lit("none").alias("name")))
        plan = R.retention(known, "project", "name", keep_after).collect()
        version = next(r["version"] for r in plan if r["status"] == "new")
        error = None
        try:
            tokens = labelled_tokens(one)
            write_corpus(tokens, one, f"{base}/corpus/project={project}/batch={batch_id}")
            train(tokens, f"{base}/models/project={project}/v{version}")
        except FAILURES as e:
            error = _said(e)
        changes = [(project, r["version"], r["status"]) for r in plan if r["status"] != "kept"]
        _record(base, epoch, spark.createDataFrame(
            [(project, batch_id, version, "failed" if error else "done", error)], STATUS),
            None if error else spark.createDataFrame(changes, VERSIONS))


def label_model(tokens: DataFrame, path: str) -> None:
    """A small default trainer: the counts of each label per word form (the tagger of ``taggers`` fits the same
    signature)."""
    tokens.groupBy(F.lower("form").alias("form"), "label").agg(F.count(F.lit(1)).alias("n")) \
        .write.mode("overwrite").parquet(path)


def label_models(tokens: DataFrame, path: str) -> None:
    """``label_model`` of many batches, one folder per project and version.  All cores but one write them; the last is for
    the jobs of a fit that runs meanwhile, which would else wait for all files."""
    tasks = max(1, tokens.sparkSession.sparkContext.defaultParallelism - 1)
    tokens.groupBy("project", "version", F.lower("form").alias("form"), "label").agg(F.count(F.lit(1)).alias("n")) \
        .repartition(tasks, "project", "version").write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("project", "version").parquet(path)


def tagger_trainer(store: Store, **options) -> Callable[[DataFrame, str], None]:
    """ML-06 refitted on what a trigger trains: a new current version of the tagger in ``store`` (which batch scoring
    loads), beside the label counts of each batch.  Like any fit of that tagger, it counts labels, terms and document
    frequencies over all rows and fits the regression on all of them, too."""

    def train_all(tokens: DataFrame, path: str) -> None:
        spark = tokens.sparkSession
        in_order = F.array_sort(F.collect_list(F.struct("tok_idx", "form", "label")))
        sents = tokens.groupBy(*SENT).agg(in_order.alias("t")).select(
            *SENT, F.lit("train").alias("split"), F.transform("t", lambda x: x["form"]).alias("tokens"),
            F.transform("t", lambda x: x["label"]).alias("tags"))
        rows = cut_lineage(TG.token_rows(sents, SENT))
        most_terms, ngram = (options.get(k, TG.BASE[k]) for k in ("max_features", "ngram"))
        # The iterations of the fit are short jobs, so the files of the counts are written beside them.
        corpus, sample = at_once(spark, lambda: TG.corpus_features(rows, ngram, most_terms), lambda: TG.learnt_rows(
            TG.labelled_sample(rows, options.get("most_rows")), ngram))
        at_once(spark, lambda: label_models(tokens, path), lambda: TG.save_logreg(
            store, TG.fit_logreg(rows, corpus=corpus, sample=sample, **options), path))

    return train_all


def retrain_stream(batches: DataFrame, base: str, train: Callable[[DataFrame, str], None] | None = None,
                   keep_after: int = 2, train_all: Callable[[DataFrame, str], None] = label_models) -> StreamingQuery:
    """Run the job over the stream of emitted batches; a restart with the same folder goes on where it was.

    ``train(tokens, path)`` gets one batch and its folder; without it ``train_all(tokens, path)`` gets all batches of a
    trigger, told apart by project and version, and the folder of all models.
    """

    def sink(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{base}/emitted/epoch={epoch}")
        if train is None:
            retrain_all(spark, base, train_all, keep_after, epoch)
        else:
            retrain_once(spark, base, train, keep_after, epoch)
        due(spark, base, epoch).write.mode("overwrite").parquet(f"{base}/pending/epoch={epoch}")

    return batches.writeStream.outputMode("append").foreachBatch(sink) \
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
