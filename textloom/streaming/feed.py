"""Annotation event stand-in (FIXTURES C.7) and a replayable file feed (SRC-13)."""

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.session import cut_lineage, ensure_checkpoint_dir
from textloom.streaming import annotation_loop as AL

PROJECT_CONVERSATIONS = 100
ROWS_PER_CHUNK = 200_000
CHUNKS, FILES_PER_CHUNK = 4, 8  # at least, at most
SEQ_STEP = 1000  # events of one conversation stay in one chunk


def _span(start, end, label):
    return F.struct(F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"),
                             F.array(label).alias("labels")).alias("value"))


def annotation_events(conversations: DataFrame) -> DataFrame:
    """C.7: conversations in (conv_id, turn) order become labelling-tool events.

    user turn → ANNOTATION_CREATED, assistant → ANNOTATION_UPDATED, system →
    an ignored event; payload shapes rotate (list / {annotation, task} /
    {task, result}); every conversation ≡ 5 (mod 10) has a malformed second
    turn; conversations ≡ 0 mod 13 add an import bundle of all their turns,
    ≡ 0 mod 7 a START_TRAINING and ≡ 0 mod 11 a CLEAR_POOL after their turns.
    project = conv_id div 100, so projects grow with the table.  Conversations ≡ 1 (mod 4) repeat their first text from the third turn on, so that
    the pool has texts to reject and texts that come back.
    """
    from textloom.plans.fixtures import tag_rule
    project = F.floor(F.col("conv_id") / PROJECT_CONVERSATIONS)
    # A window, no join: Spark would broadcast the first texts by the size of their compressed file.
    first_text = F.min_by("text", "turn").over(Window.partitionBy("conv_id"))
    c = conversations.filter(F.col("conv_id").isNotNull()).withColumn("_first", first_text).withColumn("text", F.when(
        (F.col("conv_id") % 4 == 1) & (F.col("turn") >= 2), F.col("_first")).otherwise(F.col("text"))).drop("_first")
    first = F.regexp_extract("text", r"[\p{L}\p{N}_]+|[^\s]", 0)
    spans = F.array(_span(F.lit(0), F.length(first), tag_rule(first, F.lit(1))),
                    _span(F.lit(0), F.length("text"), F.lit("X")))
    task = F.struct(F.struct(F.col("text").alias("text")).alias("data"))
    shape_a = F.to_json(F.struct(F.struct(spans.alias("result")).alias("annotation"), task.alias("task")))
    shape_b = F.to_json(F.struct(task.alias("task"), spans.alias("result")))
    payload = (F.when((F.col("conv_id") % 10 == 5) & (F.col("turn") == 1), F.lit('{"foo": 1}'))
               .when(F.col("turn") % 3 == 0, F.concat(F.lit("["), shape_a, F.lit("]")))
               .when(F.col("turn") % 3 == 1, shape_a).otherwise(shape_b))
    event = (F.when(F.col("role") == "user", "ANNOTATION_CREATED")
             .when(F.col("role") == "assistant", "ANNOTATION_UPDATED").otherwise("MODEL_PING"))
    base = c.select((F.col("conv_id") * 1000 + F.col("turn") * 2).alias("event_seq"),
                    project.alias("project"), event.alias("event"), payload.alias("payload"))
    convs = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    tasks = F.transform("t", lambda x: F.struct(F.struct(x["text"].alias("text")).alias("data"), F.array(
        F.struct(F.array(_span(F.lit(0), F.length(x["text"]), F.lit("X"))).alias("result"))).alias("annotations")))
    imp = convs.filter(F.col("conv_id") % 13 == 0).select(
        (F.col("conv_id") * 1000 + 980).alias("event_seq"), project.alias("project"),
        F.lit(AL.IMPORT_EVENT).alias("event"), F.to_json(F.struct(tasks.alias("tasks"))).alias("payload"))
    ids = convs.select("conv_id")
    train = ids.filter(F.col("conv_id") % 7 == 0).select(
        (F.col("conv_id") * 1000 + 990).alias("event_seq"), project.alias("project"),
        F.lit(AL.TRAIN_EVENT).alias("event"), F.lit("{}").alias("payload"))
    clear = ids.filter(F.col("conv_id") % 11 == 0).select(
        (F.col("conv_id") * 1000 + 995).alias("event_seq"), project.alias("project"),
        F.lit(AL.CLEAR_EVENT).alias("event"), F.lit("{}").alias("payload"))
    out = base.unionByName(imp).unionByName(train).unionByName(clear)
    return out.select(F.col("event_seq").cast("long"), F.col("project").cast("long"), "event", "payload")


def write_feed(events: DataFrame, chunks: int = CHUNKS, rows: int = ROWS_PER_CHUNK) -> str:
    """Write the events as successive Parquet appends (arrival order by event_seq) into a fresh folder under
    ``spark.checkpoint.dir``; returns the folder.  There are ``chunks`` of them, or more where the table is larger: none
    covers much over ``rows`` events, so a project's share of one is bounded, too.
    """
    spark = events.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/feed-{uuid.uuid4().hex}"
    # Events are made once; ordered files let an append read little more than its own range.
    events = cut_lineage(events.repartitionByRange("event_seq").sortWithinPartitions("event_seq"))
    n = events.count()
    chunks = max(chunks, -(-n // rows))
    cuts = events.approxQuantile("event_seq", [k / chunks for k in range(1, chunks)], 0.1 / chunks) if n else []
    bounds = [None, *sorted({int(c) // SEQ_STEP * SEQ_STEP for c in cuts}), None]
    for low, high in zip(bounds, bounds[1:], strict=False):
        part = events
        part = part if low is None else part.filter(F.col("event_seq") >= low)
        part = part if high is None else part.filter(F.col("event_seq") < high)
        # A project's events of a chunk share a file, so they arrive in order; projects are written in parallel.
        part.repartition(FILES_PER_CHUNK, "project").sortWithinPartitions("event_seq").write.mode("append").parquet(path)
    return path


def read_feed(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """SRC-13: the event feed as a stream (file source; Kafka would slot in here).

    By default a trigger takes about a chunk (``ROWS_PER_CHUNK`` events), and there are at least ``CHUNKS`` triggers
    where there are as many files: each has a cost of its own, whatever it reads.  Files come in the order in which they
    were written, so a trigger that ends inside a chunk leaves every project's order as it is.
    """
    if files_per_trigger is None:
        fed = spark.read.schema(AL.EVENT_SCHEMA).parquet(path)
        triggers = max(CHUNKS, -(-fed.count() // ROWS_PER_CHUNK))
        files_per_trigger = max(1, -(-len(fed.inputFiles()) // triggers))
    return (spark.readStream.schema(AL.EVENT_SCHEMA).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(path))


def run_available(df: DataFrame, mode: str = "append", base: str | None = None) -> DataFrame:
    """Run a streaming query to completion (``availableNow``) into a Parquet table under ``base`` (a fresh folder of the
    checkpoint dir by default), with its own checkpoint there; return the table as a batch DataFrame."""
    spark = df.sparkSession
    base = base or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    out, ckpt = f"{base}/out", f"{base}/checkpoint"
    if mode == "complete":
        def sink(batch, _epoch):
            batch.write.mode("overwrite").parquet(out)
        q = (df.writeStream.outputMode("complete").foreachBatch(sink).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
    else:
        q = (df.writeStream.outputMode("append").format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out)
