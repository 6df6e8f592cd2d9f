"""Sinks (SNK-01..08).  Every writer is a plain DataFrameWriter call on a
distributed DataFrame; nothing is gathered on the driver."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.annotate import write_conllu  # noqa: F401  (SNK-02)


def write_lines(df: DataFrame, text_col: str, path: str, order: list[str] | None = None) -> None:
    """SNK-01: one sentence per line (ordered within files when ``order`` is given)."""
    out = df.sortWithinPartitions(*order) if order else df
    out.select(F.col(text_col).alias("value")).write.mode("overwrite").text(path)


def write_tagged_json(df: DataFrame, path: str, split_col: str = "split") -> None:
    """SNK-03: ``{tokens, tags}`` JSON lines, one folder per split."""
    df.select(split_col, "tokens", "tags").write.mode("overwrite").partitionBy(split_col).json(path)


def write_encoded(df: DataFrame, path: str, drop=("text",)) -> None:
    """SNK-04: encoded columns as Parquet, raw text dropped."""
    df.drop(*drop).write.mode("overwrite").parquet(path)


def write_vocab(vocab: DataFrame, path: str) -> None:
    """SNK-05 / SNK-08: ``token → id`` (or label map) as JSON lines."""
    vocab.write.mode("overwrite").json(path)


def append_runs(runs: DataFrame, path: str, partition_by: str = "experiment", key: str = "run_id") -> None:
    """SNK-06: append run-log rows (partitioned by experiment, so run scans prune).

    Idempotent per run: runs that the log has already are left out, so an append that is tried again adds nothing
    twice.  Of several rows of one new run the first by all columns is written.  One writer at a time.
    """
    spark = runs.sparkSession
    plain = [c for c, t in runs.dtypes if not t.startswith("map")]
    first = runs.withColumn("_row", F.struct(*plain)).groupBy(partition_by, key) \
        .agg(F.min_by(F.struct(*runs.columns), "_row").alias("r")).select("r.*")
    log = run_log(spark, path, runs)
    if log is not None:
        first = first.join(log.select(partition_by, key), [partition_by, key], "left_anti")
    first.select(*runs.columns).write.mode("append").partitionBy(partition_by).parquet(path)


def run_log(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame | None:
    """The stored run log; None where nothing was written yet.  Filters on the experiment prune its folders."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return (spark.read.schema(like.schema) if like is not None else spark.read).parquet(path)
