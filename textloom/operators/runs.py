"""Run log and leaderboard (WIN-01, JOIN-11, RUN-01..05, WIN-05, WIN-08, PRJ-18..20, SRT-01/04)."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import cut_lineage


def latest_runs(runs: DataFrame, keys=("experiment", "model")) -> DataFrame:
    """WIN-01: newest run per key (start_time, then run_id, descending).

    An aggregate (``max_by``), so it combines map-side and a hot model never
    lands in one task.  The newest run is taken even when it lacks a metric.
    """
    k = list(keys)
    newest = F.max_by(F.struct("run_id", "start_time", "params", "metrics"), F.struct("start_time", "run_id"))
    return runs.groupBy(*k).agg(newest.alias("r")).select(*k, "r.*")


def metric(col: str, key: str):
    return F.try_element_at(F.col(col), F.lit(key))


def leaderboard(models: DataFrame, runs: DataFrame, lm_experiment: str, pos_experiment: str) -> DataFrame:
    """RUN-01 + JOIN-11: one row per configured model with its latest LM and POS metrics.

    ``perplexity_raw`` is the loss value the reference shows under "perplexity";
    ``perplexity`` is exp(loss) (AGG-24).  Sorted by POS accuracy, nulls last (SRT-01).
    """
    latest = latest_runs(runs.filter(F.col("experiment").isin(lm_experiment, pos_experiment)))
    lm = latest.filter(F.col("experiment") == lm_experiment).select(
        "model", metric("metrics", "eval_loss").alias("eval_loss"),
        metric("metrics", "pseudo_perplexity").alias("pseudo_perplexity"),
        metric("metrics", "eval_masked_accuracy").alias("masked_acc"),
        metric("metrics", "eval_masked_top5").alias("top5"),
        metric("metrics", "eval_masked_mrr").alias("mrr"))
    pos = latest.filter(F.col("experiment") == pos_experiment).select(
        "model", metric("metrics", "eval_accuracy").alias("pos_acc"), metric("metrics", "eval_f1").alias("eval_f1"))
    out = models.join(lm, "model", "left").join(pos, "model", "left")
    return out.select("*", F.col("eval_loss").alias("perplexity_raw"),
                      F.exp("eval_loss").alias("perplexity")).orderBy(F.desc_nulls_last("pos_acc"), "model")


DISPLAY_COLS = ["perplexity_raw", "pos_acc", "eval_f1", "pseudo_perplexity", "masked_acc", "top5", "mrr"]


def display_table(board: DataFrame, cols=DISPLAY_COLS) -> DataFrame:
    """RUN-02 / PRJ-19: numeric coerce, round half-even to 4 places, null → '–'.

    Rounding is ``rint(x * 1e4) / 1e4`` on the double, i.e. numpy's ``round``.
    """
    def fmt(c):
        x = F.col(c).cast("string").try_cast("double")
        r = F.rint(x * 10000.0) / 10000.0
        return F.when(x.isNull(), F.lit("–")).otherwise(F.format_string("%.4f", r)).alias(c)
    return board.select("model", *[fmt(c) for c in cols])


def chart_input(board: DataFrame, subset=("perplexity_raw", "pos_acc")) -> DataFrame:
    """RUN-03 / PRJ-18: drop models with none of the plotted metrics."""
    return board.dropna(how="all", subset=list(subset))


def hyperparams(models: DataFrame, runs: DataFrame, experiment: str) -> DataFrame:
    """RUN-04 + SRT-04: latest run's parameters per model sorted by key; a notice row when none."""
    latest = latest_runs(runs.filter(F.col("experiment") == experiment))
    j = models.join(latest.select("model", "params"), "model", "left")
    kv = j.select("model", F.explode_outer(F.map_entries("params")).alias("e"))
    return kv.select("model", F.col("e.key").alias("key"),
                     F.coalesce(F.col("e.value"), F.lit("no runs found")).alias("value")).orderBy("model", "key")


def retention(versions: DataFrame, project: str, name: str, keep_after: int = 2) -> DataFrame:
    """WIN-08: what becomes of each project's versions when one is added.

    Versions are named by a number, with or without a leading ``v``; other names are no versions and are left alone.
    The new version is the largest number plus 1, or 1 for a project without any.  Before it is added, all but the
    newest go if the project has ``keep_after`` versions or more.  Output: project, version, status
    ('kept' | 'deleted' | 'new').  The newest per project is a ``max`` aggregate (map-side combined).
    """
    number = F.regexp_extract(F.col(name), r"^v?([0-9]{1,18})$", 1)
    rows = versions.select(F.col(project).alias("project"), F.when(number != "", number.cast("bigint")).alias("version")) \
        .distinct()
    per = rows.groupBy("project").agg(F.max("version").alias("newest"), F.count("version").alias("n"))
    old = rows.filter(F.col("version").isNotNull()).alias("r").join(
        per.alias("p"), F.col("r.project").eqNullSafe(F.col("p.project")))
    gone = (F.col("n") >= keep_after) & (F.col("version") < F.col("newest"))
    old = old.select("r.project", "version", F.when(gone, "deleted").otherwise("kept").alias("status"))
    new = per.select("project", (F.coalesce("newest", F.lit(0)) + 1).alias("version"), F.lit("new").alias("status"))
    return old.unionByName(new)


def sequence_delta(df: DataFrame, key: str, order: list[str], value: str, num_partitions: int | None = None
                   ) -> DataFrame:
    """WIN-05: ``value - lag(value, 1, 0)`` along ``order`` within ``key``, skew-safe.

    Rows are range-partitioned on (key, order) — a hot key spreads over many
    partitions — and checkpointed to fix partition ids.  The lag inside a
    partition is a window on (partition, key); the first row of a run takes the
    last value of the same key from the closest earlier partition, looked up in
    a table with one row per (partition, key).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ocols = [F.col(key)] + [F.col(c) for c in order]
    tagged = cut_lineage(df.repartitionByRange(n, *ocols).withColumn("_pid", F.spark_partition_id()))
    w = Window.partitionBy("_pid", key).orderBy(*order)
    local = tagged.withColumn("_prev", F.lag(value, 1).over(w))
    last = tagged.groupBy("_pid", key).agg(F.max_by(value, F.struct(*order)).alias("_last"))
    wl = Window.partitionBy(key).orderBy("_pid")
    carry = last.select("_pid", key, F.lag("_last", 1).over(wl).alias("_carry"))
    j = local.join(carry, ["_pid", key], "left")
    prev = F.coalesce(F.col("_prev"), F.col("_carry"), F.lit(0.0))
    return j.withColumn("delta", F.col(value) - prev).drop("_pid", "_prev", "_carry")


def merge_metrics(earlier, later):
    """AGG-28: null-safe map merge where the later map wins on shared keys."""
    a = F.coalesce(earlier, F.create_map().cast("map<string,double>"))
    b = F.coalesce(later, F.create_map().cast("map<string,double>"))
    return F.map_concat(F.map_filter(a, lambda k, v: ~F.array_contains(F.map_keys(b), k)), b)


def metric_log(runs: DataFrame) -> DataFrame:
    """RUN-05: one row per (run, metric key, step); only numeric values exist in the ``metrics`` map, so non-numeric
    values never reach the log.  A key's step counts the runs of its experiment and model that logged it before, in
    the order they were started (an experiment and model is one training series)."""
    rows = runs.select("run_id", "experiment", "model", "start_time", F.explode("metrics").alias("key", "value"))
    series = Window.partitionBy("experiment", "model", "key").orderBy("start_time", "run_id")
    return rows.withColumn("step", F.row_number().over(series) - 1) \
        .select("run_id", "experiment", "key", "step", "value")
