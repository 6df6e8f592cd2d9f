"""Session defaults, table loading and lineage cutting.

Everything here is plain SparkSession configuration.  Cluster deployments
pass their own settings (shuffle partitions, checkpoint dir); the helpers only
fill gaps, never override what the session already carries.
"""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Session settings that matter for the operators in this package.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only below a fixed bound; anything larger takes a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_session(master: str | None = None, app: str = "textloom",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session or build a local one for tests/benchmarks."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.driver.memory", os.environ.get("TEXTLOOM_DRIVER_MEM", "16g"))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; in a single-JVM session set a scratch one when unset.

    On a cluster the folder must be shared by driver and executors, so there an unset one is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="textloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table under ``spark.checkpoint.dir`` and read it back.

    One pass (an RDD checkpoint computes its input twice unless cached), stored
    on the shared checkpoint filesystem, so it survives executor loss and cuts
    the lineage of iterative jobs.
    """
    base = ensure_checkpoint_dir(df.sparkSession)
    path = f"{base.rstrip('/')}/textloom-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


class Scratch:
    """Tables in the shared checkpoint folder that are needed only until a result is stored."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
        self.count = 0

    def stored(self, df: DataFrame) -> DataFrame:
        self.count += 1
        df.write.parquet(f"{self.path}/{self.count}")
        return self.spark.read.parquet(f"{self.path}/{self.count}")

    def clear(self) -> None:
        """Delete the tables; nothing that is still to run may read them."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def first_rows(df: DataFrame, n: int, *order) -> list:
    """The first ``n`` rows in an order, to the driver.  One task picks them from those of the others: with a plain
    ``collect`` every task would send its own first ``n`` to the driver."""
    return df.orderBy(*order).limit(n).repartition(1).sortWithinPartitions(*order).collect()


BATCH_ROWS = 1000  # texts that Spark hands to a Python worker at a time, unless the session asks for fewer


def small_batches(spark: SparkSession) -> None:
    """Bound what a task holds of the texts on their way to and from Python: Spark's 10,000 rows a batch are made for
    short rows, and several tasks share an executor's memory."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """The rows dealt to the session's tasks by their key.  One task reads a row group, and a table's file may have few of
    them; without a shuffle, work that is far more costly than reading would stay in these few tasks."""
    return df.repartition(key)


def at_once(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What steps return that do not need each other, each run as Spark jobs of its own thread.  All have ended when the
    first error, if any, is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [step.result() for step in running]


def stored_for(df: DataFrame, name: str) -> str:
    """A folder under the checkpoint folder for what is derived from the files behind ``df`` (told apart by their paths,
    sizes and times), so that queries over the same files share it."""
    files = df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct().collect()
    key = hashlib.md5("|".join(sorted(str(tuple(r)) for r in files)).encode()).hexdigest()
    return f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{key}"


class Tables:
    """Attribute access to the driver tables of one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``textloom`` importable in Python workers (UDFs pickle its functions by
    reference): zip the package once per SparkContext and ``addPyFile`` it, which
    distributes it to every executor regardless of their working directory."""
    import os
    import zipfile
    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="textloom-pkg-"), "textloom.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)
