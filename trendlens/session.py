"""Spark session settings and the checkpoint folder used to cut long lineages."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on. Shuffle parallelism is left to AQE: a high initial
# partition number is coalesced at run time, hot partitions of joins are split.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

GUESSED = 1 << 8  # bits of a size in bytes that Spark guesses


def build_session(app: str = "trendlens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the engine defaults; ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``. Only a local master without
    that setting gets a temporary folder; on a cluster a machine-local one would be lost with
    its executor, so that case is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="trendlens-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df``: later rounds of an iteration do not replay earlier ones.

    A checkpoint hands on the size that Spark guesses for its plan, and a join multiplies the sizes of both sides: the digits of
    that number grow exponentially with the rounds, and reckoning with it soon takes minutes. Beyond ``GUESSED`` bits the rows are
    kept as a table instead, whose size is that of its files.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() > GUESSED:
        return stage_table(df, "rounds")
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """New folder name for intermediate files, next to the checkpoints on the shared store."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table on the shared store: for rows that are wide or read often, which a checkpoint wouldn't compress."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a :func:`stage_table` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Give shuffle files and checkpoints that nothing refers to any more back to the disks.

    Spark's cleaner follows the driver's garbage collection, which a job of many small stages may not
    trigger for a long time.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
