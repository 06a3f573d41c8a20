"""Session settings and durable storage for intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "ebbtide") -> SparkSession:
    """A session for tests and single-machine runs; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder; elsewhere a missing setting is an error,
    because a machine-local path is lost together with its executor.
    """
    context = spark.sparkContext
    known = context.getCheckpointDir()
    if known:
        return known
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="ebbtide-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch tables of this application and say how many there were;
    for callers that no longer read any result made from them."""
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        removed += bool(at.getFileSystem(conf).delete(at, True))
    return removed


def durable(df: DataFrame) -> DataFrame:
    """Compute once and keep the rows in the shared folder, so that later plans
    read the same rows even when executors have gone."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """The same rows from a new Parquet table in the shared folder: computed once,
    read by columns, and there when executors have gone."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(one: Callable, jobs: Sequence, parallel: int = 8) -> list:
    """``one`` of each job, several at a time, so that the jobs of one fit use the
    cores that those of another leave idle; results in the order of the jobs."""
    if not jobs:
        return []
    session = SparkSession.active()
    with ThreadPool(min(parallel, len(jobs))) as pool:
        return pool.map(inheritable_thread_target(session)(one), jobs, chunksize=1)
