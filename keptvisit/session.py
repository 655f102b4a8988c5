"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(master: str | None = None, **extra: str) -> SparkSession:
    """A session with this package's SQL settings; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName("keptvisit")
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def use_checkpoints(spark: SparkSession) -> None:
    """Make sure a reliable checkpoint folder is set.

    The folder is the cluster's own `spark.checkpoint.dir`. Only a local master
    may fall back to a folder of this machine: a cluster's executors cannot
    read one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="keptvisit-checkpoint-")
    context.setCheckpointDir(folder)


# The folder of the job that is under way, if it has one of its own.
_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a work table in the shared checkpoint folder."""
    use_checkpoints(spark)
    folder = _job_folder.get() or spark.sparkContext.getCheckpointDir()
    return f"{folder}/{name}-{uuid.uuid4().hex}"


@contextmanager
def work_tables(spark: SparkSession) -> Iterator[str]:
    """Work tables made inside the block share one folder, which is dropped at its end.

    Results must be written or counted inside the block: a DataFrame that reads a work
    table cannot be run after it. If the block fails the folder stays, so that a
    replacement that stopped half way can be finished from it.
    """
    folder = scratch_path(spark, "job")
    token = _job_folder.set(folder)
    try:
        yield folder
    finally:
        _job_folder.reset(token)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_out(frame: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder once and go on from the files.

    A column such as the partition id keeps its value from then on, also when
    executors are lost.
    """
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def together(spark: SparkSession, jobs: list[Callable]) -> list:
    """The results of calls that run at the same time, in their order.

    Spark's tasks of all of them share the cores, so that one call's planning and its last
    tasks do not leave them idle.
    """
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        started = [pool.submit(copy_context().run, inheritable_thread_target(spark)(job)) for job in jobs]
    return [job.result() for job in started]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Rows that one task of a sort or window may hold.
TASK_ROWS = 200_000


def by_key(frame: DataFrame, rows: int, *keys: str, per_task: int | None = None) -> DataFrame:
    """`frame`, which has so many rows, dealt by keys to as many tasks as keep each at about `per_task`.

    Where the session's shuffle partitions are enough, joins and windows deal the rows themselves.
    """
    parts = -(-rows // (per_task or TASK_ROWS))
    return frame.repartition(parts, *keys) if parts > shuffle_partitions(frame.sparkSession) else frame
