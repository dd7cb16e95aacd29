"""Shared folder of the cluster and durable intermediate tables."""

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_stored: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for checkpoints.

    Only a session on one machine that names none gets a folder of its own; on a cluster a local
    folder would be out of the executors' reach, so a missing setting is an error there.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that driver and executors share")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody used before, below the shared folder; ``clear_scratch`` removes it."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    application = spark.sparkContext.applicationId
    if application not in _stored:
        _stored[application] = []
        atexit.register(_clear_at_exit, spark)
    _stored[application].append(path)
    return path


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: Spark removes them when a write has ended."""
    before = spark.conf.get(CLEANUP_SETTING, "false")
    spark.conf.set(CLEANUP_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP_SETTING, before)


def durable(df: DataFrame, **options) -> DataFrame:
    """Store ``df`` as a table in the shared folder and read it back.

    It is computed once, survives lost executors, and its real size is known to the optimiser: a
    small one is broadcast, a large one is joined by a shuffle where hot keys are split at run time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    with shuffles_end(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The file system Spark uses for ``path``, and its constructor of paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, through the file system that Spark uses for it."""
    system, make = file_system(spark, path)
    system.delete(make(path), True)


def discard(df: DataFrame) -> None:
    """Remove a ``durable`` table that no result reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    paths = _stored.get(spark.sparkContext.applicationId, [])
    for path in [p for p in paths if any(p.rsplit("/", 1)[-1] in f for f in files)]:
        remove(spark, path)
        paths.remove(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything this session stored; results that still read it can no longer be computed."""
    for path in _stored.pop(spark.sparkContext.applicationId, []):
        remove(spark, path)


def _clear_at_exit(spark: SparkSession) -> None:
    try:
        stopped = spark.sparkContext._jsc.sc().isStopped()
    except Exception:  # the JVM is gone, and with it the way to the file system
        return
    if not stopped:
        clear_scratch(spark)
