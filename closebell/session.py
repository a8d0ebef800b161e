"""Spark session defaults and the shared folder intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Needed for right results, whatever the cluster: dates are cut from UTC timestamps.
CORRECTNESS = {"spark.sql.session.timeZone": "UTC"}


def local_session(cores: str = "8", app: str = "closebell", **extra: str) -> SparkSession:
    """A session for tests and benchmarks. On a cluster, bring your own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **CORRECTNESS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": cores if cores.isdigit() else "8",
        "spark.sql.parquet.compression.codec": "zstd",
        # no call-site capture per column expression: building plans takes a third less time
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local-mode session may go without; a cluster has to name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="closebell-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


# Each job (thread or task of a caller) has scopes of its own: dropping the tables of one
# does not touch those of another.
_STAGED: ContextVar[tuple[list[str], ...]] = ContextVar("staged", default=())


def _scope() -> list[str]:
    if not _STAGED.get():
        _STAGED.set(([],))
    return _STAGED.get()[-1]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Used where several branches of one plan read the same costly input: the raw tables are
    then scanned once, later branches read only their columns of the staged table, and a
    lost executor costs a re-read instead of a recomputation.
    """
    path = f"{shared_folder(df.sparkSession)}/closebell/{name}-{uuid.uuid4().hex}"
    _scope().append(path)  # before the write, so that a failed one is dropped as well
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query begun inside go when it ends, not when the driver happens to
    collect its garbage.

    For steps that are staged one after the other. The setting is the session's, so queries that
    other threads begin meanwhile are treated alike; their results are the same.
    """
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are dropped at the end, also after an error."""
    token = _STAGED.set((*_STAGED.get(), []))
    try:
        yield
    finally:
        drop_staged(spark)
        _STAGED.reset(token)


def drop_staged(spark: SparkSession) -> int:
    """Delete the tables staged in the innermost scope, once no result needs them any more."""
    paths, staged, dropped = spark._jvm.org.apache.hadoop.fs.Path, _scope(), 0
    while staged:
        path = paths(staged.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        dropped += 1
    return dropped
