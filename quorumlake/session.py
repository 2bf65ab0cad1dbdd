"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOCAL_DIRS: dict[str, str] = {}


def session(app_name: str = "quorumlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; keyword names use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, for written tables and checkpoints.

    A cluster names it in `spark.checkpoint.dir`. Only a local-mode session,
    where one machine is all there is, gets a fresh temporary folder instead.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="quorumlake-")
    return _LOCAL_DIRS[application]


_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the paths named inside by `work_path` and `written` when it ends, also on failure.

    A frame that reads them must have been written elsewhere by then. Only
    paths of this scope go, never what a scope around it holds.
    """
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        hadoop = spark._jsparkSession.sessionState().newHadoopConf()
        for path in paths:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(hadoop).delete(target, True)


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if (paths := _SCOPE.get()) is not None:
        paths.append(path)
    return path


def stored(df: DataFrame, path: str) -> DataFrame:
    """The frame written to a path and read back; the shuffle files of the write go when it ends, not when the driver collects its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES, None)
    conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(FREE_SHUFFLES)
        else:
            conf.set(FREE_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table written to the shared folder and read back.

    For results needed more than once. Unlike cached or locally checkpointed
    blocks, the files survive the loss of any executor.
    """
    return stored(df, work_path(df.sparkSession, label))


def written_alone(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """`written` of the frame that `make` returns; the tables that `make` wrote on its way are removed."""
    path = work_path(spark, label)
    with scratch(spark):
        return stored(make(), path)


def widen(df: DataFrame) -> DataFrame:
    """Spread a scan of fewer splits than cores before heavy row-local work.

    Such an input is small, so the shuffle is; anything larger is left alone.
    Only for frames read from files: asking a frame with shuffles for its
    partitions would run them.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
