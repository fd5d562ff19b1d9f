"""Session set-up for local runs, and the shared folder for staged tables."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests, the bench and the command line outside spark-submit."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ordermill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="ordermill-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may do without the setting; every executor of a cluster must see
    the folder, so there a missing setting is an error rather than a private temp folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_folder()
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def hadoop_path(spark: SparkSession, path: str):
    """The file system of `path` and the path in Hadoop's terms."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


_applications: set[str] = set()
_scope: ContextVar[str | None] = ContextVar("staging scope", default=None)


def _application_folder(spark: SparkSession) -> str:
    """What this application stages; the driver's file system deletes it when the application ends."""
    folder = f"{shared_folder(spark)}/ordermill-{spark.sparkContext.applicationId}"
    if folder not in _applications:
        files, path = hadoop_path(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _applications.add(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path of this application, or of the `staging` scope around the call."""
    return f"{_scope.get() or _application_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """A scope for staged tables: what is staged inside is deleted at its end, whatever ends it.

    Write or collect a result inside the scope of the tables it reads.  Scopes nest, each deletes its own.
    """
    folder = f"{_application_folder(spark)}/scope-{uuid.uuid4().hex}"
    token = _scope.set(folder)
    try:
        yield
    finally:
        _scope.reset(token)
        files, path = hadoop_path(spark, folder)
        files.delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an aggregate to the shared folder and read it back.

    Cuts the lineage (a lost executor does not repeat the scan behind the aggregate), lets
    several consumers share one scan, and gives the planner real file sizes to choose a join
    by.  Meant for pre-aggregated frames, not for the order table itself.
    """
    return _stage(df, new_folder(df.sparkSession, label))


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_all(**frames: DataFrame) -> list[DataFrame]:
    """`stage` several aggregates at once, so that the last tasks of one do not hold up the next."""
    dfs = list(frames.values())
    paths = [new_folder(df.sparkSession, label) for label, df in frames.items()]
    # threads take over job group and scheduler pool, unless Python threads are not pinned to JVM threads
    inherit = inheritable_thread_target(dfs[0].sparkSession)
    write = inherit(_stage) if callable(inherit) else _stage
    with ThreadPoolExecutor(len(dfs)) as pool:
        return list(pool.map(write, dfs, paths))


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged, once its results have been written."""
    files, path = hadoop_path(spark, _application_folder(spark))
    files.delete(path, True)
