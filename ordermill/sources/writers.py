"""Writing results: Parquet and CSV folders, or one flat file on request.

A result is written beside its target and takes its place only when it is whole, so that a failed write
leaves the old one readable.  A frame may read the very folder that it replaces.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.session import hadoop_path, new_folder

# By default Spark strips white space around a field when it writes one.
LOSSLESS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet folder, replacing what was there once it is whole."""
    replace_folder(df.sparkSession, path, lambda fresh: df.write.parquet(fresh, partitionBy=partition_by))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV folder with a header line per file, replacing what was there once it is whole."""
    replace_folder(df.sparkSession, path, lambda fresh: df.write.options(**LOSSLESS).csv(fresh))


def replace_folder(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Call `write` with a fresh folder beside `path` and put that in the place of `path`.

    If `write` fails, what it left is deleted and `path` stays as it is.  The old folder is renamed, the
    new one renamed to `path`, the old one deleted; a folder cannot be replaced in a single step, so
    readers may find none for the moment in between.  If the driver dies in that moment `restore`, or
    the next write, brings the old one back.  Renames must be cheap and whole, as on HDFS or a local disk.
    """
    files, target = hadoop_path(spark, path.rstrip("/"))
    restore(spark, path)
    fresh, old = _beside(spark, target, "new"), _beside(spark, target, "old")
    try:
        write(fresh.toString())
        replaced = files.exists(target)
        if replaced and not files.rename(target, old):
            raise OSError(f"cannot move {path} aside")
        if not files.rename(fresh, target):
            if replaced:
                files.rename(old, target)
            raise OSError(f"cannot put the new result at {path}")
    except BaseException:
        files.delete(fresh, True)
        raise
    files.delete(old, True)


def move_folder(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder to a target that is not there, as a whole; nothing to move is no error."""
    (files, source), (_, place) = hadoop_path(spark, path), hadoop_path(spark, target)
    if files.exists(source):
        files.mkdirs(place.getParent())
        if files.exists(place) or not files.rename(source, place):
            raise OSError(f"cannot move {path} to {target}")


def restore(spark: SparkSession, path: str) -> None:
    """Undo a replacement of `path` that stopped between its two renames; else clean up after it, if need be."""
    files, target = hadoop_path(spark, path.rstrip("/"))
    if target.getParent() is not None:
        _restore(files, target.getParent(), target.getName())


def restore_inside(spark: SparkSession, folder: str) -> None:
    """`restore` every folder inside `folder`."""
    _restore(*hadoop_path(spark, folder))


def _restore(files, folder, name: str | None = None) -> None:
    for entry in files.listStatus(folder) if files.exists(folder) else []:
        old = re.fullmatch(r"\.(.+)\.old-[0-9a-f]{32}", entry.getPath().getName())
        if old and name in (None, old[1]):
            target = folder.suffix(f"/{old[1]}")
            if files.exists(target):
                files.delete(entry.getPath(), True)
            else:
                files.rename(entry.getPath(), target)


def _beside(spark: SparkSession, target, role: str):
    # Spark's readers pass over names that begin with a dot
    name = f".{target.getName()}.{role}-{uuid.uuid4().hex}"
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.getParent() or target, name)


def write_flat_file(df: DataFrame, target: str, file_format: str = "parquet") -> None:
    """One file at ``target``, in the order of ``df`` and replacing what was there in a single step.

    The result is first computed in parallel, into the shared folder; one task then copies its
    rows in order, so a large result is better left as a folder.
    """
    if file_format not in ("parquet", "csv"):
        raise ValueError(f"unknown format {file_format!r}")
    spark = df.sparkSession
    folder = new_folder(spark, "result")
    df.write.parquet(folder)
    result = spark.read.schema(df.schema).parquet(folder)
    # part files are numbered in the order of the result
    single = new_folder(spark, "single")
    place = ["_metadata.file_name", "_metadata.row_index"]
    ordered = result.select("*", *[F.col(c).alias(f"_place{i}") for i, c in enumerate(place)])
    ordered = ordered.coalesce(1).sortWithinPartitions("_place0", "_place1").drop("_place0", "_place1")
    writer = ordered.write
    if file_format == "csv":
        writer.options(**LOSSLESS).csv(single)
    else:
        writer.parquet(single)
    _publish_part(spark, single, target)


def _publish_part(spark: SparkSession, folder: str, target: str) -> None:
    # source and target may live on different file systems, so the part is copied beside the target first
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    (source_fs, source), (target_fs, destination) = hadoop_path(spark, folder), hadoop_path(spark, target)
    if target_fs.exists(destination) and target_fs.getFileStatus(destination).isDirectory():
        raise ValueError(f"{target} is a folder")
    part = source_fs.globStatus(jvm.org.apache.hadoop.fs.Path(source, "part-*"))[0].getPath()
    destination = target_fs.makeQualified(destination)
    fresh = _beside(spark, destination, "new")
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    try:
        jvm.org.apache.hadoop.fs.FileUtil.copy(source_fs, part, target_fs, fresh, False, True, conf)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(destination.toUri(), conf).rename(fresh, destination, options)
    except BaseException:
        target_fs.delete(fresh, False)
        raise
