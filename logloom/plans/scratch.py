"""Shared working folders for jobs that write tables and read them back."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    return base.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder of its own for one run; give it to ``remove_folder`` when its tables are no longer read."""
    return f"{shared_folder(spark)}/logloom/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that ``new_folder`` named."""
    if "/logloom/" not in folder:
        raise ValueError(f"not a working folder: {folder}")
    files, path = _path(spark, folder)
    files.delete(path, True)


def _path(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table that is written anew."""
    files, found = _path(spark, path)
    files.delete(found, True)


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder or file is there, on whatever file system its path names."""
    files, path = _path(spark, folder)
    return files.exists(path)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders inside a folder."""
    files, path = _path(spark, folder)
    if not files.exists(path):
        return []
    return sorted(found.getPath().getName() for found in files.listStatus(path) if found.isDirectory())


def remove_children(spark: SparkSession, folder: str, old: Callable[[str], bool]) -> None:
    """Delete the folders inside a folder whose name ``old`` picks."""
    files, _ = _path(spark, folder)
    for name in children(spark, folder):
        if not name.startswith("_") and old(name):
            files.delete(_path(spark, f"{folder}/{name}")[1], True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to a working folder and read back: later plans start from the files."""
    folder = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside takes its shuffle files with it when it is done; others stay until the driver's garbage is collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
