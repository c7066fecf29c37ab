"""Folders of tables, through the file system that Spark itself uses."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, files = _open(spark, path)
    return files.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; none when it is not there."""
    where, files = _open(spark, path)
    if not files.exists(where):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(where))


def partitions(spark: SparkSession, path: str, key: str) -> list[str]:
    """Values of the partition folders ``key=value`` in a folder, in order."""
    return [n.removeprefix(f"{key}=") for n in names(spark, path) if n.startswith(f"{key}=")]


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a writer has committed its output in a folder."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove folders; one that is gone already is no error."""
    for path in paths:
        where, files = _open(spark, path)
        files.delete(where, True)


def total_bytes(spark: SparkSession, path: str) -> int:
    where, files = _open(spark, path)
    return files.getContentSummary(where).getLength() if files.exists(where) else 0
