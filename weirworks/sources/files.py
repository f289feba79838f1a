"""Folders of the shared file system, through the session's Hadoop client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def local(spark: SparkSession, path: str) -> str | None:
    """The path as Python opens it; None unless it is on the local file system (or one that all machines have mounted)."""
    fs, where = _at(spark, path)
    return fs.makeQualified(where).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, where = _at(spark, path)
    fs.create(where).close()


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; an absent folder has none."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def committed(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders ``<prefix><number>`` whose write was committed (Spark marks it with a file)."""
    found = [n for n in names(spark, path) if n.startswith(prefix) and n[len(prefix):].isdigit()]
    return sorted(int(n[len(prefix):]) for n in found if exists(spark, f"{path}/{n}/_SUCCESS"))
