"""Folders named ``name=value``, as partitioned writes leave them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the folders and files that fit ``pattern``."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = glob.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().toString() for s in fs.globStatus(glob) or []]


def children(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """``(value, path)`` of each such folder directly below ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder) if s.isDirectory()]
    return [(p.getName().split("=", 1)[1], p.toString()) for p in found if "=" in p.getName()]


def make_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it; nothing happens if it is gone already."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
