"""Folders of whatever file system a path names, through Hadoop's file system interface."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _open(spark, path)
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a folder, sorted; none if it is not there."""
    place, files = _open(spark, path)
    if not files.exists(place):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the files and folders that a pattern names, sorted, found in one listing."""
    place, files = _open(spark, pattern)
    return sorted(s.getPath().toString() for s in files.globStatus(place) or [])


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below the folders that a path or pattern names; 0 if there are none."""
    place, files = _open(spark, path)
    return sum(files.getContentSummary(s.getPath()).getLength() for s in files.globStatus(place) or [])


def delete(spark: SparkSession, path: str) -> None:
    place, files = _open(spark, path)
    files.delete(place, True)
