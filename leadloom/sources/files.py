"""Folders of tables at rest, through the file system that Spark itself uses for their path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _at(spark, path)
    return system.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; nothing happens where there is none."""
    system, place = _at(spark, path)
    system.delete(place, True)


def mark(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it was there already."""
    system, place = _at(spark, path)
    return system.createNewFile(place)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Give a file another place on the same file system."""
    system, place = _at(spark, path)
    _, there = _at(spark, target)
    system.mkdirs(there.getParent())
    if not system.rename(place, there):
        raise OSError(f"cannot move {path} to {target}")
