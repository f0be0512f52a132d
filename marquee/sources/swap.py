"""Replacing stored folders by new ones, through the store's own file system."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path itself."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, at = _file_system(spark, source)
    fs.mkdirs(_file_system(spark, target)[1].getParent())
    if not fs.rename(at, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be renamed to {target}")


def listed(spark: SparkSession, path: str) -> list[str]:
    """Paths of what a folder holds; none where it is missing."""
    fs, at = _file_system(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(at)] if fs.exists(at) else []


def swap_in(spark: SparkSession, new: str, target: str) -> None:
    """Put the folder ``new`` in the place of ``target``.

    The old folder is renamed, the new one takes its name, and only then the old
    one is deleted. If the second step fails, the old one gets its name back. A
    driver lost between the two steps leaves the old folder as
    ``<target>.old-*``, which :func:`restore` puts back. Renames are single
    steps on HDFS and local disks; in object stores they copy, and tables of the
    catalog (``write_table``) are the better targets.
    """
    target = target.rstrip("/")
    old = f"{target}.old-{uuid.uuid4().hex}"
    had = exists(spark, target)
    if had:
        rename(spark, target, old)
    try:
        rename(spark, new, target)
    except Exception:
        if had:
            rename(spark, old, target)
        raise
    if had:
        delete(spark, old)


def restore(spark: SparkSession, target: str) -> bool:
    """Put back the old folder of a swap that was cut short; True if it was."""
    target = target.rstrip("/")
    parent, _, name = target.rpartition("/")
    kept = sorted(p for p in listed(spark, parent) if p.rstrip("/").rsplit("/", 1)[-1].startswith(f"{name}.old-"))
    if exists(spark, target) or not kept:
        return False
    rename(spark, kept[-1], target)
    return True
