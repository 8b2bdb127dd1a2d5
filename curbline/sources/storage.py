"""Folder operations on whatever file system Spark writes to."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs_path(spark, path)
    return fs.exists(target)


def drop_folder(spark: SparkSession, path: str) -> None:
    fs, target = _fs_path(spark, path)
    if fs.exists(target):
        fs.delete(target, True)


def partition_folder(spark: SparkSession, root: str, **values) -> str:
    """Path of one partition, with values escaped the way Spark's writer does."""
    utils = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    parts = [utils.getPartitionPathString(name, str(value)) for name, value in values.items()]
    return "/".join([root.rstrip("/"), *parts])


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that a glob pattern names; nothing below them is listed."""
    fs, target = _fs_path(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(target) or ())


def escaped(spark: SparkSession, value: str) -> str:
    """A partition value as Spark's writer spells it in a folder name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def literal(name: str) -> str:
    """A file name as a glob pattern that matches nothing else."""
    return re.sub(r"([\\*?\[\]{},])", r"\\\1", name)


def move_file(spark: SparkSession, path: str, target: str) -> None:
    """Put a file in the place of ``target``."""
    fs, to = _fs_path(spark, target)
    fs.delete(to, False)
    fs.mkdirs(to.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(path), to):
        raise OSError(f"could not move {path} to {target}")
