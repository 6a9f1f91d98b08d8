"""Hadoop file system calls a sink needs around a write (rename, delete, list)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str) -> tuple[Any, Any]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return bool(fs.exists(target))


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, old = _path(spark, source)
    if not fs.rename(old, _path(spark, target)[1]):
        raise OSError(f"cannot rename {source} to {target}")


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, target = _path(spark, path)
    fs.create(target, True).close()


def children(spark: SparkSession, path: str) -> list[str]:
    fs, target = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def partition_folder(spark: SparkSession, base: str, values: dict[str, Any]) -> str:
    """Folder of a partition as Spark names it."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join([base, *[escape(name, None if value is None else str(value)) for name, value in values.items()]])


def partition_names(spark: SparkSession, base: str) -> list[str]:
    """Partition columns of a table, from the first folder of each level; nothing is read."""
    names: list[str] = []
    while True:
        found = next((c for c in children(spark, base) if "=" in c and not c.startswith(("_", "."))), None)
        if found is None:
            return names
        names.append(found.split("=", 1)[0])
        base = f"{base}/{found}"
