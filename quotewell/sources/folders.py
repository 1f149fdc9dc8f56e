"""Small steps on folders of any file system that Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies in the folder, in order of name; nothing if there is none."""
    system, where = _system(spark, path)
    if not system.exists(where):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(where))


def delete(spark: SparkSession, path: str) -> None:
    system, where = _system(spark, path)
    system.delete(where, True)


def commit(spark: SparkSession, staged: str, final: str) -> bool:
    """Rename a finished folder to its final name, in one step; False if that is taken already.

    Then the staged folder is removed, and what the other writer committed stays.
    """
    system, source = _system(spark, staged)
    _, target = _system(spark, final)
    system.mkdirs(target.getParent())
    if not system.exists(target) and system.rename(source, target):
        # Where both writers saw no target, the later rename lands inside the first one's folder.
        inner = spark._jvm.org.apache.hadoop.fs.Path(target, source.getName())
        if not system.exists(inner):
            return True
        system.delete(inner, True)
        return False
    system.delete(source, True)
    return False
