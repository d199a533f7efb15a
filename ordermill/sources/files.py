"""Existence, renaming and removal on whatever file system a path belongs to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def rename(spark: SparkSession, old: str, new: str) -> None:
    p, fs = _at(spark, old)
    if not fs.rename(p, _at(spark, new)[0]):
        raise OSError(f"can't rename {old} to {new}")


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _at(spark, path)
    fs.delete(p, True)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    p, fs = _at(spark, path)
    return fs.getContentSummary(p).getLength()


def is_folder(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in order of name."""
    p, fs = _at(spark, pattern)
    return sorted(str(f.getPath().toString()) for f in (fs.globStatus(p) or []))


def age_seconds(spark: SparkSession, path: str) -> float:
    """Since its last change; infinite if it doesn't exist."""
    import time

    p, fs = _at(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000 if fs.exists(p) else float("inf")
