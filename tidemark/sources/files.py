"""Folders and marker files in whatever file system a path names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def filesystem(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def delete(spark: SparkSession, path: str) -> None:
    fs, at = filesystem(spark, path)
    fs.delete(at, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there."""
    fs, at = filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def create_marker(spark: SparkSession, path: str) -> bool:
    """Create an empty file in one step; False if it is there already."""
    fs, at = filesystem(spark, path)
    fs.mkdirs(at.getParent())
    return fs.createNewFile(at)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir, or the context's), deleted when the session ends.

    In local mode, where neither may be set, a temporary folder is made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/tidemark-{name}-{uuid.uuid4().hex}"
    fs, at = filesystem(spark, path)
    fs.deleteOnExit(at)
    return path
