"""Folder metadata through Hadoop's file systems, so that object stores work too."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; empty when there is no such folder."""
    fs, folder = _open(spark, path)
    if not fs.exists(folder):
        return []
    return [status.getPath().getName() for status in fs.listStatus(folder)]


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote ``path`` committed; half-written output has no marker."""
    fs, marker = _open(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def size(spark: SparkSession, path: str) -> int:
    fs, folder = _open(spark, path)
    return fs.getContentSummary(folder).getLength()


def make(spark: SparkSession, path: str) -> None:
    fs, folder = _open(spark, path)
    fs.mkdirs(folder)


def remove(spark: SparkSession, path: str) -> None:
    fs, folder = _open(spark, path)
    fs.delete(folder, True)


_SCRATCH: list[str] = []  # of this process, which has one Spark application at a time


def scratch(spark: SparkSession) -> str:
    """A new folder for intermediate tables, under the cluster's ``spark.checkpoint.dir``.

    Where that is unset, it is under the warehouse. A warehouse on the machines' own disks, which
    it is by default, is refused on a cluster, where executors would not find each other's files.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        if shared.startswith("file:") and not spark.sparkContext._jsc.sc().isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{shared.rstrip('/')}/strata-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders that this application made so far; returns how many.

    Results that were not written elsewhere still read from these folders.
    """
    made = [path for path in _SCRATCH if _is_reachable(spark, path)]
    for path in made:
        remove(spark, path)
        _SCRATCH.remove(path)
    return len(made)


def _is_reachable(spark: SparkSession, path: str) -> bool:
    """Whether the path lies where this session's scratch does; an earlier one may have had another."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return path.startswith(shared.rstrip("/"))
