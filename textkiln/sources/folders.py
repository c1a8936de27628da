"""Scratch folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``; only a session in one
    process may use a temporary folder of its machine instead."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"textkiln-{name}-")


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, its lineage cut there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch(df.sparkSession, "kept"))
    return df.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours, wherever the session's file systems have it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path (local, hdfs, s3 and so on) and its name there."""
    if "://" not in path:
        path = path.removeprefix("file:")
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)
