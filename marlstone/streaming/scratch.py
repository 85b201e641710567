"""Folders for streams that begin and end in one query."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below spark.checkpoint.dir, which the driver and all executors share; it goes with the process.

    Only where that is unset and Spark runs in one local process, a temporary folder takes its place.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    path = f"{base.rstrip('/')}/marlstone-{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Hadoop's objects."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _remove(spark: SparkSession, path: str) -> None:
    try:
        fs, p = hadoop(spark, path)
        fs.delete(p, True)
    except Exception:  # noqa: BLE001  the JVM may have ended before
        pass
