"""Folders that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, or the session's for checkpoints; a local one only where none is and Spark is local."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="folioforge-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return f"file://{_local[0]}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below it that nothing else uses; what is written there goes when the driver ends."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path
