"""The folder that driver and executors share, and deletion in it."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def shared(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster names in ``spark.checkpoint.dir``. Where that is unset, a session on one
    machine (master ``local``) takes a temporary folder; any other is refused."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = os.path.join(tempfile.gettempdir(), "hypso-shared")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local(spark: SparkSession, name: str) -> str:
    """As ``shared``, made, and as a path that files are opened by; the shared folder must be mounted for that."""
    path = shared(spark, name).removeprefix("file://").removeprefix("file:")
    if "://" in path:
        raise ValueError("archives are single files: the shared folder must be mounted on all machines")
    os.makedirs(path, exist_ok=True)
    return path


def _at(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, system = _at(spark, path)
    return system.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    where, system = _at(spark, path)
    system.delete(where, True)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file, with the folders above it."""
    where, system = _at(spark, path)
    system.create(where, True).close()
