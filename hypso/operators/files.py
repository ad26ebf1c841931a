"""Sizes and digests of files, on any file system that Spark reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)


def folder_size(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Number and bytes of the files below a folder; their contents are not read."""
    return _files(spark, folder, glob).agg(F.count("*").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def digests(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """path, length and SHA-256 of each file."""
    return _files(spark, folder, glob).select("path", "length", F.sha2("content", 256).alias("sha256"))
