"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Where that is unset, a session on one machine (master ``local``) takes a temporary folder; any other is refused.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), "hypso-shared")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, rows: int | None = None, each: int = 25_000) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint in the shared folder.

    With ``rows``, about how many there are, the checkpoint has a file for every ``each`` of them and no more, where
    the last stage's work is light: a small table in hundreds of files costs more to open than to read.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return (df if rows is None else df.coalesce(files(rows, each))).checkpoint(eager=True)


def files(rows: int, each: int = 25_000) -> int:
    return max(1, -(-rows // each))


def release(spark: SparkSession) -> None:
    """Lets Spark remove shuffle files and checkpoints that nothing refers to any more.

    Its cleaner only learns of them when the driver collects garbage, which an idle driver of a long job rarely does.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bounded_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Arrow batches of about ``size`` bytes at most, so that a kernel's memory doesn't grow with the texts' length.

    Spark's default counts records first, and 10,000 long documents are far too many for a small executor.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).rstrip("bB")
    if not (now.isdigit() and 0 < int(now) <= size):
        spark.conf.set(name, str(size))


def trim() -> None:
    """Gives a worker's free memory back at the end of a kernel: workers live on, idle, beside the next steps' tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


_kept: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], object]):
    """The one model that a worker process keeps from task to task; another key's takes its place."""
    if key not in _kept:
        _kept.clear()
        trim()
        _kept[key] = make()
    return _kept[key]


def text_column(text: Column, kind: str, told: Callable[[pa.Array], pa.Array], spark: SparkSession) -> Column:
    """What ``told`` gives for Arrow arrays of texts, as a column of type ``kind``.

    Only the texts travel to Python: the rows they belong to stay where they are, whatever columns they have.
    """
    bounded_batches(spark)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield told(texts)
        trim()

    return F.arrow_udf(run, kind)(text.cast("string"))


def fresh(rows: DataFrame, name: str) -> str:
    """``name``, or if ``rows`` has such a column, a longer name that it lacks."""
    there = {c.lower() for c in rows.columns}
    while name.lower() in there:
        name += "_"
    return name


def small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver's as a table, by Arrow, without a Python worker."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return spark.createDataFrame(pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, columns, strict=True)}))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared file system."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_bytes(path: str) -> bytes:
    """A vocabulary file as the driver sees it; operators broadcast its bytes, a few MB whatever the data."""
    with open(path, "rb") as f:
        return f.read()


def held_out(doc_id: str):
    """True for the third of documents kept away from learning: crc32 of the id's text mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
