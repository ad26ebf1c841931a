"""Writer logs as a stream, and incremental tiling of footprints as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tiling
from ..schema import WRITER_LOG


def event_time():
    """An event's time from whichever of the usual keys is there; unreadable ones are null."""
    return F.try_to_timestamp(F.coalesce("ts", "timestamp", "time"))


def read_log(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """JSON lines of writer events with ``at``; blank and broken lines are passed over."""
    reader = (spark.readStream if stream else spark.read).schema(WRITER_LOG).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.log")
    return reader.json(path).withColumn("at", event_time()).drop("ts", "timestamp", "time").where("at IS NOT NULL")


def newest_log(spark: SparkSession, folder: str, glob: str = "*.writer.log") -> str | None:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder)
    row = files.select("path", "modificationTime").orderBy(F.desc("modificationTime"), "path").first()
    return row["path"] if row else None


def windowed_progress(events: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Per window and event kind: events, and first to last growth of the log. Late events are taken up to ``late``."""
    by = events.withWatermark("at", late).groupBy(F.window("at", window), "event")
    out = by.agg(F.count("*").alias("n"), F.min("wal_bytes").alias("low"), F.max("wal_bytes").alias("high"))
    return out.select(F.col("window.start").alias("start"), "event", "n", "low", "high")


def stale_tiles(new_footprints: DataFrame, z: int) -> DataFrame:
    """Tiles that new footprints touch and that must be made again."""
    return tiling.cover_of(new_footprints, z, ["source"]).select("z", "x", "y").distinct()


def retile(footprints: DataFrame, rebuild, z: int, checkpoint: str):
    """Starts a query that calls ``rebuild(tiles, batch_id)`` for the stale tiles of each micro-batch, once available.

    ``rebuild`` must write idempotently, as by overwriting the tiles' partitions: a batch may be replayed.
    """
    return footprints.writeStream.foreachBatch(lambda batch, i: rebuild(stale_tiles(batch, z), i)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
