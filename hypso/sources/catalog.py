"""Catalogues of raster footprints: listing, scanning headers, and the bounds CSV that keeps the result."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tilemath as M
from ..schema import BOUNDS_CSV
from . import geotiff

NEEDED = tuple(BOUNDS_CSV.fieldNames())


def raster_files(spark: SparkSession, folder: str, glob: str = "*.tif") -> DataFrame:
    """path, length and modification time of a source's rasters; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length", "modificationTime")


def source_names(spark: SparkSession, root: str) -> DataFrame:
    """Names of the source folders under ``root`` that hold rasters or a catalogue."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    base = root.removeprefix("file:").rstrip("/")
    inside = F.expr(f"substring(path, instr(path, '{base}') + {len(base) + 1})")
    return files.select(F.regexp_extract(inside, r"^([^/]+)/", 1).alias("source")).where("source <> ''").distinct()


def scan_rasters(spark: SparkSession, folder: str, glob: str = "*.tif") -> DataFrame:
    """Bounds in Mercator metres and size of every raster, and ``error`` where a header can't be used.

    Files are listed by Spark and their headers read by ranges, a few kB a raster whatever its size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                name = os.path.basename(path)
                try:
                    read, close = geotiff.ranges(path)
                    try:
                        h = geotiff.header(read)
                    finally:
                        close()
                    box = h.mercator_bounds()
                    if not np.isfinite(box).all():
                        raise ValueError("bounds are not finite")
                    rows.append((name, *box, h.width, h.height, path, None))
                except Exception as e:  # any unreadable file is reported and passed over, as a row
                    rows.append((name, None, None, None, None, None, None, path, f"{type(e).__name__}: {e}"))
            kinds = (pa.string(), *[pa.float64()] * 4, *[pa.int32()] * 2, pa.string(), pa.string())
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*NEEDED, "path", "error"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path")
    return files.mapInArrow(run, "filename string, left double, bottom double, right double, top double, width int, height int, path string, error string")


def write_bounds(scanned: DataFrame, path: str) -> None:
    """The usable rows as CSV with a header, sorted by file name; an error if there are none."""
    rows = scanned.where("error IS NULL").select(*NEEDED)
    if rows.isEmpty():
        raise ValueError("no raster could be used")
    rows.orderBy("filename").coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_bounds(spark: SparkSession, path: str, source: str, priority: int = 0, folder: str | None = None, existing: DataFrame | None = None) -> DataFrame:
    """Footprints of one source. A missing column is an error, as is a missing catalogue; rows with bounds that aren't
    finite, or whose raster is not in ``existing`` (path), are passed over; if nothing remains, that is an error."""
    try:
        head = spark.read.csv(path, header=True).columns
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from None
        raise
    lacking = [c for c in NEEDED if c not in head]
    if lacking:
        raise ValueError(f"the catalogue lacks {', '.join(lacking)}")
    rows = spark.read.csv(path, header=True).select(*(F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name) for f in BOUNDS_CSV.fields))
    ok = M.finite("left") & M.finite("bottom") & M.finite("right") & M.finite("top")
    rows = rows.where(ok & F.col("filename").isNotNull())
    at = F.concat(F.lit((folder or os.path.dirname(path)).rstrip("/") + "/"), F.col("filename"))
    rows = rows.withColumns({"path": at, "pixel_size": M.pixel_size("left", "bottom", "right", "top", "width", "height"), "source": F.lit(source), "priority": F.lit(priority)})
    if existing is not None:
        rows = rows.join(existing.select(F.regexp_extract("path", r"([^/]+)$", 1).alias("filename")).distinct(), "filename", "left_semi").select(*NEEDED, "path", "pixel_size", "source", "priority")
    if rows.isEmpty():
        raise RuntimeError(f"no usable footprint in {path}")
    return rows


def read_bounds_lenient(spark: SparkSession, path: str) -> DataFrame:
    """left, bottom, right, top of all readable rows; no rows where there is no catalogue."""
    try:
        raw = spark.read.csv(path, header=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "left double, bottom double, right double, top double")
    if len(raw.columns) < 5:
        return spark.createDataFrame([], "left double, bottom double, right double, top double")
    names = ("left", "bottom", "right", "top")
    return raw.select(*(F.expr(f"try_cast(`{c}` AS double)").alias(n) for c, n in zip(raw.columns[1:5], names, strict=True))).dropna()


def records(spark: SparkSession, root: str, sources: Sequence[str], check_files: bool = True) -> DataFrame:
    """Footprints of all sources; the position in ``sources`` is the priority, 0 the best. ``record_ord`` keeps the
    catalogues' order for ties."""
    parts = []
    for i, s in enumerate(sources):
        existing = raster_files(spark, f"{root}/{s}") if check_files else None
        parts.append(read_bounds(spark, f"{root}/{s}/bounds.csv", s, i, f"{root}/{s}", existing))
    return reduce(DataFrame.unionByName, parts).withColumn("record_ord", F.struct("priority", "filename"))
