"""Tiles of a box, and the join of tiles with the raster footprints that overlap them.

A plain overlap condition would be a nested-loop join. Instead, each footprint is listed under the coarse cells
(as fine as the footprints are small, or the tile's own zoom where that is lower) that it touches, tiles look up their
own cell, and the exact overlap test is a residual of an equi-join. Footprints are broadcast only below a checked row count; beyond it both
sides are shuffled by cell, where adaptive execution splits crowded cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tilemath as M
from ..schema import BUCKET_ZOOM, EARTH_CIRCUMFERENCE_M

BROADCAST_ROWS = 200_000


def zooms(spark: SparkSession, low: int, high: int) -> DataFrame:
    return spark.range(low, high + 1).select(F.col("id").cast("int").alias("z"))


def _grid(boxes: DataFrame) -> DataFrame:
    """(z, x0, x1, y0, y1) to all tiles: rows are spread by column before they multiply by row."""
    across = boxes.select("z", "y0", "y1", F.explode(F.sequence("x0", "x1")).alias("x"))
    return across.select("z", "x", F.explode(F.sequence("y0", "y1")).alias("y"))


def tile_cover(spark: SparkSession, bbox: tuple[float, float, float, float], low: int, high: int) -> DataFrame:
    """All tiles (z, x, y) of a box (west, south, east, north) in degrees.

    Latitudes are clamped to the square Mercator world; a box whose west is east of its east crosses the antimeridian.
    """
    west, south, east, north = bbox
    parts = [(west, south, east, north)] if west <= east else [(-180.0, south, east, north), (west, south, 180.0, north)]
    z = zooms(spark, low, high)
    out = None
    for w, s, e, n in parts:
        w, s, e, n = max(-180.0, w), max(-M.MAX_LAT, s), min(180.0, e), min(M.MAX_LAT, n)
        box = z.select("z", M.lon_to_x(F.lit(w), "z").alias("x0"), M.lon_to_x(F.lit(e - M.EDGE), "z").alias("x1"), M.lat_to_y(F.lit(n), "z").alias("y0"), M.lat_to_y(F.lit(s + M.EDGE), "z").alias("y1"))
        box = box.withColumns({"x1": F.greatest("x0", "x1"), "y1": F.greatest("y0", "y1")})
        out = _grid(box) if out is None else out.unionByName(_grid(box))
    return out if len(parts) == 1 else out.distinct()


def tile_cover_metres(spark: SparkSession, box: tuple[float, float, float, float], low: int, high: int) -> DataFrame:
    """All tiles that a box (left, bottom, right, top) in Mercator metres shares inner points with."""
    cells = M.mercator_cells(*(F.lit(v) for v in box), "z")
    return _grid(zooms(spark, low, high).select("z", *(c.alias(n) for n, c in cells.items())))


def cover_of(footprints: DataFrame, z: int, keep: list[str]) -> DataFrame:
    """Tiles at zoom ``z`` that each footprint touches, with the columns ``keep``."""
    cells = M.mercator_cells("left", "bottom", "right", "top", F.lit(z))
    boxes = footprints.select(*keep, *(c.alias(n) for n, c in cells.items()))
    across = boxes.select(*keep, "y0", "y1", F.explode(F.sequence("x0", "x1")).alias("x"))
    return across.select(*keep, F.lit(z).alias("z"), "x", F.explode(F.sequence("y0", "y1")).alias("y"))


def _cells(footprints: DataFrame, bucket: int) -> DataFrame:
    """Footprints under every coarse cell at zooms 0 to ``bucket`` that they touch, once each."""
    found = M.mercator_cells("left", "bottom", "right", "top", F.lit(bucket))
    rows = footprints.withColumns({f"_{n}": c for n, c in found.items()})
    rows = rows.withColumn("_l", F.explode(F.sequence(F.lit(0), F.lit(bucket))))
    up = F.lit(bucket) - F.col("_l")
    rows = rows.withColumn("_x", F.explode(F.sequence(F.call_function("shiftright", "_x0", up), F.call_function("shiftright", "_x1", up))))
    rows = rows.withColumn("_y", F.explode(F.sequence(F.call_function("shiftright", "_y0", up), F.call_function("shiftright", "_y1", up))))
    return rows.drop("_x0", "_x1", "_y0", "_y1")


def bucket_zoom(footprints: DataFrame, least: int = BUCKET_ZOOM, most: int = 14, cells: int = 6) -> int:
    """The finest zoom at which footprints touch about ``cells`` cells each, on average, or fewer: a cell then holds a few
    footprints' neighbours, where cells of one zoom for all data would hold a country's."""
    spans = {}
    for z in range(least, most + 1):
        side = EARTH_CIRCUMFERENCE_M / (1 << z)
        spans[z] = F.avg(((F.col("right") - F.col("left")) / side + 1) * ((F.col("top") - F.col("bottom")) / side + 1)).alias(f"z{z}")
    told = footprints.agg(*spans.values()).first()
    return max([z for z in spans if told[f"z{z}"] is not None and told[f"z{z}"] <= cells], default=least)


def overlap_join(tiles: DataFrame, footprints: DataFrame, bucket: int | None = None, how: str = "inner", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Each tile with the footprints that share inner points with it.

    ``footprints`` has left, bottom, right, top in metres; tiles that nothing overlaps vanish in an inner join.
    """
    bucket = bucket_zoom(footprints) if bucket is None else bucket
    cells = _cells(footprints, bucket)
    if footprints.limit(broadcast_rows + 1).count() <= broadcast_rows:
        cells = F.broadcast(cells)
    own = M.mercator_bounds("z", "x", "y")
    probe = tiles.withColumns({"_tl": own["left"], "_tb": own["bottom"], "_tr": own["right"], "_tt": own["top"]})
    on: Column = (
        (F.least(F.col("z"), F.lit(bucket)) == F.col("_l")) & (M.parent("x", "z", bucket) == F.col("_x")) & (M.parent("y", "z", bucket) == F.col("_y"))
        & M.overlaps(("left", "bottom", "right", "top"), ("_tl", "_tb", "_tr", "_tt"))
    )
    return probe.join(cells, on, how).drop("_l", "_x", "_y", "_tl", "_tb", "_tr", "_tt")


def overlap_either(tiles: DataFrame, footprints: DataFrame) -> DataFrame:
    """Each tile with the footprints that overlap it or its mirror image (rows counted from the other pole), with
    ``mirrored`` false where the tile itself is overlapped, which is preferred."""
    own = overlap_join(tiles, footprints).withColumn("mirrored", F.lit(False))
    there = overlap_join(tiles.withColumn("y", M.flip_y("z", "y")), footprints).withColumn("y", M.flip_y("z", "y")).withColumn("mirrored", F.lit(True))
    key = [*tiles.columns, *footprints.columns]
    both = own.select(*key, "mirrored").unionByName(there.select(*key, "mirrored"))
    return both.groupBy(*key).agg(F.min("mirrored").alias("mirrored"))


def clipped_extent(footprints: DataFrame, bbox: tuple[float, float, float, float]) -> tuple[float, float, float, float]:
    """The part of a box of degrees that the footprints' joint extent covers, as degrees; an error if there is none."""
    u = union_bounds(footprints)
    r = u.select(M.mercator_to_lon("left"), M.mercator_to_lat("bottom"), M.mercator_to_lon("right"), M.mercator_to_lat("top")).first()
    if r is None or r[0] is None:
        raise ValueError("there are no footprints")
    west, south, east, north = max(bbox[0], r[0]), max(bbox[1], r[1]), min(bbox[2], r[2]), min(bbox[3], r[3])
    if west >= east or south >= north:
        raise ValueError("the box lies outside the sources")
    return west, south, east, north


def union_bounds(footprints: DataFrame) -> DataFrame:
    return footprints.agg(F.min("left").alias("left"), F.min("bottom").alias("bottom"), F.max("right").alias("right"), F.max("top").alias("top"))


def finest_zoom(footprints: DataFrame) -> DataFrame:
    """The zoom that the finest source's pixels ask for."""
    return footprints.agg(F.min("pixel_size").alias("pixel_size")).select(M.recommended_max_zoom("pixel_size").alias("max_zoom"))


def tiles_per_zoom(tiles: DataFrame) -> DataFrame:
    """Tiles of each zoom, and of all in the row with null z."""
    return tiles.rollup("z").agg(F.count("*").alias("n"))


def subtree_sources(footprints: DataFrame, z: int = 6, most: int = 5) -> DataFrame:
    """For each tile at zoom ``z`` that a source touches: how many sources do, and the first ``most`` by name."""
    cells = cover_of(footprints, z, ["source"]).distinct()
    return cells.groupBy("z", "x", "y").agg(F.count("*").alias("source_count"), F.slice(F.sort_array(F.collect_list("source")), 1, most).alias("sources"))
