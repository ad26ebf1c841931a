"""Whole runs: from prioritised sources to tile archives, their lineage, and merges of archives."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable, Sequence
from contextlib import suppress
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import folders
from ..functions import tilemath as M
from ..functions.terrarium import PALETTE, extra_colour
from ..operators import archive, inspection, merge, raster, tiling
from ..schema import ATTRIBUTION, MAX_ZOOM, SUBTREE_ZOOM, TILE_SIZE
from ..sources import catalog, codec
from ..sources.mbtiles import MBTilesSource, plain_path
from ..sources.pmtiles import PMTilesSource
from . import zoom_split

Box = tuple[float, float, float, float]
WORLD: Box = (-180.0, -M.MAX_LAT, 180.0, M.MAX_LAT)


def register(spark: SparkSession) -> None:
    """Makes the formats ``mbtiles`` and ``pmtiles`` known to the session, and lets filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MBTilesSource)
    spark.dataSource.register(PMTilesSource)


def check_zooms(low: int, high: int) -> None:
    if low < 0 or high < low or high > MAX_ZOOM:
        raise ValueError(f"zooms {low} to {high} are not within 0 to {MAX_ZOOM}")


def merged_tiles(records: DataFrame, low: int, high: int | None = None, bbox: Box = WORLD, size: int = TILE_SIZE, tiles: DataFrame | None = None, packed: bool = False) -> DataFrame:
    """(z, x, y, px, prov): each tile's merged elevations and the source of every pixel, as lists or ``packed`` as bytes.

    Of overlapping rasters, the lower priority number wins a pixel, then the finer pixel, then the catalogue's order;
    no-data pixels are filled from the next. Tiles without any value don't appear.
    """
    spark = records.sparkSession
    high = tiling.finest_zoom(records).first()[0] if high is None else high
    check_zooms(low, high)
    if tiles is None:
        tiles = tiling.tile_cover(spark, tiling.clipped_extent(records, bbox), low, high)
    pairs = tiling.overlap_join(tiles, records.select("left", "bottom", "right", "top", "path", "pixel_size", "priority", "filename"))
    pairs = pairs.select("z", "x", "y", "path", "priority", "pixel_size", "filename")
    grids = raster.read_tiles(pairs, size, packed)
    return merge.merge_grids(grids.withColumnRenamed("priority", "prio"), ["prio", "pixel_size", "filename"])


def flip_sample(tiles: DataFrame, most: int = 32) -> DataFrame:
    """The first tiles in curve order with both row counts, as a sidecar to check an archive's orientation by."""
    rows = tiles.select("z", "x", "y", M.flip_y("z", "y").alias("tms_y"), M.tile_id("z", "x", "y").alias("tile_id"))
    return rows.orderBy("tile_id").limit(most)


def group_summary(spark: SparkSession, archives: Sequence[str], path: str) -> None:
    """Appends a row for each archive of a split run to a CSV: tiles, zooms, bytes of payload, time."""
    register(spark)
    out = None
    for p in archives:
        rows = spark.read.format("mbtiles").load(p).agg(F.count("*").alias("tiles"), F.min("z").alias("min_zoom"), F.max("z").alias("max_zoom"), F.sum(F.octet_length("tile_data")).alias("bytes"))
        rows = rows.select(F.lit(os.path.basename(p)).alias("archive"), "*", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"))
        out = rows if out is None else out.unionByName(rows)
    out.coalesce(1).write.mode("append").csv(path, header=True)


def write_mbtiles(
    tiles: DataFrame, path: str, name: str, extra: dict[str, str] | None = None, encoding: str = "terrarium", overwrite: bool = False,
    attribution: str = ATTRIBUTION, metadata: Callable[[DataFrame], DataFrame] | None = None, sidecar: bool = True,
) -> None:
    """An archive with its metadata, and beside it a sample of its rows in both orientations (``.sample.json``).

    Tiles are computed and written by as many tasks as they have; the commit copies the tasks' parts together. An
    existing file is refused unless ``overwrite``, which keeps it as ``.bak``. ``metadata`` makes rows (name, value)
    from the archive's statistics, where those of ``metadata_rows`` won't do.
    """
    spark = tiles.sparkSession
    register(spark)
    real = plain_path(path)
    if os.path.exists(real):
        if not overwrite:
            raise FileExistsError(path)
        os.replace(real, real + ".bak")
    tiles.select("z", "x", "y", "tile_data").write.format("mbtiles").mode("overwrite").save(path)
    keys = spark.read.format("mbtiles").option("table", "keys").load(path)
    stats = archive.tile_stats(keys)
    rows = metadata(stats) if metadata else archive.metadata_rows(stats, name, extra, encoding, codec.image_format(), attribution)
    rows.coalesce(1).write.format("mbtiles").option("table", "metadata").mode("append").save(path)
    if sidecar:
        told = [{"z": r.z, "x": r.x, "y_xyz": r.y, "expected_tms_y": r.tms_y} for r in flip_sample(keys).collect()]
        with open(f"{real}.sample.json", "w") as f:
            json.dump(told, f, indent=2)


def mbtiles_to_pmtiles(spark: SparkSession, source: str, target: str) -> None:
    """The same payloads in Hilbert order, with the archive's metadata."""
    register(spark)
    told = {r["name"]: r["value"] for r in spark.read.format("mbtiles").option("table", "metadata").load(source).collect()}
    write_pmtiles(spark.read.format("mbtiles").load(source), target, told, staged=True)


def write_pmtiles(tiles: DataFrame, path: str, metadata: dict[str, str] | None = None, staged: bool = False, middle: bool = False) -> None:
    """Tiles as PMTiles: dealt out by ranges of tile id, which tasks sort and spool; the commit lays them end to end.

    Finding the ranges reads the tiles once more, so they are staged beside the target first, unless they come from a
    table (``staged``). Bounds are the metadata's, else those of the tiles; the center's zoom is the lowest, or with
    ``middle`` the one between.
    """
    told, spark = dict(metadata or {}), tiles.sparkSession
    register(spark)
    rows, stage = tiles.select("z", "x", "y", "tile_data"), f"{path}.staged"
    if not staged:
        rows.write.mode("overwrite").parquet(stage)
        rows = spark.read.schema(rows.schema).parquet(stage)
    stats = archive.tile_stats(rows).first()
    if not told.get("bounds") and stats["n"]:
        told["bounds"] = ",".join(repr(stats[c]) for c in ("west", "south", "east", "north"))
    low, high = stats["min_zoom"] or 0, stats["max_zoom"] or 0
    ranged = rows.withColumn("_id", M.tile_id("z", "x", "y")).repartitionByRange("_id").sortWithinPartitions("_id").drop("_id")
    out = ranged.write.format("pmtiles").mode("overwrite").option("metadata", json.dumps(told)).option("tiletype", told.get("format", codec.image_format()))
    out = out.option("centerzoom", (low + high) // 2 if middle else low)
    if told.get("bounds"):
        out = out.option("bounds", told["bounds"])
    out.save(path)
    if not staged:
        folders.remove(spark, stage)


def merge_stage(records: DataFrame, stage: str, low: int, high: int, box: Box, size: int = TILE_SIZE) -> dict[str, int]:
    """Merged grids of the zooms that ``stage`` lacks, as Parquet by zoom, in one job: each raster's windows are read once
    for all of them. Gives the counts of tiles checked and emitted. A zoom is marked once its job has succeeded."""
    spark = records.sparkSession
    lacking = [z for z in range(low, high + 1) if not folders.exists(spark, f"{stage}/z={z}/_DONE")]
    if not lacking:
        return {"checked": 0, "emitted": 0}
    checked, emitted = Observation(), Observation()
    tiles = tiling.tile_cover(spark, box, low, high).where(F.col("z").isin(lacking)).observe(checked, F.count("*").alias("n"))
    merged = merged_tiles(records, low, high, box, size, tiles, packed=True).observe(emitted, F.count("*").alias("n"))
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("z").parquet(stage)
    for z in lacking:
        folders.mark(spark, f"{stage}/z={z}/_DONE")
    return {"checked": checked.get["n"], "emitted": emitted.get["n"]}


def staged(spark: SparkSession, stage: str, low: int, high: int) -> DataFrame:
    rows = spark.read.schema("x int, y int, px binary, prov binary, z int").parquet(stage)
    return rows.where(F.col("z").between(low, high))


def aggregate(spark: SparkSession, root: str, sources: Sequence[str], target: str, low: int = 0, high: int | None = None, bbox: Box = WORLD, size: int = TILE_SIZE, lineage: bool = False, pmtiles: bool = False, overwrite: bool = False, stage: str | None = None) -> dict[str, int]:
    """Sources to an MBTiles archive, with a lineage archive beside it and PMTiles of both on demand.

    Merged grids are staged as Parquet by zoom, so that archive and lineage come from one merge, and so that a run
    that broke off resumes at the zooms that are still missing. A stage folder belongs to one set of arguments. Gives
    how many tiles were checked and emitted by this run.
    """
    records = catalog.records(spark, root, sources)
    high = tiling.finest_zoom(records).first()[0] if high is None else high
    check_zooms(low, high)
    stage = stage or target + ".stage"
    counts = merge_stage(records, stage, low, high, tiling.clipped_extent(records, bbox), size)
    _archives(spark, stage, low, high, target, lineage, pmtiles, overwrite)
    return counts


def _archives(spark: SparkSession, stage: str, low: int, high: int, target: str, lineage: bool, pmtiles: bool, overwrite: bool) -> None:
    merged, name = staged(spark, stage, low, high), os.path.splitext(os.path.basename(target))[0]
    write_mbtiles(raster.encode_tiles(merged), target, name, overwrite=overwrite)
    made = [target]
    if lineage:
        side = f"{os.path.splitext(target)[0]}-lineage.mbtiles"
        write_mbtiles(raster.lineage_tiles(merged), side, f"{name}-lineage", encoding="lineage", overwrite=overwrite)
        made.append(side)
    if pmtiles:
        for m in made:
            mbtiles_to_pmtiles(spark, m, os.path.splitext(m)[0] + ".pmtiles")


def group_path(target: str, group: zoom_split.ZoomGroup) -> str:
    return f"{os.path.splitext(target)[0]}_{group.name}.mbtiles"


def aggregate_split(
    spark: SparkSession, root: str, sources: Sequence[str], target: str, pattern: str = "balanced", high: int = 16, resume_from: int = 0,
    bbox: Box = WORLD, size: int = TILE_SIZE, lineage: bool = False, overwrite: bool = False, keep: bool = False,
) -> list[str]:
    """A whole run by zoom groups: an archive per group, their union with merged metadata as MBTiles, the lineage of it,
    and PMTiles of both at ``target``; a summary of the groups as CSV beside it.

    Groups before ``resume_from`` (counted from 0) are taken as they are and must be there. Unless ``keep``, archives
    and stages of groups are removed at the end. Gives the paths of what remains.
    """
    groups = zoom_split.pattern(pattern)
    zoom_split.validate(groups)
    stem = os.path.splitext(target)[0]
    chosen = [(i, g) for i, g in enumerate(groups) if g.min_zoom <= high]
    for i, g in chosen:
        if i < resume_from and not os.path.exists(plain_path(group_path(target, g))):
            raise FileNotFoundError(f"there is nothing to resume from: {group_path(target, g)}")
    for i, g in chosen:
        if i >= resume_from:
            part = group_path(target, g)
            aggregate(spark, root, sources, part, g.min_zoom, min(g.max_zoom, high), bbox, size, overwrite=overwrite)
    parts = [group_path(target, g) for _, g in chosen]
    whole = f"{stem}.mbtiles"
    merge_archives(spark, parts, whole, verify=True, overwrite=overwrite)
    group_summary(spark, parts, f"{stem}_summary")
    made = [whole]
    if lineage:
        # The groups' stages hold every pixel's source. Those of resumed groups may be gone: their zooms are merged anew.
        records = catalog.records(spark, root, sources)
        box = tiling.clipped_extent(records, bbox)
        merged = []
        for (_, g), part in zip(chosen, parts, strict=True):
            merge_stage(records, f"{part}.stage", g.min_zoom, min(g.max_zoom, high), box, size)
            merged.append(staged(spark, f"{part}.stage", g.min_zoom, min(g.max_zoom, high)))
        side = f"{stem}-lineage.mbtiles"
        write_mbtiles(raster.lineage_tiles(reduce(DataFrame.unionByName, merged)), side, os.path.basename(stem) + "-lineage", encoding="lineage", overwrite=overwrite)
        made.append(side)
    for m in made:
        mbtiles_to_pmtiles(spark, m, os.path.splitext(m)[0] + ".pmtiles")
    if not keep:
        for p in map(plain_path, parts):
            for extra in ("", ".sample.json", ".writer.log", ".bak"):
                with suppress(FileNotFoundError):
                    os.remove(p + extra)
            shutil.rmtree(f"{p}.stage", ignore_errors=True)
    return [*made, *(os.path.splitext(m)[0] + ".pmtiles" for m in made), *(parts if keep else [])]


def subtree_path(folder: str, x: int, y: int, low: int, high: int) -> str:
    return f"{folder}/subtree_z{SUBTREE_ZOOM}_x{x}_y{y}_z{low}-{high}.mbtiles"


def aggregate_subtrees(spark: SparkSession, root: str, sources: Sequence[str], folder: str, tiles: Sequence[tuple[int, int]], low: int = 0, high: int = 16, size: int = TILE_SIZE, overwrite: bool = False) -> list[str]:
    """An archive for each tile (x, y) of the subtree zoom: all tiles of its box, from zoom ``low`` to ``high``."""
    made = []
    for x, y in tiles:
        box = spark.range(1).select(*(c.alias(n) for n, c in M.lonlat_bounds(F.lit(SUBTREE_ZOOM), F.lit(x), F.lit(y)).items())).first()
        path = subtree_path(folder, x, y, low, high)
        aggregate(spark, root, sources, path, low, high, tuple(box), size, overwrite=overwrite)
        made.append(path)
    return made


def lineage_tile(spark: SparkSession, root: str, sources: Sequence[str], z: int, x: int, y: int, out: str | None = None, size: int = TILE_SIZE):
    """One tile's sources as an image in the palette's colours (rows, columns, 3), written to ``out`` if named; None where
    no source has a value."""
    tile = spark.createDataFrame([(z, x, y)], "z int, x int, y int")
    row = merged_tiles(catalog.records(spark, root, sources), z, z, size=size, tiles=tile).select("prov").first()
    if row is None:
        return None
    image = raster.lineage_image(row["prov"], lambda i: PALETTE.get(i, extra_colour(i)))
    if out:
        with open(plain_path(out), "wb") as f:
            f.write(codec.encode(image, image="webp" if out.endswith(".webp") else "png"))
    return image


def inspect_fill(spark: SparkSession, path: str, root: str, sources: Sequence[str], z: int, x: int, y: int, size: int = TILE_SIZE) -> DataFrame:
    """How an archive's tile was filled, a row for each source: its valid pixels on the tile, those that the archive has
    and it lacks, with their share in percent, mean and largest difference where both have one, and ``candidates``,
    pixels that it has and the first source lacks. Sources that don't reach the tile have no valid pixels.

    The tile is looked up by its row and, failing that, by the mirrored one; so are the sources' footprints.
    """
    register(spark)
    tile = spark.createDataFrame([(z, x, y)], "z int, x int, y int")
    mirrored = (1 << z) - 1 - y
    there = spark.read.format("mbtiles").load(path).where((F.col("z") == z) & (F.col("x") == x) & F.col("y").isin(y, mirrored))
    there = there.orderBy((F.col("y") != y).cast("int")).limit(1).withColumn("y", F.lit(y))
    own = merge.tile_pixels(raster.decode_tiles(there), size).select("row", "col", F.col("elev").cast("double").alias("stored"))
    records = catalog.records(spark, root, sources)
    pairs = tiling.overlap_either(tile, records.select("left", "bottom", "right", "top", "path", "priority", "filename"))
    pairs = pairs.withColumn("y", F.when(F.col("mirrored"), F.lit(mirrored)).otherwise(F.col("y"))).select("z", "x", "y", "path", "priority", "filename")
    grids = raster.read_tiles(pairs, size).withColumn("y", F.lit(y))
    pixels = merge.tile_pixels(grids.withColumn("px", F.transform("px", lambda v: v.cast("double"))), size)
    each = pixels.where("elev IS NOT NULL").groupBy("priority", "row", "col").agg(F.min_by("elev", "filename").alias("elev"))
    first = each.where("priority = 0").select("row", "col", F.lit(True).alias("in_first"))
    names = spark.createDataFrame([(i, s) for i, s in enumerate(sources)], "priority int, source string")
    every = names.crossJoin(own).join(each, ["priority", "row", "col"], "left").join(first, ["row", "col"], "left")  # one tile's pixels for each source
    return inspection.fill_by_source(every)


def subtree(spark: SparkSession, root: str, sources: Sequence[str], x: int, y: int, low: int, high: int, size: int = TILE_SIZE) -> DataFrame:
    """The merged tiles below one tile of the subtree zoom, that tile's ancestors left out."""
    check_zooms(max(low, SUBTREE_ZOOM), high)
    records = catalog.records(spark, root, sources)
    box = spark.range(1).select(*(c.alias(n) for n, c in M.lonlat_bounds(F.lit(SUBTREE_ZOOM), F.lit(x), F.lit(y)).items())).first()
    tiles = tiling.tile_cover(spark, tuple(box), max(low, SUBTREE_ZOOM), high)
    return merged_tiles(records, max(low, SUBTREE_ZOOM), high, size=size, tiles=tiles)


def parse_tile(text: str) -> tuple[int, int]:
    """``6/x/y`` or ``x/y`` to (x, y)."""
    parts = [int(p) for p in text.split("/")]
    if len(parts) == 3 and parts[0] == SUBTREE_ZOOM:
        return parts[1], parts[2]
    if len(parts) != 2:
        raise ValueError(f"{text} names no tile at zoom {SUBTREE_ZOOM}")
    return parts[0], parts[1]


def merge_archives(spark: SparkSession, inputs: Sequence[str], target: str, verify: bool = True, overwrite: bool = False, attribution: str = ATTRIBUTION) -> None:
    """The union of archives, with merged metadata; an overlap is an error unless ``verify`` is off (the last wins)."""
    register(spark)
    if not inputs:
        raise ValueError("no archives")
    if os.path.exists(plain_path(target)) and not overwrite:
        raise FileExistsError(target)
    tiles = archive.union_archives([spark.read.format("mbtiles").load(p) for p in inputs], verify)
    told = reduce(DataFrame.unionByName, (spark.read.format("mbtiles").option("table", "metadata").load(p).withColumn("src_idx", F.lit(i)) for i, p in enumerate(inputs)))
    name = os.path.splitext(os.path.basename(target))[0]
    write_mbtiles(tiles, target, name, overwrite=overwrite, metadata=lambda stats: archive.union_metadata(told, stats, name, attribution))


def merge_pixelwise(spark: SparkSession, inputs: Sequence[str], mode: str = "priority", fall_through: bool = True) -> DataFrame:
    """(z, x, y, tile_data) merged from several archives' tiles.

    ``max``: the largest value of each pixel over the archives whose payload decodes. ``priority``: the first archive
    that has the tile; if its payload doesn't decode, the next one's with ``fall_through``, else the tile is left out.
    Payloads are decoded and encoded again at the tile's zoom.
    """
    if mode not in ("max", "priority"):
        raise ValueError(f"no such mode: {mode}")
    register(spark)
    every = None
    for i, p in enumerate(inputs):
        rows = spark.read.format("mbtiles").load(p).withColumn("src_idx", F.lit(i))
        every = rows if every is None else every.unionByName(rows)
    if mode == "priority" and not fall_through:
        grids = raster.decode_tiles(merge.tile_priority(every, empty_is_missing=False), ("src_idx",), packed=True).where("px IS NOT NULL")
    else:
        grids = raster.decode_tiles(every, ("src_idx",), packed=True).where("px IS NOT NULL")
        if mode == "priority":
            best = F.min_by("px", "src_idx")
            grids = grids.groupBy("z", "x", "y").agg(best.alias("px"))
        else:
            grids = merge.max_grids(grids)
    return raster.encode_tiles(grids)


def convert(spark: SparkSession, raster_path: str, target: str, low: int = 0, high: int | None = None, size: int = TILE_SIZE, overwrite: bool = False) -> None:
    """One raster to a PMTiles archive."""
    name = os.path.basename(raster_path)
    scanned = catalog.scan_rasters(spark, raster_path)
    bad = scanned.where("error IS NOT NULL").first()
    if bad:
        raise ValueError(bad["error"])
    records = scanned.drop("error").withColumns({"pixel_size": M.pixel_size("left", "bottom", "right", "top", "width", "height"), "priority": F.lit(0)})
    if os.path.exists(plain_path(target)) and not overwrite:
        raise FileExistsError(target)
    told = {"name": os.path.splitext(name)[0], "format": codec.image_format(), "encoding": "terrarium", "attribution": ATTRIBUTION}
    write_pmtiles(raster.encode_tiles(merged_tiles(records, low, high, size=size, packed=True)), target, told)


def merge_pixelwise_to(spark: SparkSession, inputs: Sequence[str], target: str, mode: str = "priority", fall_through: bool = False, overwrite: bool = False) -> None:
    """``merge_pixelwise`` as an archive, PMTiles or MBTiles by the target's name, with bounds, zooms and the center's
    zoom between them in its header or metadata."""
    tiles = merge_pixelwise(spark, inputs, mode, fall_through)
    name = os.path.splitext(os.path.basename(target))[0]
    if target.endswith(".pmtiles"):
        if os.path.exists(plain_path(target)) and not overwrite:
            raise FileExistsError(target)
        write_pmtiles(tiles, target, {"encoding": "terrarium", "attribution": ATTRIBUTION}, middle=True)
    else:
        write_mbtiles(tiles, target, name, overwrite=overwrite)


def merge_hybrid(spark: SparkSession, root: str, sources: Sequence[str], target: str, low: int = 0, high: int | None = None, mode: str = "priority", bbox: Box = WORLD, size: int = TILE_SIZE, overwrite: bool = False) -> list[str]:
    """An archive for each source by itself, then their pixelwise merge at ``target``. Gives the sources' archives."""
    stem, made = os.path.splitext(target)[0], []
    for s in sources:
        made.append(f"{stem}_{s}.mbtiles")
        aggregate(spark, root, [s], made[-1], low, high, bbox, size, overwrite=overwrite)
    merge_pixelwise_to(spark, made, target, mode, overwrite=overwrite)
    return made


def subtree_list(spark: SparkSession, root: str, sources: Sequence[str], out: str, z: int = SUBTREE_ZOOM, most: int = 5) -> None:
    """Which sources each tile touches, as JSON, as CSV with names joined by semicolons, and as text by source."""
    parts = None
    for s in sources:
        rows = catalog.read_bounds_lenient(spark, f"{root}/{s}/bounds.csv").withColumn("source", F.lit(s))
        parts = rows if parts is None else parts.unionByName(rows)
    found = tiling.subtree_sources(parts, z, most)
    found.select("x", "y", "z", "source_count", "sources").write.mode("overwrite").json(f"{out}/subtrees.json")
    found.select("x", "y", "z", "source_count", F.array_join("sources", ";").alias("sources")).write.mode("overwrite").csv(f"{out}/subtrees.csv", header=True)
    tiling.cover_of(parts, z, ["source"]).distinct().select("source", F.concat_ws(",", "x", "y").alias("tile")).write.mode("overwrite").partitionBy("source").text(f"{out}/by_source")


def split_report(groups: DataFrame) -> DataFrame:
    return groups.groupBy("pattern").agg(F.sum("estimated_tiles").alias("tiles"), F.max("estimated_memory_gb").alias("memory_gb"), F.count("*").alias("groups"))
