"""Command line: ``python -m hypso COMMAND ...``; each command is a call of the library."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .operators import archive, files, inspection, merge, raster, tiling
from .plans import tiling_job, zoom_split
from .sources import catalog
from .streaming import telemetry


def _box(text: str) -> tuple[float, ...]:
    west, south, east, north = map(float, text.split(","))
    return west, south, east, north


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="hypso")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple) -> argparse.ArgumentParser:
        c = sub.add_parser(name)
        for names, settings in options:
            c.add_argument(*names.split(), **settings)
        return c

    sources = ("sources", {"nargs": "+"})
    root = ("--root", {"default": "source-store"})
    zooms = (("--min-zoom", {"type": int, "default": 0}), ("--max-zoom", {"type": int}))
    box = ("--bbox", {"type": _box, "default": tiling_job.WORLD})
    command("bounds", ("folder", {}), ("--output", {"required": True}))
    command("aggregate", sources, root, *zooms, box, ("--output", {"required": True}), ("--lineage", {"action": "store_true"}), ("--pmtiles", {"action": "store_true"}), ("--overwrite", {"action": "store_true"}))
    overwrite = ("--overwrite", {"action": "store_true"})
    command("split", sources, root, ("--pattern", {"default": "balanced", "choices": list(zoom_split.PATTERNS)}), ("--max-zoom", {"type": int, "default": 16}), box, ("--output", {"required": True}), ("--resume-from", {"type": int, "default": 0}), ("--lineage", {"action": "store_true"}), ("--keep", {"action": "store_true"}), overwrite)
    command("subtree", sources, root, *zooms, ("--tiles", {"nargs": "+", "type": tiling_job.parse_tile, "required": True}), ("--folder", {"required": True}), overwrite)
    command("hybrid", sources, root, *zooms, box, ("--output", {"required": True}), ("--mode", {"choices": ("max", "priority"), "default": "priority"}), overwrite)
    command("lineage-tile", sources, root, ("--tile", {"required": True}), ("--size", {"type": int, "default": 512}), ("--out", {}))
    command("sample", ("archive", {}), ("--most", {"type": int, "default": 32}))
    command("convert", ("raster", {}), ("output", {}), *zooms, ("--overwrite", {"action": "store_true"}))
    command("merge", ("inputs", {"nargs": "+"}), ("--output", {"required": True}), ("--no-verify", {"action": "store_true"}), ("--overwrite", {"action": "store_true"}))
    command("merge-pixelwise", ("inputs", {"nargs": "+"}), ("--output", {"required": True}), ("--mode", {"choices": ("max", "priority"), "default": "max"}), ("--overwrite", {"action": "store_true"}))
    command("pack", ("input", {}), ("output", {}))
    command("inspect", ("archive", {}))
    command("compare", ("reference", {}), ("archive", {}))
    command("fill", sources, root, ("--tile", {"required": True}), ("--size", {"type": int, "default": 512}), ("--archive", {}))
    command("subtrees", sources, root, ("--output", {"required": True}), ("--max-sources", {"type": int, "default": 5}))
    command("patterns", ("--pattern", {"default": "balanced"}), ("--target-gb", {"type": float}), ("--max-zoom", {"type": int, "default": 16}))
    command("eta", ("log", {}), ("--target-bytes", {"type": int, "required": True}), ("--window", {"type": int, "default": 300}))
    command("digest", ("folder", {}), ("--glob", {"default": "*"}))
    return p


def _fill(spark: SparkSession, a: argparse.Namespace):
    z, x, y = map(int, a.tile.split("/"))
    records = catalog.records(spark, a.root, a.sources[:2])
    tile = spark.createDataFrame([(z, x, y)], "z int, x int, y int")
    pairs = tiling.overlap_join(tile, records).select("z", "x", "y", "path", "priority", "pixel_size", "filename")
    grids = raster.read_tiles(pairs, a.size).withColumnRenamed("priority", "prio")
    one = merge.tile_pixels(merge.merge_grids(grids.where("prio = 0"), ["prio", "pixel_size", "filename"]).drop("prov"), a.size)
    two = merge.tile_pixels(merge.merge_grids(grids.where("prio = 1"), ["prio", "pixel_size", "filename"]).drop("prov"), a.size)
    key = ["z", "x", "y", "row", "col"]
    both = one.withColumnRenamed("elev", "upper").join(two.withColumnRenamed("elev", "lower"), key, "full_outer")
    return inspection.fill_report(both, "upper", "lower")


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    tiling_job.register(spark)
    if a.command == "bounds":
        scanned = catalog.scan_rasters(spark, a.folder).cache()
        for r in scanned.where("error IS NOT NULL").toLocalIterator():
            print(f"{r.path}: {r.error}", file=sys.stderr)
        catalog.write_bounds(scanned, a.output)
    elif a.command == "aggregate":
        counts = tiling_job.aggregate(spark, a.root, a.sources, a.output, a.min_zoom, a.max_zoom, a.bbox, lineage=a.lineage, pmtiles=a.pmtiles, overwrite=a.overwrite)
        print(f"{counts['emitted']} tiles from {counts['checked']} candidates ({100 * counts['emitted'] / max(1, counts['checked']):.1f} %)")
    elif a.command == "split":
        for path in tiling_job.aggregate_split(spark, a.root, a.sources, a.output, a.pattern, a.max_zoom, a.resume_from, a.bbox, lineage=a.lineage, overwrite=a.overwrite, keep=a.keep):
            print(path)
    elif a.command == "subtree":
        for path in tiling_job.aggregate_subtrees(spark, a.root, a.sources, a.folder, a.tiles, a.min_zoom, 16 if a.max_zoom is None else a.max_zoom, overwrite=a.overwrite):
            print(path)
    elif a.command == "hybrid":
        for path in tiling_job.merge_hybrid(spark, a.root, a.sources, a.output, a.min_zoom, a.max_zoom, a.mode, a.bbox, overwrite=a.overwrite):
            print(path)
    elif a.command == "lineage-tile":
        z, x, y = map(int, a.tile.split("/"))
        image = tiling_job.lineage_tile(spark, a.root, a.sources, z, x, y, a.out, a.size)
        print("no source has a value there" if image is None else f"{image.shape[1]} x {image.shape[0]} pixels" + (f", written to {a.out}" if a.out else ""))
    elif a.command == "sample":
        keys = spark.read.format("pmtiles" if a.archive.endswith(".pmtiles") else "mbtiles").load(a.archive)
        for r in tiling_job.flip_sample(keys, a.most).collect():
            print(json.dumps(r.asDict()))
    elif a.command == "convert":
        tiling_job.convert(spark, a.raster, a.output, a.min_zoom, a.max_zoom, overwrite=a.overwrite)
    elif a.command == "merge":
        tiling_job.merge_archives(spark, a.inputs, a.output, not a.no_verify, a.overwrite)
    elif a.command == "merge-pixelwise":
        tiling_job.merge_pixelwise_to(spark, a.inputs, a.output, a.mode, overwrite=a.overwrite)
    elif a.command == "pack":
        tiling_job.mbtiles_to_pmtiles(spark, a.input, a.output)
    elif a.command == "inspect":
        kind = "pmtiles" if a.archive.endswith(".pmtiles") else "mbtiles"
        for table in ("header", "metadata") if kind == "pmtiles" else ("metadata",):
            for r in spark.read.format(kind).option("table", table).load(a.archive).collect():
                print(json.dumps(r.asDict(), ensure_ascii=False))
        tiles = spark.read.format(kind).load(a.archive).select("z", "x", "y")
        archive.tile_stats(tiles).show(truncate=False)
        tiling.tiles_per_zoom(tiles).orderBy("z").show(50)
        archive.key_check(tiles).show()
    elif a.command == "compare":
        pair = [spark.read.format("pmtiles" if p.endswith(".pmtiles") else "mbtiles").load(p) for p in (a.reference, a.archive)]
        archive.archive_diff(*pair).groupBy("status").count().orderBy("status").show()
    elif a.command == "fill":
        z, x, y = map(int, a.tile.split("/"))
        told = tiling_job.inspect_fill(spark, a.archive, a.root, a.sources, z, x, y, a.size).orderBy("priority") if a.archive else _fill(spark, a)
        told.show(truncate=False)
    elif a.command == "subtrees":
        tiling_job.subtree_list(spark, a.root, a.sources, a.output, most=a.max_sources)
    elif a.command == "patterns":
        groups = zoom_split.custom_split(spark, a.max_zoom, a.target_gb) if a.target_gb else zoom_split.pattern(a.pattern)
        for g in groups:
            print(f"{g.name}: {g.estimated_tiles:,} tiles, {g.estimated_memory_gb:.1f} GB")
    elif a.command == "eta":
        rows = telemetry.read_log(spark, a.log).selectExpr("'log' AS k", "unix_timestamp(at) AS t", "double(wal_bytes) AS v").where("v IS NOT NULL")
        rate = inspection.recent_rate(rows, ["k"], seconds=a.window)
        last = rows.groupBy("k").agg({"v": "max"}).withColumnRenamed("max(v)", "size")
        rate.join(last, "k").withColumn("eta_seconds", inspection.eta_seconds(rate["rate"], a.target_bytes - last["size"])).show(truncate=False)
    elif a.command == "digest":
        print("sha256 length path")
        for r in files.digests(spark, a.folder, a.glob).orderBy("path").toLocalIterator():
            print(r.sha256, r.length, r.path)


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("hypso").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    run(spark, a)


if __name__ == "__main__":
    main()
