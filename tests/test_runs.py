"""Whole runs, writers and raster reading: what is distributed, what is read, and what lies in the files at the end."""

import json
import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hypso.operators import archive, files, merge, raster, tiling
from hypso.plans import tiling_job
from hypso.sources import catalog, codec, geotiff, mbtiles, pmtiles
from hypso.streaming import telemetry


def payloads(spark, rows, parts=3):
    return spark.createDataFrame(rows, "z int, x int, y int, tile_data binary").repartition(parts)


@pytest.fixture(scope="module")
def store(tmp_path_factory, spark):
    root = tmp_path_factory.mktemp("runs")
    for name, base, hole in (("fine", 100.0, True), ("coarse", 500.0, False)):
        os.makedirs(root / name)
        grid = np.full((64, 64), base)
        if hole:
            grid[20:40, 20:40] = -9999
        geotiff.write(str(root / name / "a.tif"), grid, 15_500_000.0, 4_260_000.0, 500.0, nodata=-9999)
        catalog.write_bounds(catalog.scan_rasters(spark, str(root / name)), str(root / name / "bounds.csv"))
    return str(root)


def tiff(tags, segments, big=False, order="<", masks=()):
    """A TIFF from tags (tag: (type code, values)) and raw segments; ``masks``: further directories of the same kind."""
    body, at = b"", 16 if big else 8
    directories = [(dict(tags), segments), *masks]
    packed = []
    for t, parts in directories:
        where = []
        for p in parts:
            where.append(at + len(body))
            body += p
        key = 324 if 322 in t else 273
        t[key] = ("Q" if big else "I", tuple(where))
        t[key + 1 if key == 324 else 279] = ("Q" if big else "I", tuple(len(p) for p in parts))
        packed.append(t)
    kinds = {"H": 3, "I": 4, "d": 12, "Q": 16, "s": 2}
    out, starts = b"", []
    for n, t in enumerate(packed):
        start = at + len(body) + len(out)
        slot, many = (20, 8) if big else (12, 2)
        extra_at = start + many + slot * len(t) + (8 if big else 4)
        entries, extra = b"", b""
        for tag in sorted(t):
            code, values = t[tag]
            raw = values if code == "s" else struct.pack(order + code * len(values), *values)
            count, room = len(raw) if code == "s" else len(values), 8 if big else 4
            if len(raw) > room:
                value = struct.pack(order + ("Q" if big else "I"), extra_at + len(extra))
                extra += raw
            else:
                value = raw.ljust(room, b"\0")
            entries += struct.pack(order + ("HHQ" if big else "HHI"), tag, kinds[code], count) + value
        after = extra_at + len(extra) if n + 1 < len(packed) else 0
        starts.append(start)
        out += struct.pack(order + ("Q" if big else "H"), len(t)) + entries + struct.pack(order + ("Q" if big else "I"), after) + extra
    mark = b"II" if order == "<" else b"MM"
    head = mark + (struct.pack(order + "HHHQ", 43, 8, 0, starts[0]) if big else struct.pack(order + "HI", 42, starts[0]))
    return head + body + out


def tags(width, height, crs=3857, bits=32, kind=3, **more):
    geo = (1, 1, 0, 1, 3072 if crs not in (4326, 6668) else 2048, 0, 1, crs)
    out = {256: ("I", (width,)), 257: ("I", (height,)), 258: ("H", (bits,)), 259: ("H", (1,)), 277: ("H", (1,)), 339: ("H", (kind,)), 33550: ("d", (10.0, 10.0, 0.0)), 33922: ("d", (0, 0, 0, 1000.0, 2000.0, 0)), 34735: ("H", geo)}
    return out | {int(k[1:]): v for k, v in more.items()}


GRID = np.arange(48, dtype="<f4").reshape(6, 8)


def test_bigtiff_bands_tiles_and_masks():
    strips = [GRID[r : r + 2].tobytes() for r in (0, 2, 4)]
    assert (geotiff.band(tiff(tags(8, 6, t278=("I", (2,))), strips, big=True)) == GRID).all()
    swapped = [GRID[r : r + 2].astype(">f4").tobytes() for r in (0, 2, 4)]
    assert (geotiff.band(tiff(tags(8, 6, t278=("I", (2,))), swapped, order=">")) == GRID).all()
    # Three bands, side by side and one after the other; the first counts.
    mixed = np.stack([GRID, GRID + 100, GRID + 200], axis=-1).astype("<f4")
    assert (geotiff.band(tiff(tags(8, 6) | {277: ("H", (3,)), 278: ("I", (6,))}, [mixed.tobytes()])) == GRID).all()
    planes = [np.ascontiguousarray(mixed[:, :, k]).tobytes() for k in range(3)]
    assert (geotiff.band(tiff(tags(8, 6) | {277: ("H", (3,)), 278: ("I", (6,)), 284: ("H", (2,))}, planes)) == GRID).all()
    # Tiles of 4 x 4, the last row of them cut off by the raster's edge.
    whole = np.zeros((8, 8), "<f4")
    whole[:6] = GRID
    tiles = [np.ascontiguousarray(whole[r : r + 4, c : c + 4]).tobytes() for r in (0, 4) for c in (0, 4)]
    assert (geotiff.band(tiff(tags(8, 6) | {322: ("I", (4,)), 323: ("I", (4,))}, tiles)) == GRID).all()
    # An internal mask of single bits: 0 is no data, unless a no-data value is told.
    keep = np.ones((6, 8), np.uint8)
    keep[1, 2:5] = 0
    mask = ({254: ("I", (4,)), 256: ("I", (8,)), 257: ("I", (6,)), 258: ("H", (1,)), 259: ("H", (8,)), 277: ("H", (1,)), 278: ("I", (6,))}, [zlib.compress(np.packbits(keep, axis=1).tobytes())])
    got = geotiff.band(tiff(tags(8, 6) | {278: ("I", (6,))}, [GRID.tobytes()], masks=[mask]))
    assert (np.isnan(got) == (keep == 0)).all() and (got[keep == 1] == GRID[keep == 1]).all()
    got = geotiff.band(tiff(tags(8, 6) | {278: ("I", (6,)), 42113: ("s", b"7\0")}, [GRID.tobytes()], masks=[mask]))
    assert np.isnan(got).sum() == 1 and np.isnan(got[0, 7])


def test_only_touched_segments_are_read():
    grid = np.arange(400 * 300, dtype="<f4").reshape(400, 300)
    data = tiff(tags(300, 400) | {278: ("I", (10,))}, [grid[r : r + 10].tobytes() for r in range(0, 400, 10)])
    asked = []

    def read(at, size):
        asked.append(size)
        return data[at : at + size]

    source = geotiff.Raster(read, geotiff.header(read))
    before = sum(asked)
    part = source.window(95, 112, 20, 40)
    assert (part == grid[95:112, 20:40]).all() and source.decoded == 3 and sum(asked) - before == 3 * 10 * 300 * 4
    source.window(100, 120, 0, 300)
    assert source.decoded == 3
    few = geotiff.Raster(read, geotiff.header(read), most=30_000)
    few.window(0, 400, 0, 10)
    assert len(few._kept) <= 3
    # A tile over a corner of a large raster decodes that corner alone.
    h = geotiff.header(read)
    corner = geotiff.Raster(read, h)
    z = 15
    x, y = int((h.left + raster.HALF) // (2 * raster.HALF / 2**z)), int((raster.HALF - h.top) // (2 * raster.HALF / 2**z))
    grid_px = raster.sample(corner, z, x, y, 64)
    assert not np.isnan(grid_px).all() and corner.decoded < 20


@pytest.mark.parametrize("crs, lon, lat", [(6677, 140.0, 36.0), (2451, 139.5, 35.2), (32654, 139.7, 35.7), (32733, 14.2, -30.0), (6691, 141.3, 38.0)])
def test_transverse_mercator_round_trip(crs, lon, lat):
    flat = geotiff.projection(crs)
    x, y = flat.forward(np.array([lon]), np.array([lat]))
    back = flat.inverse(x, y)
    assert abs(back[0][0] - lon) < 1e-9 and abs(back[1][0] - lat) < 1e-9
    step = 1e-4  # one degree of latitude is about 111 km, scaled
    north = flat.forward(np.array([lon]), np.array([lat + step]))[1] - y
    assert abs(north[0] / step / 111_000 - 1) < 0.01


def test_projected_raster_samples_its_place(tmp_path):
    """A plane in zone IX: a tile's values are the plane's at the places its pixels project to."""
    flat = geotiff.projection(6677)
    east, north = (float(v[0]) for v in flat.forward(np.array([139.8]), np.array([35.9])))
    cols, rows = np.meshgrid(np.arange(200.0), np.arange(200.0))
    t = tags(200, 200, crs=6677) | {278: ("I", (200,)), 33922: ("d", (0, 0, 0, east - 1000, north + 1000, 0))}
    h = geotiff.header(tiff(t, [(3 * cols + 2 * rows).astype("<f4").tobytes()]))
    source = geotiff.Raster(geotiff.bytes_reader(tiff(t, [(3 * cols + 2 * rows).astype("<f4").tobytes()])), h)
    left, bottom, right, top = h.mercator_bounds()
    z = 16
    side = 2 * raster.HALF / 2**z
    x, y = int(((left + right) / 2 + raster.HALF) // side), int((raster.HALF - (bottom + top) / 2) // side)
    got = raster.sample(source, z, x, y, 16)
    mx, my = x * side - raster.HALF + 5.5 * side / 16, raster.HALF - y * side - 9.5 * side / 16
    px, py = flat.forward(np.array([mx / raster.HALF * 180]), geotiff.to_degrees(np.array([my])))
    assert abs(got[9, 5] - (3 * ((px[0] - (east - 1000)) / 10 - 0.5) + 2 * ((north + 1000 - py[0]) / 10 - 0.5))) < 1e-3
    assert geotiff.header(tiff(tags(8, 6, crs=27700) | {278: ("I", (6,))}, [GRID.tobytes()])).crs == 27700
    with pytest.raises(ValueError, match="27700"):
        geotiff.header(tiff(tags(8, 6, crs=27700) | {278: ("I", (6,))}, [GRID.tobytes()])).mercator_bounds()


def test_encoding_is_distributed(spark, tmp_path):
    """No coalesce stands over the encoding kernel: tasks encode and write parts, the commit joins them."""
    grids = spark.range(0, 40, 1, 5).selectExpr("8 AS z", "int(id) AS x", "int(id % 7) AS y", "array_repeat(float(id), 64) AS px")
    at = str(tmp_path / "a.mbtiles")
    seen = []
    plain = mbtiles.MBTilesWriter.commit
    mbtiles.MBTilesWriter.commit = lambda self, messages: seen.append([m.rows for m in messages if m and m.part]) or plain(self, messages)
    try:
        tiling_job.write_mbtiles(raster.encode_tiles(grids), at, "a")
    finally:
        mbtiles.MBTilesWriter.commit = plain
    assert spark.read.format("mbtiles").load(at).count() == 40
    events = [json.loads(line) for line in open(f"{at}.writer.log")]
    assert [e["event"] for e in events] == ["commit"] * 5 + ["finalize"] and events[-1]["insert_count"] == 40
    assert sum(e.get("batch_committed", 0) for e in events) == 40 and all(e["wal_bytes"] > 0 for e in events)
    assert telemetry.read_log(spark, f"{at}.writer.log").count() == 6
    told = json.load(open(f"{at}.sample.json"))
    assert len(told) == 32 and all(t["expected_tms_y"] == 2 ** t["z"] - 1 - t["y_xyz"] for t in told)
    with pytest.raises(PySparkException, match="journal_mode"):
        payloads(spark, [(1, 0, 0, b"x")]).write.format("mbtiles").mode("append").option("synchronous", "a; b").save(at)
    payloads(spark, [(1, 0, 0, b"x")]).write.format("mbtiles").mode("append").option("journal_mode", "WAL").option("synchronous", "NORMAL").save(at)
    assert spark.read.format("mbtiles").load(at).count() == 41 and not os.path.exists(f"{at}.whole-wal")


def test_mbtiles_partitions_and_filters(spark, tmp_path):
    at = str(tmp_path / "a.mbtiles")
    rows = [(z, x, y, f"{z}/{x}/{y}".encode()) for z in (3, 6) for x in range(1 << z) for y in range(1 << z)]
    tiling_job.write_mbtiles(payloads(spark, rows), at, "a", sidecar=False)
    df = spark.read.format("mbtiles").option("tilesperpartition", "500").load(at)
    assert df.rdd.getNumPartitions() == 1 + 8  # zoom 6 by eight of its 64 columns
    assert {(r.z, r.x, r.y): bytes(r.tile_data) for r in df.collect()} == {r[:3]: r[3] for r in rows}
    for condition in ("z = 6 AND y = 5", "y >= 30 AND x < 9", "y IN (1, 2, 63)", "z = 3 AND y < 2 AND y > 0", "y <= 3 AND x >= 60"):
        expected = spark.createDataFrame(rows, "z int, x int, y int, tile_data binary").where(condition).count()
        assert df.where(condition).count() == expected > 0
    reader = mbtiles.MBTilesReader({"path": at})
    list(reader.pushFilters([mbtiles.GreaterThan(("y",), 60), mbtiles.EqualTo(("z",), 6)]))
    clause, values = reader.clause(mbtiles.Columns(6, 0, 63))
    assert "tile_row < ?" in clause and values == (3, 6, 6, 0, 63)


def test_pmtiles_ranges(spark, tmp_path):
    """Many ranges, equal payloads across their borders, leaf directories, an empty archive."""
    at = str(tmp_path / "a.pmtiles")
    rows = [(7, x, y, b"same" if x < 64 else f"{x}/{y}".encode()) for x in range(128) for y in range(128)]
    tiling_job.write_pmtiles(payloads(spark, rows, 7), at, {"name": "n"})
    h = spark.read.format("pmtiles").option("table", "header").load(at).first()
    assert (h.addressed, h.min_zoom, h.max_zoom) == (len(rows), 7, 7) and h.leaf_length > 0
    assert h.entries == len(rows) // 2 + 1  # one entry for the western half: the curve walks its quadrants first and last
    df = spark.read.format("pmtiles").load(at)
    assert df.rdd.getNumPartitions() > 1
    assert {(r.z, r.x, r.y): bytes(r.tile_data) for r in df.collect()} == {r[:3]: r[3] for r in rows}
    assert not [f for f in os.listdir(tmp_path) if "spool" in f or "staged" in f or "leaves" in f]
    none = str(tmp_path / "none.pmtiles")
    tiling_job.write_pmtiles(payloads(spark, rows).where("false"), none)
    assert spark.read.format("pmtiles").load(none).count() == 0
    assert pmtiles.tile_of(pmtiles.tile_id(9, 300, 77)) == (9, 300, 77)


def test_one_job_for_all_zooms_and_resume(spark, store, tmp_path):
    target = str(tmp_path / "a.mbtiles")
    counts = tiling_job.aggregate(spark, store, ["fine", "coarse"], target, 7, 9, size=16)
    tiles = spark.read.format("mbtiles").load(target)
    assert counts["emitted"] == tiles.count() and counts["checked"] >= counts["emitted"] > 0
    assert all(os.path.exists(f"{target}.stage/z={z}/_DONE") for z in (7, 8, 9))
    os.remove(f"{target}.stage/z=8/_DONE")
    again = tiling_job.aggregate(spark, store, ["fine", "coarse"], target, 7, 9, size=16, overwrite=True)
    assert again["emitted"] == tiles.where("z = 8").count()
    assert tiling_job.aggregate(spark, store, ["fine", "coarse"], target, 7, 9, size=16, overwrite=True) == {"checked": 0, "emitted": 0}
    assert spark.read.format("mbtiles").load(target).count() == counts["emitted"]


def test_split_run(spark, store, tmp_path):
    target = str(tmp_path / "whole.pmtiles")
    made = tiling_job.aggregate_split(spark, store, ["fine", "coarse"], target, "fast", 12, lineage=True, size=8, bbox=(139.2, 35.3, 139.4, 35.7))
    assert [os.path.basename(p) for p in made] == ["whole.mbtiles", "whole-lineage.mbtiles", "whole.pmtiles", "whole-lineage.pmtiles"]
    a, b = spark.read.format("mbtiles").load(made[0]), spark.read.format("pmtiles").load(target)
    assert a.agg(F.max("z")).first()[0] == 12 and archive.archive_diff(a, b).where("status <> 'matched'").count() == 0
    assert spark.read.format("pmtiles").load(made[3]).count() == a.count()
    told = {r.name: r.value for r in spark.read.format("mbtiles").option("table", "metadata").load(made[0]).collect()}
    assert (told["minzoom"], told["maxzoom"], told["name"]) == ("7", "12", "whole_z0-11") and told["center"].endswith(",9")
    assert not [f for f in os.listdir(tmp_path) if "_z0-11" in f or "_z12" in f]
    summary = spark.read.csv(str(tmp_path / "whole_summary"), header=True).collect()
    assert {r.archive for r in summary} == {"whole_z0-11.mbtiles", "whole_z12-13.mbtiles"}
    with pytest.raises(FileNotFoundError):
        tiling_job.aggregate_split(spark, store, ["fine"], target, "fast", 12, resume_from=1, overwrite=True)
    kept = tiling_job.aggregate_split(spark, store, ["fine"], str(tmp_path / "k.pmtiles"), "fast", 8, size=8, keep=True)
    assert os.path.exists(kept[-1])
    tiling_job.aggregate_split(spark, store, ["fine"], str(tmp_path / "k.pmtiles"), "fast", 8, resume_from=1, size=8, overwrite=True)
    assert not os.path.exists(kept[-1])


def test_subtrees_and_hybrid(spark, store, tmp_path):
    x, y = tiling_job.parse_tile("6/56/25")
    made = tiling_job.aggregate_subtrees(spark, store, ["fine", "coarse"], str(tmp_path), [(x, y)], 5, 8, size=16)
    assert os.path.basename(made[0]) == "subtree_z6_x56_y25_z5-8.mbtiles"
    keys = [(r.z, r.x, r.y) for r in spark.read.format("mbtiles").option("table", "keys").load(made[0]).collect()]
    assert keys and all((a >> (z - 6), b >> (z - 6)) == (x, y) if z >= 6 else (a, b) == (x >> 1, y >> 1) for z, a, b in keys)
    assert tiling_job.subtree(spark, store, ["fine"], x, y, 6, 8, 16).count() > 0
    target = str(tmp_path / "h.pmtiles")
    parts = tiling_job.merge_hybrid(spark, store, ["fine", "coarse"], target, 8, 9, "max", size=16)
    h = spark.read.format("pmtiles").option("table", "header").load(target).first()
    stats = archive.tile_stats(spark.read.format("pmtiles").load(target)).first()
    assert (h.min_zoom, h.max_zoom, h.center_zoom) == (8, 9, 8) and abs(h.min_lon_e7 / 1e7 - stats.west) < 1e-6 and abs(h.max_lat_e7 / 1e7 - stats.north) < 1e-6
    told = {r.name: r.value for r in spark.read.format("pmtiles").option("table", "metadata").load(target).collect()}
    assert told["encoding"] == "terrarium" and told["attribution"]
    assert len(parts) == 2 and all(os.path.exists(p) for p in parts)
    with pytest.raises(FileExistsError):
        tiling_job.merge_pixelwise_to(spark, parts, target)


def test_lineage_tile_and_fill(spark, store, tmp_path):
    target = str(tmp_path / "a.mbtiles")
    tiling_job.aggregate(spark, store, ["fine", "coarse"], target, 9, 9, size=16)
    out = str(tmp_path / "t.png")
    image = tiling_job.lineage_tile(spark, store, ["fine", "coarse"], 9, 454, 201, out, 16)
    assert (codec.decode(open(out, "rb").read())[:, :, :3] == image).all() and {tuple(p) for p in image.reshape(-1, 3).tolist()} == {(255, 255, 255), (0, 100, 0), (50, 205, 50)}
    assert tiling_job.lineage_tile(spark, store, ["fine"], 9, 1, 1, size=16) is None
    told = {r.source: r for r in tiling_job.inspect_fill(spark, target, store, ["fine", "coarse", "fine"], 9, 454, 201, 16).collect()}
    assert told["fine"].valid_pixels < told["coarse"].valid_pixels and told["fine"].candidates == 0
    assert told["coarse"].candidates == told["coarse"].valid_pixels - told["fine"].valid_pixels > 0
    assert told["fine"].filled_pixels == 256 - told["fine"].valid_pixels and abs(told["fine"].filled_percent - 100 * told["fine"].filled_pixels / 256) < 1e-9
    assert told["fine"].max_abs_diff == 0 and told["coarse"].max_abs_diff == 400  # zoom 9 rounds to 4 m: 100 and 500 stay
    # Asked for by its mirrored row, the tile and the footprints are found all the same.
    flipped = {r.source: r.valid_pixels for r in tiling_job.inspect_fill(spark, target, store, ["fine", "coarse"], 9, 454, 511 - 201, 16).collect()}
    assert flipped == {s: told[s].valid_pixels for s in ("fine", "coarse")}


def test_overlap_either_prefers_the_tile_itself(spark):
    half = raster.HALF
    feet = spark.createDataFrame([(1, -10.0, 1000.0, 10.0, half / 2), (2, -10.0, -half / 2, 10.0, -1000.0), (3, -10.0, -5.0, 10.0, 5.0)], "fid int, left double, bottom double, right double, top double")
    tile = spark.createDataFrame([(2, 1, 1)], "z int, x int, y int")
    assert {(r.fid, r.mirrored) for r in tiling.overlap_either(tile, feet).collect()} == {(1, False), (2, True), (3, False)}


def test_bucket_zoom_follows_footprints(spark):
    def feet(side):
        return spark.range(50).selectExpr("double(id * 1000) AS left", "0D AS bottom", f"id * 1000 + {side}D AS right", f"{side}D AS top")

    assert tiling.bucket_zoom(feet(4_000_000.0)) == 5 < tiling.bucket_zoom(feet(50_000.0)) < tiling.bucket_zoom(feet(3_000.0)) <= 14
    assert tiling.bucket_zoom(feet(1.0).where("false")) == 5
    tiles = tiling.tile_cover_metres(spark, (0.0, 0.0, 60_000.0, 60_000.0), 3, 12)
    rows = [sorted(map(tuple, tiling.overlap_join(tiles, feet(3_000.0), bucket=b).select("z", "x", "y", "left").collect())) for b in (5, 9, None)]
    assert rows[0] == rows[1] == rows[2]


def test_union_metadata_without_tiles(spark):
    rows = spark.createDataFrame([(0, "bounds", "1,2,3,4"), (0, "minzoom", "4"), (1, "name", "late"), (1, "attribution", " ")], "src_idx int, name string, value string")
    none = archive.tile_stats(spark.createDataFrame([], "z int, x int, y int"))
    told = {r.name: r.value for r in archive.union_metadata(rows, none, "out", "whose").collect()}
    assert told == {"name": "out", "format": "webp", "encoding": "terrarium", "minzoom": "4", "maxzoom": "0", "attribution": "whose", "bounds": "1,2,3,4"}
    told = {r.name: r.value for r in archive.union_metadata(rows.where("false"), none, "out").collect()}
    assert told["minzoom"] == "0" and "bounds" not in told and "center" not in told


def test_small_operators(spark, store, tmp_path):
    meta = spark.createDataFrame([("a", "1"), ("b", "2")], "name string, value string")
    assert {tuple(r) for r in archive.upsert_metadata(meta, {"b": 3, "c": None}).collect()} == {("a", "1"), ("b", "3"), ("c", "None")}
    assert {r.source for r in catalog.source_names(spark, store).collect()} == {"fine", "coarse"}
    got = files.folder_size(spark, f"{store}/fine", "*.tif").first()
    assert (got.files, got.bytes) == (1, os.path.getsize(f"{store}/fine/a.tif"))
    grids = spark.createDataFrame([(1, 0, 0, 0, [1.0, None]), (1, 0, 0, 1, [None, 2.0]), (1, 0, 1, 0, [None, None])], "z int, x int, y int, prio int, px array<float>")
    assert [(r.y, r.px, r.prov) for r in merge.merge_grids(grids, ["prio"]).collect()] == [(0, [1.0, 2.0], [0, 1])]
    assert [(r.y, r.px) for r in merge.max_grids(grids).collect()] == [(0, [1.0, 2.0])]


def test_webp_branch_with_a_stub(monkeypatch):
    """Pillow isn't here: a stand-in shows that lossless WebP is asked for, and that its bytes are told from PNG."""

    class Picture:
        kept = {}

        def __init__(self, x):
            self.x = x

        def save(self, out, kind, **options):
            Picture.kept.update(options, kind=kind)
            out.write(b"RIFF" + bytes(self.x.shape) + self.x.tobytes())

        def convert(self, mode):
            return np.concatenate([self.x, np.full((*self.x.shape[:2], 1), 255, np.uint8)], axis=2)

    class Image:
        fromarray = staticmethod(Picture)

        @staticmethod
        def open(f):
            raw = f.read()
            h, w, bands = raw[4:7]
            return Picture(np.frombuffer(raw[7:], np.uint8).reshape(h, w, bands))

    monkeypatch.setattr(codec, "Image", Image)
    x = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    data = codec.encode(x, method=3)
    assert Picture.kept == {"kind": "WEBP", "lossless": True, "method": 3, "exact": True}
    assert codec.image_format() == "webp" and (codec.decode(data)[:, :, :3] == x).all()
    assert codec.encode(x, image="png").startswith(b"\x89PNG")


def test_commands_of_runs(spark, store, tmp_path, capsys):
    from hypso import __main__ as cli

    def call(*argv):
        cli.run(spark, cli.parser().parse_args([str(a) for a in argv]))
        return capsys.readouterr().out

    at = tmp_path / "a.mbtiles"
    assert "candidates" in call("aggregate", "fine", "coarse", "--root", store, "--min-zoom", 7, "--max-zoom", 7, "--output", at)
    assert "pixels" in call("lineage-tile", "fine", "--root", store, "--tile", "9/454/201", "--size", 8)
    assert "valid_pixels" in call("fill", "fine", "coarse", "--root", store, "--tile", "7/113/50", "--archive", at)
    assert "tms_y" in call("sample", at, "--most", 3)
    assert "subtree_z6_x56_y25_z6-7" in call("subtree", "fine", "--root", store, "--tiles", "6/56/25", "--min-zoom", 6, "--max-zoom", 7, "--folder", tmp_path)
    call("merge-pixelwise", at, "--output", tmp_path / "m.pmtiles", "--mode", "priority")
    assert spark.read.format("pmtiles").load(str(tmp_path / "m.pmtiles")).count() == spark.read.format("mbtiles").load(str(at)).count()
