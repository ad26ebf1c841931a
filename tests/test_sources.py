import json
import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from hypso.operators import archive, raster
from hypso.plans import tiling_job
from hypso.sources import catalog, codec, geotiff
from hypso.streaming import telemetry


def test_codec_round_trip_and_threads():
    x = np.zeros((64, 64, 4), np.uint8)
    x[:] = (100, 150, 200, 255)
    assert (codec.decode(codec.encode(x)) == x).all()
    rgb = np.random.default_rng(1).integers(0, 256, (37, 21, 3), dtype=np.uint8)
    assert (codec.decode(codec.png_encode(rgb))[:, :, :3] == rgb).all()
    with ThreadPoolExecutor(8) as pool:
        assert all((codec.decode(b) == x).all() for b in pool.map(codec.encode, [x] * 16))


def test_png_filters():
    import struct
    import zlib

    rng = np.random.default_rng(3)
    x = rng.integers(0, 256, (5, 8, 3), dtype=np.uint8)
    flat = x.reshape(5, -1).astype(int)
    body = b""
    for i, kind in enumerate((0, 1, 2, 3, 4)):
        up = flat[i - 1] if i else np.zeros(24, int)
        left = np.concatenate([[0, 0, 0], flat[i][:-3]])
        corner = np.concatenate([[0, 0, 0], up[:-3]])
        p = left + up - corner
        paeth = np.where((abs(p - left) <= abs(p - up)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - up) <= abs(p - corner), up, corner))
        guess = (0, left, up, (left + up) // 2, paeth)[kind]
        body += bytes([kind]) + ((flat[i] - guess) & 255).astype(np.uint8).tobytes()
    png = codec._PNG + codec._chunk(b"IHDR", struct.pack(">IIBBBBB", 8, 5, 8, 2, 0, 0, 0)) + codec._chunk(b"IDAT", zlib.compress(body)) + codec._chunk(b"IEND", b"")
    assert (codec.png_decode(png) == x).all()


def test_effort(monkeypatch):
    monkeypatch.setenv("HYPSO_WEBP_METHOD", "nonsense")
    assert codec.effort() == 6
    assert codec.effort(2) == 2


def payloads(spark, rows):
    return spark.createDataFrame(rows, "z int, x int, y int, tile_data binary")


def test_mbtiles(spark, tmp_path):
    at = str(tmp_path / "a.mbtiles")
    tiling_job.write_mbtiles(payloads(spark, [(5, 10, 12, b"x"), (6, 20, 15, b"y"), (6, 20, 15, b"y")]), at, "a", {"note": "n"})
    df = spark.read.format("mbtiles").load(at)
    assert sorted((r.z, r.x, r.y, bytes(r.tile_data)) for r in df.collect()) == [(5, 10, 12, b"x"), (6, 20, 15, b"y")]
    assert [tuple(r)[:3] for r in df.where("z = 6 AND x IN (20, 21) AND y >= 15").collect()] == [(6, 20, 15)]
    assert spark.read.format("mbtiles").option("table", "keys").load(at).count() == 2
    told = {r.name: r.value for r in spark.read.format("mbtiles").option("table", "metadata").load(at).collect()}
    assert (told["minzoom"], told["maxzoom"], told["note"]) == ("5", "6", "n")
    import sqlite3

    assert sqlite3.connect(at).execute("SELECT tile_row FROM tiles WHERE zoom_level = 5").fetchone() == (31 - 12,)
    with pytest.raises(FileExistsError):
        tiling_job.write_mbtiles(payloads(spark, []), at, "a")
    payloads(spark, [(5, 10, 12, b"new")]).write.format("mbtiles").mode("append").save(at)
    assert bytes(spark.read.format("mbtiles").load(at).where("z = 5").first().tile_data) == b"new"
    payloads(spark, [(5, 10, 12, b"late"), (7, 1, 1, b"q")]).write.format("mbtiles").option("onconflict", "ignore").mode("append").save(at)
    got = {r.z: bytes(r.tile_data) for r in spark.read.format("mbtiles").load(at).collect()}
    assert got == {5: b"new", 6: b"y", 7: b"q"}


def test_merge_archives(spark, tmp_path):
    a, b, c = (str(tmp_path / f"{n}.mbtiles") for n in "abc")
    tiling_job.write_mbtiles(payloads(spark, [(5, 10, 12, b"x")]), a, "a", {"attribution": "B "})
    tiling_job.write_mbtiles(payloads(spark, [(6, 20, 15, b"x")]), b, "b", {"attribution": "A"})
    tiling_job.merge_archives(spark, [a, b], c)
    told = {r.name: r.value for r in spark.read.format("mbtiles").option("table", "metadata").load(c).collect()}
    assert (told["name"], told["minzoom"], told["maxzoom"], told["attribution"]) == ("a", "5", "6", "A | B")
    with pytest.raises(ValueError):
        tiling_job.merge_archives(spark, [a, a], c, overwrite=True)


def test_pmtiles(spark, tmp_path):
    at = str(tmp_path / "a.pmtiles")
    rows = [(z, x, y, b"same" if z == 3 else f"{z}/{x}/{y}".encode()) for z in range(5) for x in range(1 << z) for y in range(1 << z)]
    tiling_job.write_pmtiles(payloads(spark, rows[::-1]), at, {"name": "n", "minzoom": "0", "bounds": "1,2,3,4"})
    got = {(r.z, r.x, r.y): bytes(r.tile_data) for r in spark.read.format("pmtiles").option("entriesperpartition", "50").load(at).collect()}
    assert got == {r[:3]: r[3] for r in rows}
    h = spark.read.format("pmtiles").option("table", "header").load(at).first()
    assert (h.addressed, h.min_zoom, h.max_zoom, h.min_lon_e7, h.center_lat_e7) == (len(rows), 0, 4, 10_000_000, 30_000_000)
    assert h.entries == len(rows) - 63
    assert {r.name: r.value for r in spark.read.format("pmtiles").option("table", "metadata").load(at).collect()}["name"] == "n"


def test_pmtiles_leaves(spark, tmp_path):
    at = str(tmp_path / "big.pmtiles")
    rng = np.random.default_rng(2)
    keys = sorted({(12, int(x), int(y)) for x, y in rng.integers(0, 4096, (20000, 2))})
    df = payloads(spark, [(*k, bytes(f"{k}" * int(1 + k[1] % 3), "ascii")) for k in keys])
    tiling_job.write_pmtiles(df, at)
    assert spark.read.format("pmtiles").option("table", "header").load(at).first().leaf_length > 0
    assert archive.archive_diff(df, spark.read.format("pmtiles").load(at)).where("status <> 'matched'").count() == 0


def test_geotiff_and_bilinear(tmp_path):
    cols, rows = np.meshgrid(np.arange(8.0), np.arange(6.0))
    plane = 10 + 2 * cols + 3 * rows
    plane[2, 2] = -1
    at = str(tmp_path / "a.tif")
    for compress in (True, False):
        geotiff.write(at, plane, 1000.0, 2000.0, 10.0, nodata=-1, compress=compress)
        data = open(at, "rb").read()
        h = geotiff.header(data)
        assert (h.width, h.height, h.crs, h.nodata, h.bounds) == (8, 6, 3857, -1.0, (1000.0, 1940.0, 1080.0, 2000.0))
        band = geotiff.band(data)
        assert np.isnan(band[2, 2]) and band[0, 1] == 12
    got = raster.bilinear(band, np.array([4.25]), np.array([5.5]))
    assert abs(got[0, 0] - (10 + 2 * 5.5 + 3 * 4.25)) < 1e-9
    assert np.isnan(raster.bilinear(band, np.array([2.1]), np.array([2.1]))[0, 0])
    assert np.isnan(raster.bilinear(band, np.array([9.0]), np.array([2.0]))[0, 0])
    assert (raster.bilinear(np.full((4, 4), 7.0), np.linspace(-0.5, 3.5, 9), np.linspace(-0.5, 3.5, 9)) == 7).all()


@pytest.fixture(scope="module")
def store(tmp_path_factory, spark):
    root = tmp_path_factory.mktemp("store")
    cols, rows = np.meshgrid(np.arange(64.0), np.arange(64.0))
    for name, base, hole in (("fine", 100.0, True), ("coarse", 500.0, False)):
        os.makedirs(root / name)
        grid = base + 0 * cols
        if hole:
            grid[20:40, 20:40] = -9999
        geotiff.write(str(root / name / "a.tif"), grid, 15_500_000.0, 4_260_000.0, 500.0, nodata=-9999)
        (root / name / "broken.tif").write_bytes(b"nothing")
        scanned = catalog.scan_rasters(spark, str(root / name))
        assert scanned.where("error IS NOT NULL").count() == 1
        catalog.write_bounds(scanned, str(root / name / "bounds.csv"))
    return str(root)


def test_whole_run(spark, store, tmp_path):
    target = str(tmp_path / "out.mbtiles")
    tiling_job.aggregate(spark, store, ["fine", "coarse"], target, 8, 9, size=32, lineage=True, pmtiles=True)
    df = raster.decode_tiles(spark.read.format("mbtiles").load(target))
    values = {r.v for r in df.select(F.explode("px").alias("v")).distinct().collect()}
    assert values == {0.0, 96.0, 100.0, 496.0, 500.0}  # zoom 8 rounds to 8 m, halves to even
    assert os.path.exists(str(tmp_path / "out.pmtiles")) and os.path.exists(str(tmp_path / "out-lineage.pmtiles"))
    a, b = (spark.read.format(f).load(str(tmp_path / f"out.{f}")) for f in ("mbtiles", "pmtiles"))
    assert archive.archive_diff(a, b).where("status <> 'matched'").count() == 0
    tiling_job.group_summary(spark, [target], str(tmp_path / "summary"))
    assert spark.read.csv(str(tmp_path / "summary"), header=True).first().min_zoom == "8"
    sample = tiling_job.flip_sample(a.select("z", "x", "y")).collect()
    assert 0 < len(sample) <= 32 and all(r.tms_y == 2**r.z - 1 - r.y for r in sample)
    merged = tiling_job.merge_pixelwise(spark, [target, target], "max")
    assert archive.archive_diff(a, merged).where("status <> 'matched'").count() == 0
    assert tiling_job.merge_pixelwise(spark, [target], "priority").count() == a.count()


def test_convert_and_subtrees(spark, store, tmp_path):
    at = str(tmp_path / "c.pmtiles")
    tiling_job.convert(spark, f"{store}/coarse/a.tif", at, 8, 9, size=32)
    assert spark.read.format("pmtiles").load(at).count() > 0
    tiling_job.subtree_list(spark, store, ["fine", "coarse"], str(tmp_path / "list"), most=1)
    rows = [json.loads(x.value) for x in spark.read.text(str(tmp_path / "list/subtrees.json")).collect()]
    assert all(r["source_count"] == 2 and len(r["sources"]) == 1 for r in rows)
    assert tiling_job.parse_tile("6/1/2") == tiling_job.parse_tile("1/2") == (1, 2)
    with pytest.raises(ValueError):
        tiling_job.parse_tile("5/1/2")
    with pytest.raises(ValueError):
        tiling_job.check_zooms(3, 18)


def test_bad_catalogues(spark, tmp_path):
    (tmp_path / "bounds.csv").write_text("filename,left,bottom,right,top,width,height\na.tif,0,0,1,inf,5,5\nb.tif,0,0,10,10,5,5\nc.tif,x,0,1,1,5,5\n")
    assert [r.filename for r in catalog.read_bounds(spark, str(tmp_path / "bounds.csv"), "s").collect()] == ["b.tif"]
    (tmp_path / "short.csv").write_text("filename,left\na,1\n")
    with pytest.raises(ValueError, match="bottom"):
        catalog.read_bounds(spark, str(tmp_path / "short.csv"), "s")
    with pytest.raises(FileNotFoundError):
        catalog.read_bounds(spark, str(tmp_path / "none.csv"), "s")
    (tmp_path / "empty.csv").write_text("filename,left,bottom,right,top,width,height\na.tif,0,0,1,inf,5,5\n")
    with pytest.raises(RuntimeError):
        catalog.read_bounds(spark, str(tmp_path / "empty.csv"), "s")
    assert catalog.read_bounds_lenient(spark, str(tmp_path / "none.csv")).count() == 0
    assert catalog.read_bounds_lenient(spark, str(tmp_path / "bounds.csv")).count() == 2


def test_logs(spark, tmp_path):
    lines = [json.dumps({"event": "commit", "timestamp": f"2025-01-01T00:0{i}:00Z", "wal_bytes": 100 * i}) for i in range(3)]
    (tmp_path / "a.writer.log").write_text("\n".join([lines[0], "", "{broken", lines[1], lines[2]]))
    df = telemetry.read_log(spark, str(tmp_path))
    assert df.count() == 3
    assert telemetry.newest_log(spark, str(tmp_path)).endswith("a.writer.log")
    assert telemetry.windowed_progress(df, "5 minutes").first().n == 3


def test_retile(spark, tmp_path):
    (tmp_path / "in").mkdir()
    schema = "left double, bottom double, right double, top double, source string"
    spark.createDataFrame([(15_500_000.0, 4_200_000.0, 15_560_000.0, 4_260_000.0, "s")], schema).write.mode("append").parquet(str(tmp_path / "in"))
    seen = []
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    telemetry.retile(stream, lambda tiles, i: seen.append(tiles.count()), 8, str(tmp_path / "check")).awaitTermination()
    assert sum(seen) > 0


def lzw_encode(data):
    """Codes by the TIFF specification, for the decoder's test."""
    bits, table, w, width = [], {bytes([i]): i for i in range(256)}, b"", 9
    n = 258

    def put(code):
        bits.append(format(code, f"0{width}b"))

    put(256)
    for k in range(len(data)):
        c = data[k : k + 1]
        if w + c in table:
            w += c
            continue
        put(table[w])
        table[w + c] = n
        n += 1
        if n == 4095:
            put(256)
            table, n, width = {bytes([i]): i for i in range(256)}, 258, 9
        else:
            width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
        w = c
    put(table[w])
    n += 1
    width = 9 if n < 512 else 10 if n < 1024 else 11 if n < 2048 else 12
    put(257)
    raw = "".join(bits)
    raw += "0" * (-len(raw) % 8)
    return bytes(int(raw[i : i + 8], 2) for i in range(0, len(raw), 8))


def test_lzw():
    rng = np.random.default_rng(1)
    for data in (b"a", b"abababababab" * 50, rng.integers(0, 4, 30_000, dtype=np.uint8).tobytes(), rng.integers(0, 256, 20_000, dtype=np.uint8).tobytes()):
        assert geotiff._lzw(lzw_encode(data)) == data


def test_command_line(spark, store, tmp_path, capsys):
    from hypso import __main__ as cli

    def call(*argv):
        cli.run(spark, cli.parser().parse_args([str(a) for a in argv]))
        return capsys.readouterr().out

    call("bounds", f"{store}/fine", "--output", tmp_path / "b.csv")
    a = tmp_path / "a.mbtiles"
    tiling_job.write_mbtiles(payloads(spark, [(5, 10, 12, b"x")]), str(a), "a")
    call("pack", a, tmp_path / "a.pmtiles")
    assert "mismatch" not in call("compare", a, tmp_path / "a.pmtiles")
    assert "minzoom" in call("inspect", a) and "addressed" in call("inspect", tmp_path / "a.pmtiles")
    assert "z15-16" in call("patterns")
    assert "filled_by_lower" in call("fill", "fine", "coarse", "--root", store, "--tile", "9/453/201", "--size", "16")
    assert "sha256" in call("digest", tmp_path, "--glob", "*.mbtiles")
    (tmp_path / "x.log").write_text('{"timestamp": "2025-01-01T00:00:00Z", "wal_bytes": 0}\n{"timestamp": "2025-01-01T00:00:10Z", "wal_bytes": 100}\n')
    assert "90.0" in call("eta", tmp_path / "x.log", "--target-bytes", "1000")
