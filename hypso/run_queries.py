"""Queries that go through whole runs: rasters and archives are written to the shared folder and read again.

The rasters are the same whatever the table: two of 64 x 64 pixels, the better with a hole, whose every sampled pixel SQL
can place by arithmetic.
"""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import folders
from .functions.terrarium import PALETTE
from .operators import archive, inspection, raster
from .plans import tiling_job, zoom_split
from .queries import CE, FOOT, GRID, HALF, LOG, _cells_sql, _payloads, footprints, logs, query
from .sources import catalog, geotiff

LEFT, TOP, STEP, PIXELS, SIZE = 15_500_000, 4_260_000, 500, 64, 32
BETTER, WORSE = "fine", "coarse"


def rasters(spark: SparkSession) -> str:
    """The sources' folder, with catalogues that also name a raster that isn't there and one without bounds."""
    root = folders.local(spark, "rasters")
    cols, rows = np.meshgrid(np.arange(float(PIXELS)), np.arange(float(PIXELS)))
    for name, base, hole in ((BETTER, 200.0, True), (WORSE, 500.0, False)):
        os.makedirs(f"{root}/{name}")
        grid = base + cols + 2 * rows
        if hole:
            grid[20:40, 20:40] = -9999
        geotiff.write(f"{root}/{name}/a.tif", grid, LEFT, TOP, STEP, nodata=-9999)
        scanned = catalog.scan_rasters(spark, f"{root}/{name}")
        gone = scanned.withColumn("filename", F.lit("gone.tif"))
        endless = scanned.withColumns({"filename": F.lit("endless.tif"), "left": F.lit(float("-inf"))})
        catalog.write_bounds(scanned.unionByName(gone).unionByName(endless), f"{root}/{name}/bounds.csv")
    return root


def _sampled(low: int, high: int) -> str:
    """CTEs up to ``v`` (z, x, y, i, prov): the tiles that the rasters touch, and which of them gives each pixel (-1: none)."""
    right, bottom = LEFT + STEP * PIXELS, TOP - STEP * PIXELS
    inside = f"r >= -0.5 AND r <= {PIXELS - 0.5} AND c >= -0.5 AND c <= {PIXELS - 0.5}"
    near = lambda n: f"round_even(least({PIXELS - 1}, greatest(0, {n})), 0) BETWEEN 20 AND 39"
    return f"""s AS (SELECT z, {CE} / (1::BIGINT << z) AS side FROM (SELECT unnest(range({low}, {high + 1}))::INT AS z)), t AS (SELECT z, side, unnest(range(floor(({LEFT} + {HALF}) / side)::INT, floor(({right} + {HALF}) / side)::INT + 1))::INT AS x FROM s),
  u AS (SELECT z, side, x, unnest(range(floor(({HALF} - {TOP}) / side)::INT, floor(({HALF} - {bottom}) / side)::INT + 1))::INT AS y FROM t), p AS (SELECT *, unnest(range(0, {SIZE * SIZE})) AS i FROM u),
  g AS (SELECT z, x, y, i, ({TOP} - ({HALF} - y * side - (i // {SIZE} + 0.5) * side / {SIZE})) / {STEP} - 0.5 AS r, (x * side - {HALF} + (i % {SIZE} + 0.5) * side / {SIZE} - {LEFT}) / {STEP} - 0.5 AS c FROM p),
  v AS (SELECT z, x, y, i, CASE WHEN NOT ({inside}) THEN -1 WHEN {near("r")} AND {near("c")} THEN 1 ELSE 0 END AS prov FROM g)"""


_CODE = "CASE prov " + " ".join(f"WHEN {i} THEN {r * 256 + g + b / 256 - 32768}::DOUBLE" for i, (r, g, b) in PALETTE.items() if i < 2) + " END"
_COLOURS = f"SELECT z, x, y, {_CODE} AS code, count(*) AS n FROM v SEMI JOIN (SELECT z, x, y FROM v GROUP BY ALL HAVING max(prov) >= 0) k USING (z, x, y) GROUP BY ALL"
_FILLED = "SELECT z, x, y, count(*) AS n FROM v WHERE prov >= 0 GROUP BY ALL"


def _colours(tiles: DataFrame) -> DataFrame:
    """Pixels of each colour on each tile, the colour as one number."""
    rows = raster.decode_tiles(tiles).select("z", "x", "y", F.explode("px").alias("v"))
    return rows.groupBy("z", "x", "y", F.col("v").cast("double").alias("code")).agg(F.count("*").alias("n"))


def _filled(tiles: DataFrame) -> DataFrame:
    """Pixels with an elevation on each tile; no data is encoded as 0 m."""
    rows = raster.decode_tiles(tiles).select("z", "x", "y", F.explode("px").alias("v"))
    return rows.where("v <> 0").groupBy("z", "x", "y").agg(F.count("*").alias("n"))


@query(f"WITH {_sampled(7, 9)} {_COLOURS}")
def aggregate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources to MBTiles, lineage and PMTiles; the lineage's colours are read back."""
    root = rasters(spark)
    tiling_job.aggregate(spark, root, [BETTER, WORSE], f"{root}/out.mbtiles", 7, 9, size=SIZE, lineage=True, pmtiles=True)
    return _colours(spark.read.format("pmtiles").load(f"{root}/out-lineage.pmtiles"))


@query(f"WITH {_sampled(7, 9)} SELECT (SELECT count(*) FROM (SELECT DISTINCT z, x, y FROM v)) AS checked, (SELECT count(*) FROM (SELECT z, x, y FROM v GROUP BY ALL HAVING max(prov) >= 0)) AS emitted")
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles that a run checked and emitted."""
    root = rasters(spark)
    counts = tiling_job.aggregate(spark, root, [BETTER, WORSE], f"{root}/out.mbtiles", 7, 9, size=SIZE)
    return spark.range(1).select(*(F.lit(counts[c]).cast("long").alias(c) for c in ("checked", "emitted")))


@query(f"WITH {_sampled(0, 9)} {_COLOURS}")
def split_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run by zoom groups, merged, with the lineage of the whole."""
    root = rasters(spark)
    tiling_job.aggregate_split(spark, root, [BETTER, WORSE], f"{root}/out.pmtiles", "safe", 9, size=SIZE, lineage=True)
    return _colours(spark.read.format("pmtiles").load(f"{root}/out-lineage.pmtiles"))


@query(f"WITH {_sampled(6, 9)} {_FILLED} HAVING x >> (z - 6) = 56 AND y >> (z - 6) = 25")
def subtree_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = rasters(spark)
    made = tiling_job.aggregate_subtrees(spark, root, [BETTER, WORSE], root, [(56, 25)], 6, 9, size=SIZE)
    return _filled(spark.read.format("mbtiles").load(made[0]))


@query(f"WITH {_sampled(8, 9)} {_FILLED}")
def hybrid_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive for each source, then the larger of their pixels, as PMTiles."""
    root = rasters(spark)
    tiling_job.merge_hybrid(spark, root, [BETTER, WORSE], f"{root}/out.pmtiles", 8, 9, "max", size=SIZE)
    return _filled(spark.read.format("pmtiles").load(f"{root}/out.pmtiles"))


@query(f"WITH {_sampled(8, 9)} {_FILLED}")
def convert_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raster to PMTiles."""
    root = rasters(spark)
    tiling_job.convert(spark, f"{root}/{WORSE}/a.tif", f"{root}/out.pmtiles", 8, 9, size=SIZE)
    return _filled(spark.read.format("pmtiles").load(f"{root}/out.pmtiles"))


@query(f"""SELECT source, priority, 'a.tif' AS filename, {LEFT}::DOUBLE AS "left", {TOP - STEP * PIXELS}::DOUBLE AS bottom, {LEFT + STEP * PIXELS}::DOUBLE AS "right", {TOP}::DOUBLE AS top, {PIXELS} AS width, {PIXELS} AS height, {STEP}::DOUBLE AS pixel_size
  FROM (VALUES ('{BETTER}', 0), ('{WORSE}', 1)) t(source, priority)""")
def catalogue_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers to catalogues to footprints: rows without finite bounds, and of rasters that aren't there, are passed over."""
    records = catalog.records(spark, rasters(spark), [BETTER, WORSE])
    return records.select("source", "priority", "filename", "left", "bottom", "right", "top", "width", "height", "pixel_size")


@query(f"WITH {_sampled(9, 9)} SELECT {_CODE} AS code, count(*) AS n FROM v WHERE x = 454 AND y = 201 GROUP BY ALL")
def lineage_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tile's sources as an image."""
    image = tiling_job.lineage_tile(spark, rasters(spark), [BETTER, WORSE], 9, 454, 201, size=SIZE).astype(float)
    codes, counts = np.unique(image[:, :, 0] * 256 + image[:, :, 1] + image[:, :, 2] / 256 - 32768, return_counts=True)
    return spark.createDataFrame([(float(c), int(n)) for c, n in zip(codes, counts, strict=True)], "code double, n long")


@query(f"""WITH {_sampled(9, 9)}, w AS (SELECT * FROM v WHERE x = 454 AND y = 201)
  SELECT '{BETTER}' AS source, count(*) FILTER (WHERE prov = 0) AS valid_pixels, count(*) FILTER (WHERE prov <> 0) AS filled_pixels, 0::BIGINT AS candidates FROM w
  UNION ALL SELECT '{WORSE}', count(*) FILTER (WHERE prov >= 0), count(*) FILTER (WHERE prov < 0), count(*) FILTER (WHERE prov = 1) FROM w""")
def fill_of_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How an archive's tile was filled, asked for by its mirrored row."""
    root = rasters(spark)
    tiling_job.aggregate(spark, root, [BETTER, WORSE], f"{root}/out.mbtiles", 9, 9, size=SIZE)
    told = tiling_job.inspect_fill(spark, f"{root}/out.mbtiles", root, [BETTER, WORSE], 9, 454, 511 - 201, SIZE)
    return told.select("source", "valid_pixels", "filled_pixels", "candidates")


_TILES = f"WITH {GRID}, k AS (SELECT DISTINCT z, x, y FROM grid)"


@query(f"""{_TILES} SELECT 'keys' AS name, count(*)::VARCHAR AS value FROM k UNION ALL SELECT 'name', 'grids' UNION ALL SELECT 'minzoom', min(z)::VARCHAR FROM k UNION ALL SELECT 'maxzoom', max(z)::VARCHAR FROM k
  UNION ALL SELECT 'encoding', 'terrarium' UNION ALL SELECT 'note', 'of tests' UNION ALL SELECT 'finalize', count(*)::VARCHAR FROM k UNION ALL SELECT 'commit', count(*)::VARCHAR FROM k UNION ALL SELECT 'sample', least(32, count(*))::VARCHAR FROM k""")
def archive_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies in an MBTiles archive besides tiles, and beside it: keys, metadata, the writer's log, the sample."""
    at = f"{folders.local(spark, 'tiles')}/tiles.mbtiles"
    tiling_job.write_mbtiles(_payloads(spark, sf_dir), at, "grids", {"note": "of tests"})
    told = spark.read.format("mbtiles").option("table", "metadata").load(at).where("name IN ('name', 'minzoom', 'maxzoom', 'encoding', 'note')")
    keys = spark.read.format("mbtiles").option("table", "keys").load(at).select(F.lit("keys").alias("name"), F.count("*").over(_all()).cast("string").alias("value")).limit(1)
    events = spark.read.json(f"{at}.writer.log").groupBy(F.col("event").alias("name")).agg(F.when(F.first("event") == "commit", F.sum("batch_committed")).otherwise(F.max("insert_count")).cast("string").alias("value"))
    sample = spark.read.option("multiLine", "true").json(f"{at}.sample.json").agg(F.lit("sample").alias("name"), F.count("*").cast("string").alias("value"))
    return told.unionByName(keys).unionByName(events).unionByName(sample.select("name", "value"))


def _all():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))


@query(f"{_TILES} SELECT count(*) AS addressed, min(z)::BIGINT AS min_zoom, max(z)::BIGINT AS max_zoom, 3::BIGINT AS version, 1::BIGINT AS clustered, min(z)::BIGINT AS center_zoom FROM k")
def pmtiles_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = f"{folders.local(spark, 'tiles')}/tiles.pmtiles"
    tiling_job.write_pmtiles(_payloads(spark, sf_dir), at)
    return spark.read.format("pmtiles").option("table", "header").load(at).select("addressed", "min_zoom", "max_zoom", "version", "clustered", "center_zoom")


_LISTED = f"""WITH {FOOT}, c AS (SELECT replace(source, ' ', '_') AS source, 6 AS z, {_cells_sql("6")} FROM foot), c2 AS (SELECT source, z, y0, y1, unnest(range(x0, x1 + 1))::INT AS x FROM c),
  c3 AS (SELECT DISTINCT source, z, x, unnest(range(y0, y1 + 1))::INT AS y FROM c2)"""


@query(_LISTED + " SELECT x, y, z, count(*) AS source_count, array_to_string(list_sort(list(source))[1:2], ';') AS sources FROM c3 GROUP BY x, y, z")
def subtree_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogues by source to the lists of subtrees, read back from the CSV."""
    root = folders.local(spark, "lists")
    rows = footprints(spark, sf_dir).withColumns({"source": F.replace("source", F.lit(" "), F.lit("_")), "filename": F.concat(F.col("fid").cast("string"), F.lit(".tif"))})
    names = sorted(r["source"] for r in rows.select("source").distinct().collect())  # as many as regions
    for n in names:
        rows.where(F.col("source") == n).select(*catalog.NEEDED).coalesce(1).write.csv(f"{root}/{n}/bounds.csv", header=True)
    tiling_job.subtree_list(spark, root, names, f"{root}/out", most=2)
    return spark.read.schema("x int, y int, z int, source_count bigint, sources string").csv(f"{root}/out/subtrees.csv", header=True)


@query(f"""WITH {LOG}, a AS (SELECT *, max(t) OVER (PARTITION BY event) AS last FROM log), b AS (SELECT * FROM a WHERE t >= last - 3600000), d AS (SELECT event, first(v ORDER BY t, v) AS v0, first(v ORDER BY t DESC, v DESC) AS v1, min(t) AS t0, max(t) AS t1 FROM b GROUP BY ALL)
  SELECT event, 1000000 / ((v1 - v0) / (t1 - t0)) AS eta FROM d WHERE t1 > t0 AND v1 > v0""")
def eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds to go at the rate of the last stretch, where there is progress."""
    rates = inspection.recent_rate(logs(spark, sf_dir), ["event"], seconds=3_600_000)
    return rates.where("rate > 0").select("event", inspection.eta_seconds(F.col("rate"), F.lit(1_000_000)).alias("eta"))


def _rows_sql(lat: str) -> str:
    return f"(1 - ln(tan(radians({lat}::DOUBLE)) + 1 / cos(radians({lat}::DOUBLE))) / pi()) / 2 * (1::BIGINT << z)"


@query(f"""WITH RECURSIVE c AS (SELECT z::INT AS z, (greatest(1, ceil((154.0 - 122.0)::DOUBLE / 360 * (1::BIGINT << z))) * greatest(1, ceil(abs({_rows_sql("24.0")} - {_rows_sql("46.0")}))))::BIGINT AS tiles FROM (SELECT unnest(range(0, 17)) AS z)),
  r AS (SELECT 0 AS z, 0 AS low, tiles AS acc, 4 + tiles / 1e6 * 2 >= 10 AS closed FROM c WHERE z = 0 UNION ALL
        SELECT c.z, CASE WHEN closed THEN c.z ELSE low END, CASE WHEN closed THEN tiles ELSE acc + tiles END, 4 + CASE WHEN closed THEN tiles ELSE acc + tiles END / 1e6 * 2 >= 10 OR c.z = 16 FROM r JOIN c ON c.z = r.z + 1)
  SELECT low AS min_zoom, z AS max_zoom, acc AS tiles FROM r WHERE closed""")
def custom_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zoom groups by a target of memory."""
    groups = zoom_split.custom_split(spark, 16, 10.0)
    return spark.createDataFrame([(g.min_zoom, g.max_zoom, g.estimated_tiles) for g in groups], "min_zoom int, max_zoom int, tiles long")


@query(f"WITH {GRID} SELECT DISTINCT z, x FROM grid")
def distinct_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct zooms and columns of an archive, from its key index."""
    at = f"{folders.local(spark, 'tiles')}/tiles.mbtiles"
    tiling_job.write_mbtiles(_payloads(spark, sf_dir), at, "grids", sidecar=False)
    return archive.key_union([spark.read.format("mbtiles").option("table", "keys").option("tilesperpartition", "20").load(at)]).select("z", "x").distinct()
