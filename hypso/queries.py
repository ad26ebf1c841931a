"""The tile engine's queries on the driver's tables, each with equivalent SQL.

There are no rasters in those tables, so their columns stand for pixels (lineitem), footprints (supplier and nation),
8 x 8 grids (embeddings), archives (orders), metadata (customer) and logs (events), by whole-number arithmetic that
any engine repeats exactly.
"""

from __future__ import annotations

import os
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import folders
from .functions import register as sql_functions
from .functions import terrarium
from .functions import tilemath as M
from .operators import archive, inspection, merge, raster, tiling
from .plans import tiling_job, zoom_split
from .schema import EARTH_CIRCUMFERENCE_M, JAPAN
from .sources import catalog, geotiff
from .streaming import telemetry

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

CE = f"{EARTH_CIRCUMFERENCE_M}::DOUBLE"
HALF = f"{EARTH_CIRCUMFERENCE_M / 2}::DOUBLE"
KEY = ["z", "x", "y", "row", "col"]
ORDER = ["prio", "o1", "o2", "o3", "o4"]

PIX = """pix AS (SELECT 12 AS z, (3600 + l_partkey % 16)::INT AS x, (1600 + l_orderkey % 16)::INT AS y, ((l_partkey // 16) % 8)::INT AS "row", (l_suppkey % 8)::INT AS "col",
  l_linenumber - 1 AS prio, CASE WHEN l_discount = 0.05::DOUBLE THEN NULL ELSE l_extendedprice / 64::DOUBLE - 400::DOUBLE END AS elev,
  l_orderkey AS o1, l_partkey AS o2, l_suppkey AS o3, l_extendedprice AS o4 FROM lineitem)"""
FOOT = """foot AS (SELECT s_suppkey AS fid, n_regionkey AS priority, r_name AS source,
  (13600000 + (s_suppkey * 7919 % 3000) * 1000)::DOUBLE AS "left", (2700000 + (s_suppkey * 104729 % 2500) * 1000)::DOUBLE AS bottom,
  (13600000 + (s_suppkey * 7919 % 3000) * 1000 + 20000 + (s_suppkey % 7) * 5000)::DOUBLE AS "right",
  (2700000 + (s_suppkey * 104729 % 2500) * 1000 + 20000 + (s_suppkey % 5) * 5000)::DOUBLE AS top,
  (500 + (s_suppkey % 3) * 250)::INT AS width, (500 + (s_suppkey % 3) * 250)::INT AS height
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
ARCH = """arch AS (SELECT (10 + o_orderkey % 3)::INT AS z, (800 + o_custkey % 64)::INT AS x, (300 + o_orderkey % 61)::INT AS y, (o_orderkey % 4)::INT AS src_idx,
  'part' || (o_orderkey % 4) AS file, o_orderpriority AS tile_data, o_orderkey AS ord FROM orders)"""
GRID = """grid AS (SELECT 8 AS z, (vec_id % 16)::INT AS x, ((vec_id // 16) % 8)::INT AS y, label AS prio, vec_id, embedding FROM embeddings)"""
LOG = """log AS (SELECT event_type AS event, user_id, event_id, floor(epoch(ts))::BIGINT AS t, value AS v FROM events)"""


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").selectExpr(
        "12 AS z", "int(3600 + l_partkey % 16) AS x", "int(1600 + l_orderkey % 16) AS y", "int((l_partkey div 16) % 8) AS row", "int(l_suppkey % 8) AS col", "l_linenumber - 1 AS prio",
        "CASE WHEN l_discount = 0.05D THEN NULL ELSE l_extendedprice / 64D - 400D END AS elev", "l_orderkey AS o1", "l_partkey AS o2", "l_suppkey AS o3", "l_extendedprice AS o4",
    )


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (_table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    rows = s.join(n, s["s_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
    rows = rows.selectExpr("s_suppkey AS fid", "n_regionkey AS priority", "r_name AS source", "double(13600000 + (s_suppkey * 7919 % 3000) * 1000) AS left", "double(2700000 + (s_suppkey * 104729 % 2500) * 1000) AS bottom")
    return rows.selectExpr("*", "left + 20000 + (fid % 7) * 5000 AS right", "bottom + 20000 + (fid % 5) * 5000 AS top", "int(500 + (fid % 3) * 250) AS width", "int(500 + (fid % 3) * 250) AS height")


def archive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr("int(10 + o_orderkey % 3) AS z", "int(800 + o_custkey % 64) AS x", "int(300 + o_orderkey % 61) AS y", "int(o_orderkey % 4) AS src_idx", "concat('part', o_orderkey % 4) AS file", "o_orderpriority AS tile_data", "o_orderkey AS ord")


def grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").selectExpr("8 AS z", "int(vec_id % 16) AS x", "int((vec_id div 16) % 8) AS y", "label AS prio", "vec_id", "transform(embedding, v -> if(abs(v) < 0.05, float(null), v)) AS px")


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").selectExpr("event_type AS event", "user_id", "event_id", "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(ts AS timestamp_ntz)) AS t", "value AS v")


_MERGED = f"""WITH {PIX}, m AS (SELECT z, x, y, "row", "col", first(elev ORDER BY prio, o1, o2, o3, o4) FILTER (WHERE elev IS NOT NULL) AS elev,
  coalesce(first(prio ORDER BY prio, o1, o2, o3, o4) FILTER (WHERE elev IS NOT NULL), -1)::INT AS prov FROM pix GROUP BY ALL)"""
_ENCODE = "o AS (SELECT *, round_even(coalesce(elev, 0::DOUBLE) / 0.5::DOUBLE, 0) * 0.5::DOUBLE + 32768 AS o FROM m)"


def merged_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.priority_merge(pixels(spark, sf_dir), KEY, ORDER)


@query(_MERGED + f""", {_ENCODE} SELECT z, x, y, "row", "col", elev, prov, least(255, greatest(0, floor(o / 256)))::INT AS r,
  floor(o - 256 * floor(o / 256))::INT AS g, floor((o - floor(o)) * 256)::INT AS b FROM o""")
def priority_merge_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.encoded(merged_pixels(spark, sf_dir))


def _channel(k: int) -> str:
    return "CASE prov " + " ".join(f"WHEN {i} THEN {rgb[k]}" for i, rgb in terrarium.PALETTE.items()) + " END"


@query(_MERGED + f' SELECT z, x, y, "row", "col", prov, {_channel(0)} AS r, {_channel(1)} AS g, {_channel(2)} AS b FROM m')
def lineage_palette(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merged_pixels(spark, sf_dir).withColumn("c", terrarium.palette_colour("prov"))
    return rows.select(*KEY, "prov", "c.r", "c.g", "c.b")


@query("SELECT i, (200 - i % 60)::INT AS r, (120 + (i * 37) % 120)::INT AS g, (100 + (i * 23) % 120)::INT AS b FROM (SELECT unnest(range(7, 200)) AS i)")
def palette_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.range(7, 200).select(F.col("id").alias("i"), terrarium.palette_colour("id").alias("c")).select("i", "c.r", "c.g", "c.b")


@query(f'WITH {PIX} SELECT z, x, y, "row", "col", max(elev) AS elev FROM pix GROUP BY ALL')
def pixel_max_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.max_merge(pixels(spark, sf_dir), KEY)


@query(_MERGED + " SELECT z, x, y, list_sort(list(DISTINCT prov))::VARCHAR AS provs FROM m GROUP BY ALL")
def tile_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct sources of a tile's pixels."""
    rows = merged_pixels(spark, sf_dir).groupBy("z", "x", "y").agg(F.sort_array(F.collect_set("prov")).alias("p"))
    return rows.select("z", "x", "y", F.concat(F.lit("["), F.array_join(F.col("p").cast("array<string>"), ", "), F.lit("]")).alias("provs"))


_BLOBS = f"""WITH {PIX}, blobs AS (SELECT z, x, y, prio AS src_idx, CASE WHEN (x + prio) % 5 = 0 THEN '' ELSE count(*) || ':' || max(o1) END AS tile_data FROM pix GROUP BY z, x, y, prio)"""


def _blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pixels(spark, sf_dir).groupBy("z", "x", "y", F.col("prio").alias("src_idx")).agg(F.concat_ws(":", F.count("*"), F.max("o1")).alias("d"))
    return rows.select("z", "x", "y", "src_idx", F.when((F.col("x") + F.col("src_idx")) % 5 == 0, "").otherwise(F.col("d")).alias("tile_data"))


@query(_BLOBS + " SELECT z, x, y, first(tile_data ORDER BY src_idx) AS tile_data, min(src_idx)::INT AS src_idx FROM blobs WHERE tile_data <> '' GROUP BY z, x, y")
def tile_priority_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.tile_priority(_blobs(spark, sf_dir))


@query(_BLOBS + " SELECT z, x, y, first(tile_data ORDER BY src_idx) AS tile_data, min(src_idx)::INT AS src_idx FROM blobs GROUP BY z, x, y")
def tile_priority_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty payloads count as present."""
    return merge.tile_priority(_blobs(spark, sf_dir), empty_is_missing=False)


@query(f"""WITH {PIX}, t AS (SELECT x, y, "row", "col", prio, elev, count(elev) OVER (PARTITION BY x, y, "row", prio) AS k FROM pix)
  SELECT x, y, "row", "col", prio, elev FROM t WHERE k > 0""")
def nodata_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pixels(spark, sf_dir).select("x", "y", "row", "col", "prio", "elev")
    return merge.drop_empty_tiles(rows, tile=("x", "y", "row", "prio"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS p, CASE WHEN l_quantity = 17::DOUBLE THEN NULL ELSE l_quantity END AS elev FROM lineitem")
def nodata_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("p"), merge.no_data(F.col("l_quantity"), 17.0).alias("elev"))


@query(f"""WITH {PIX} SELECT z, x, y, "row", "col", prio, o1, o2, o3, o4, row_number() OVER (PARTITION BY z, x, y, "row", "col" ORDER BY prio, o1, o2, o3, o4) AS rank FROM pix""")
def candidate_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.ranked_candidates(pixels(spark, sf_dir), ORDER, KEY).select(*KEY, *ORDER, "rank")


def _lat_row(lat: str, z: str) -> str:
    return f"floor((0.5::DOUBLE - 0.25::DOUBLE * ln((1 + sin(radians({lat}))) / (1 - sin(radians({lat})))) / pi() + 1e-14::DOUBLE) * (1::BIGINT << {z}))"


@query(f"""WITH b AS (SELECT z, floor((122.0::DOUBLE / 360 + 0.5 + 1e-14::DOUBLE) * (1::BIGINT << z))::INT AS x0, floor(((154.0::DOUBLE - 1e-11::DOUBLE) / 360 + 0.5 + 1e-14::DOUBLE) * (1::BIGINT << z))::INT AS x1,
  {_lat_row("46.0::DOUBLE", "z")}::INT AS y0, {_lat_row("24.0::DOUBLE + 1e-11::DOUBLE", "z")}::INT AS y1 FROM (SELECT unnest(range(0, 9))::INT AS z)),
  c AS (SELECT z, y0, y1, unnest(range(x0, x1 + 1))::INT AS x FROM b) SELECT z, x, unnest(range(y0, y1 + 1))::INT AS y FROM c""")
def tile_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.tile_cover(spark, JAPAN, 0, 8)


def _cells_sql(z: str) -> str:
    side = f"({CE} / (1::BIGINT << {z}))"
    edge = f"((1::BIGINT << {z}) - 1)"
    return (
        f"least({edge}, greatest(0, floor((\"left\" + {HALF}) / {side})))::INT AS x0, least({edge}, greatest(0, ceil((\"right\" + {HALF}) / {side}) - 1))::INT AS x1, "
        f"least({edge}, greatest(0, floor(({HALF} - top) / {side})))::INT AS y0, least({edge}, greatest(0, ceil(({HALF} - bottom) / {side}) - 1))::INT AS y1"
    )


EXTENT = (13_600_000.0, 2_700_000.0, 16_700_000.0, 5_300_000.0)
_TILES = f"""ext AS (SELECT unnest(range(0, 10))::INT AS z, {EXTENT[0]}::DOUBLE AS "left", {EXTENT[1]}::DOUBLE AS bottom, {EXTENT[2]}::DOUBLE AS "right", {EXTENT[3]}::DOUBLE AS top),
  e2 AS (SELECT z, {_cells_sql("z")} FROM ext), e3 AS (SELECT z, y0, y1, unnest(range(x0, x1 + 1))::INT AS x FROM e2), tiles AS (SELECT z, x, unnest(range(y0, y1 + 1))::INT AS y FROM e3)"""
_SIDE = f"({CE} / (1::BIGINT << z))"
_OVERLAP = f'"right" > x * {_SIDE} - {HALF} AND "left" < (x + 1) * {_SIDE} - {HALF} AND top > {HALF} - (y + 1) * {_SIDE} AND bottom < {HALF} - y * {_SIDE}'


def _tiles(spark: SparkSession) -> DataFrame:
    return tiling.tile_cover_metres(spark, EXTENT, 0, 9)


@query(f"WITH {_TILES} SELECT * FROM tiles")
def tile_cover_metres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tiles(spark)


@query(f"WITH {_TILES}, {FOOT} SELECT z, x, y, fid, priority FROM tiles JOIN foot ON {_OVERLAP}")
def bucket_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.overlap_join(_tiles(spark), footprints(spark, sf_dir)).select("z", "x", "y", "fid", "priority")


@query(f"WITH {_TILES}, {FOOT} SELECT z, x, y, fid, priority FROM tiles JOIN foot ON {_OVERLAP}")
def bucket_join_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join beyond the broadcast bound: both sides are shuffled by cell."""
    return tiling.overlap_join(_tiles(spark), footprints(spark, sf_dir), broadcast_rows=0).select("z", "x", "y", "fid", "priority")


@query(f"""WITH {_TILES}, {FOOT}, j AS (SELECT z, x, y, fid, row_number() OVER (PARTITION BY z, x, y ORDER BY priority, ("right" - "left") / width, fid) AS rank FROM tiles JOIN foot ON {_OVERLAP})
  SELECT * FROM j""")
def tile_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = footprints(spark, sf_dir).withColumn("px", (F.col("right") - F.col("left")) / F.col("width"))
    found = tiling.overlap_join(_tiles(spark), rows)
    return merge.ranked_candidates(found, ["priority", "px", "fid"]).select("z", "x", "y", "fid", "rank")


@query(f"""WITH {FOOT} SELECT fid, greatest("left", 14000000) AS l, greatest(bottom, 3000000) AS b, least("right", 16000000) AS r, least(top, 5000000) AS t FROM foot
  WHERE greatest("left", 14000000) < least("right", 16000000) AND greatest(bottom, 3000000) < least(top, 5000000)""")
def bbox_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    box = M.clip(("left", "bottom", "right", "top"), tuple(F.lit(float(v)) for v in (14000000, 3000000, 16000000, 5000000)))
    return footprints(spark, sf_dir).select("fid", *(c.alias(n) for c, n in zip(box, "lbrt", strict=True))).where("l < r AND b < t")


@query(f"WITH {FOOT} SELECT fid FROM foot WHERE fid % 11 <> 0 AND fid % 13 <> 0")
def finite_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.expr("CASE WHEN fid % 11 = 0 THEN double('Infinity') WHEN fid % 13 = 0 THEN double('NaN') ELSE left END")
    return footprints(spark, sf_dir).withColumn("left", broken).where(M.finite("left") & M.finite("top")).select("fid")


@query(f"""WITH {FOOT} SELECT fid, greatest(greatest(abs("right" - "left"), 1e-6::DOUBLE) / greatest(width, 1), greatest(abs(top - bottom), 1e-6::DOUBLE) / greatest(height, 1)) AS pixel_size FROM foot""")
def pixel_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return footprints(spark, sf_dir).select("fid", M.pixel_size("left", "bottom", "right", "top", "width", "height").alias("pixel_size"))


@query(f'WITH {FOOT} SELECT min("left") AS "left", min(bottom) AS bottom, max("right") AS "right", max(top) AS top FROM foot')
def union_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.union_bounds(footprints(spark, sf_dir))


@query(f"""WITH {FOOT} SELECT least(17, greatest(0, ceil(log2({CE} / 512 / min(greatest(("right" - "left") / width, (top - bottom) / height))))))::INT AS max_zoom FROM foot""")
def finest_zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.finest_zoom(footprints(spark, sf_dir).withColumn("pixel_size", M.pixel_size("left", "bottom", "right", "top", "width", "height")))


@query(f"WITH {_TILES} SELECT z, count(*) AS n FROM tiles GROUP BY ROLLUP (z)")
def tiles_per_zoom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.tiles_per_zoom(_tiles(spark))


def _lat_sql(row: str) -> str:
    return f"degrees(atan((exp(pi() * (1 - 2 * ({row})::DOUBLE / (1::BIGINT << z))) - exp(-pi() * (1 - 2 * ({row})::DOUBLE / (1::BIGINT << z)))) / 2))"


@query(f"""WITH {ARCH} SELECT count(*) AS n, min(z) AS min_zoom, max(z) AS max_zoom, round(min(x / (1::BIGINT << z)::DOUBLE * 360 - 180), 7) AS west, round(min({_lat_sql("y + 1")}), 7) AS south,
  round(max((x + 1) / (1::BIGINT << z)::DOUBLE * 360 - 180), 7) AS east, round(max({_lat_sql("y")}), 7) AS north FROM arch""")
def tile_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = archive.tile_stats(archive_rows(spark, sf_dir))
    return s.select("n", "min_zoom", "max_zoom", *(F.round(c, 7).alias(c) for c in ("west", "south", "east", "north")))


@query(f"WITH {ARCH} SELECT z, x, y, ord, ((1::BIGINT << z) - 1 - y)::INT AS tms_y FROM arch")
def tms_flip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_rows(spark, sf_dir).select("z", "x", "y", "ord", M.flip_y("z", "y").alias("tms_y"))


@query(f"WITH {ARCH} SELECT z, x, y, ord, x >> (z - 5) AS px, y >> (z - 5) AS py FROM arch")
def parent_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_rows(spark, sf_dir).select("z", "x", "y", "ord", M.parent("x", "z", 5).alias("px"), M.parent("y", "z", 5).alias("py"))


@query("SELECT l_orderkey, l_partkey, l_suppkey, (l_partkey % 256) * 256.0::DOUBLE + l_suppkey % 256 + (l_orderkey % 256) / 256.0::DOUBLE - 32768 AS elev FROM lineitem")
def terrarium_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", terrarium.decode(F.expr("l_partkey % 256"), F.expr("l_suppkey % 256"), F.expr("l_orderkey % 256")).alias("elev"))


@query("""WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, (l_orderkey % 18)::INT AS z, l_extendedprice - 30000 AS e FROM lineitem),
  o AS (SELECT *, round_even(e / (2::DOUBLE ^ (19 - z) / 256), 0) * (2::DOUBLE ^ (19 - z) / 256) + 32768 AS o FROM v)
  SELECT l_orderkey, l_linenumber, l_partkey, e, z, least(255, greatest(0, floor(o / 256)))::INT AS r, floor(o - 256 * floor(o / 256))::INT AS g, floor((o - floor(o)) * 256)::INT AS b FROM o""")
def terrarium_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey", "int(l_orderkey % 18) AS z", "l_extendedprice - 30000 AS e")
    return rows.withColumns(terrarium.encode("e", "z"))


@query("SELECT z::INT AS z, 2::DOUBLE ^ (19 - z) / 256 AS metres FROM (SELECT unnest(range(0, 18)) AS z)")
def vertical_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.zooms(spark, 0, 17).select("z", terrarium.vertical_resolution("z").alias("metres"))


@query(f"""WITH {ARCH} SELECT DISTINCT z, x, y, round(x / (1::BIGINT << z)::DOUBLE * 360 - 180, 7) AS west, round({_lat_sql("y + 1")}, 7) AS south, round((x + 1) / (1::BIGINT << z)::DOUBLE * 360 - 180, 7) AS east,
  round({_lat_sql("y")}, 7) AS north, round(x * ({CE} / (1::BIGINT << z)) - {HALF}, 4) AS "left", round({HALF} - y * ({CE} / (1::BIGINT << z)), 4) AS top FROM arch""")
def tile_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = archive_rows(spark, sf_dir).select("z", "x", "y").distinct()
    d, m = M.lonlat_bounds("z", "x", "y"), M.mercator_bounds("z", "x", "y")
    return keys.select("z", "x", "y", *(F.round(d[c], 7).alias(c) for c in ("west", "south", "east", "north")), *(F.round(m[c], 4).alias(c) for c in ("left", "top")))


@query(f"""WITH RECURSIVE {ARCH}, k AS (SELECT DISTINCT z, x, y FROM arch), h AS (SELECT z, x, y, x::BIGINT AS cx, y::BIGINT AS cy, z - 1 AS a, ((1::BIGINT << (2 * z)) - 1) // 3 AS d FROM k
  UNION ALL SELECT z, x, y, CASE WHEN (cy >> a) & 1 = 1 THEN cx & ((1::BIGINT << a) - 1) WHEN (cx >> a) & 1 = 1 THEN (1::BIGINT << a) - 1 - (cy & ((1::BIGINT << a) - 1)) ELSE cy & ((1::BIGINT << a) - 1) END,
  CASE WHEN (cy >> a) & 1 = 1 THEN cy & ((1::BIGINT << a) - 1) WHEN (cx >> a) & 1 = 1 THEN (1::BIGINT << a) - 1 - (cx & ((1::BIGINT << a) - 1)) ELSE cx & ((1::BIGINT << a) - 1) END, a - 1,
  d + (xor(3 * ((cx >> a) & 1), (cy >> a) & 1) << (2 * a)) FROM h WHERE a >= 0)
  SELECT z, x, y, d AS tile_id FROM h WHERE a = -1""")
def hilbert_tile_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_rows(spark, sf_dir).select("z", "x", "y").distinct().withColumn("tile_id", M.tile_id("z", "x", "y"))


@query(f"""WITH RECURSIVE {ARCH}, k AS (SELECT DISTINCT z, x, y FROM arch), h AS (SELECT z, x, y, x::BIGINT AS cx, y::BIGINT AS cy, z - 1 AS a, ((1::BIGINT << (2 * z)) - 1) // 3 AS d FROM k
  UNION ALL SELECT z, x, y, CASE WHEN (cy >> a) & 1 = 1 THEN cx & ((1::BIGINT << a) - 1) WHEN (cx >> a) & 1 = 1 THEN (1::BIGINT << a) - 1 - (cy & ((1::BIGINT << a) - 1)) ELSE cy & ((1::BIGINT << a) - 1) END,
  CASE WHEN (cy >> a) & 1 = 1 THEN cy & ((1::BIGINT << a) - 1) WHEN (cx >> a) & 1 = 1 THEN (1::BIGINT << a) - 1 - (cx & ((1::BIGINT << a) - 1)) ELSE cx & ((1::BIGINT << a) - 1) END, a - 1,
  d + (xor(3 * ((cx >> a) & 1), (cy >> a) & 1) << (2 * a)) FROM h WHERE a >= 0)
  SELECT z, x, y, d AS tile_id FROM h WHERE a = -1 ORDER BY d LIMIT 32""")
def hilbert_first_32(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first tiles of an archive in curve order, as its sample shows them."""
    return hilbert_tile_id(spark, sf_dir).orderBy("tile_id").limit(32)


@query(f"""WITH {ARCH}, d AS (SELECT DISTINCT z, x, y, file, src_idx FROM arch), w AS (SELECT z, x, y, file, first_value(file) OVER k AS first_holder, row_number() OVER k AS n FROM d WINDOW k AS (PARTITION BY z, x, y ORDER BY src_idx))
  SELECT z, x, y, first_holder, file, 'Duplicate tile at z' || z || '/x' || x || '/y' || y || ': found in both ' || first_holder || ' and ' || file AS message FROM w WHERE n > 1""")
def duplicate_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.duplicate_tiles(archive_rows(spark, sf_dir))


@query(f"WITH {ARCH} SELECT z, x, y, tile_data, src_idx, ord FROM arch QUALIFY row_number() OVER (PARTITION BY z, x, y ORDER BY src_idx DESC, ord DESC) = 1")
def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.last_wins(archive_rows(spark, sf_dir), ["src_idx", "ord"]).select("z", "x", "y", "tile_data", "src_idx", "ord")


@query(f"WITH {ARCH} SELECT z, x, y, tile_data, src_idx, ord FROM arch QUALIFY row_number() OVER (PARTITION BY z, x, y ORDER BY src_idx, ord) = 1")
def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.first_wins(archive_rows(spark, sf_dir), ["src_idx", "ord"]).select("z", "x", "y", "tile_data", "src_idx", "ord")


_TWO = f"WITH {ARCH}, a AS (SELECT z, x, y, min(tile_data) AS tile_data FROM arch WHERE src_idx = 0 GROUP BY ALL), b AS (SELECT z, x, y, min(tile_data) AS tile_data FROM arch WHERE src_idx = 1 OR ord % 8 = 0 GROUP BY ALL)"


def _two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = archive_rows(spark, sf_dir)
    return tuple(rows.where(c).groupBy("z", "x", "y").agg(F.min("tile_data").alias("tile_data")) for c in ("src_idx = 0", "src_idx = 1 OR ord % 8 = 0"))


@query(_TWO + " SELECT * FROM a UNION ALL SELECT * FROM b ANTI JOIN a USING (z, x, y)")
def insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.insert_missing(*_two(spark, sf_dir))


@query(_TWO + " SELECT z, x, y, tile_data FROM (SELECT *, 0 AS i FROM a UNION ALL SELECT *, 1 AS i FROM b) QUALIFY row_number() OVER (PARTITION BY z, x, y ORDER BY i DESC) = 1")
def union_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.union_archives(_two(spark, sf_dir), verify=False)


@query(_TWO + " SELECT * FROM a UNION ALL SELECT z, x, y + 100 AS y, tile_data FROM b")
def disjoint_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return archive.union_archives([a, b.withColumn("y", F.col("y") + 100)], verify=True)


@query(_TWO + " SELECT z, x, y FROM a UNION SELECT z, x, y FROM b")
def key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.key_union(_two(spark, sf_dir))


@query(_TWO + """ SELECT z, x, y, CASE WHEN a.tile_data IS NULL THEN 'extra' WHEN b.tile_data IS NULL THEN 'missing' WHEN a.tile_data = b.tile_data THEN 'matched' ELSE 'mismatch' END AS status
  FROM a FULL JOIN b USING (z, x, y)""")
def archive_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.archive_diff(*_two(spark, sf_dir))


@query(_TWO + """ SELECT b.z, b.x, b.y, coalesce(p.tile_data, q.tile_data) AS tile_data FROM b LEFT JOIN a p ON p.z = b.z AND p.x = b.x AND p.y = (1 << b.z) - 1 - b.y
  LEFT JOIN a q ON q.z = b.z AND q.x = b.x AND q.y = b.y""")
def flip_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return archive.flip_lookup(b.select("z", "x", "y"), a)


@query(_TWO + " SELECT * FROM a SEMI JOIN b USING (z, x, y)")
def resume_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return a.join(b, ["z", "x", "y"], "left_semi")


@query(_TWO + " SELECT * FROM a ANTI JOIN b USING (z, x, y)")
def missing_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return a.join(b, ["z", "x", "y"], "left_anti")


@query(f"WITH {ARCH} SELECT count(*) AS total, count(DISTINCT (z, x, y)) AS distinct_keys FROM arch")
def key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.key_check(archive_rows(spark, sf_dir))


@query(f"WITH {ARCH} SELECT z, src_idx, coalesce(max(ord), -1) AS high_water, count(*) AS n FROM arch WHERE z BETWEEN 10 AND 11 GROUP BY ALL")
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = archive_rows(spark, sf_dir).where(F.col("z").between(10, 11))
    return rows.groupBy("z", "src_idx").agg(F.coalesce(F.max("ord"), F.lit(-1)).alias("high_water"), F.count("*").alias("n"))


@query(f"""WITH {FOOT}, c AS (SELECT source, 6 AS z, {_cells_sql("6")} FROM foot), c2 AS (SELECT source, z, y0, y1, unnest(range(x0, x1 + 1))::INT AS x FROM c),
  c3 AS (SELECT DISTINCT source, z, x, unnest(range(y0, y1 + 1))::INT AS y FROM c2)
  SELECT z, x, y, count(*) AS source_count, array_to_string(list_sort(list(source))[1:3], ';') AS sources FROM c3 GROUP BY z, x, y""")
def subtree_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.subtree_sources(footprints(spark, sf_dir), 6, 3).withColumn("sources", F.array_join("sources", ";"))


@query("""WITH m AS (SELECT c_custkey AS src_idx, CASE WHEN c_custkey % 4 = 0 THEN 'attribution' ELSE lower(c_mktsegment) END AS name, CASE WHEN c_custkey % 8 = 0 THEN ' ' || c_mktsegment || ' ' WHEN c_custkey % 12 = 0 THEN ' ' ELSE c_mktsegment END AS value FROM customer)
  SELECT name, CASE WHEN name = 'attribution' THEN string_agg(DISTINCT trim(value), ' | ' ORDER BY trim(value)) FILTER (WHERE trim(value) <> '') ELSE first(value ORDER BY src_idx) END AS value FROM m GROUP BY name""")
def metadata_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "customer").selectExpr("c_custkey AS src_idx", "CASE WHEN c_custkey % 4 = 0 THEN 'attribution' ELSE lower(c_mktsegment) END AS name", "CASE WHEN c_custkey % 8 = 0 THEN concat(' ', c_mktsegment, ' ') WHEN c_custkey % 12 = 0 THEN ' ' ELSE c_mktsegment END AS value")
    return archive.merged_metadata(rows)


@query(f"""WITH {PIX}, s AS (SELECT z, x, y, "row", "col", max(floor(elev)) FILTER (WHERE prio = 0) AS upper, max(floor(elev)) FILTER (WHERE prio = 1) AS lower FROM pix GROUP BY ALL)
  SELECT z, x, y, count(upper) AS upper_valid, count(lower) AS lower_valid, count(*) FILTER (WHERE upper IS NULL AND lower IS NOT NULL) AS filled_by_lower,
  100.0::DOUBLE * count(*) FILTER (WHERE upper IS NULL AND lower IS NOT NULL) / count(*) AS filled_percent, avg(abs(upper - lower)) AS mean_abs_diff, max(abs(upper - lower))::DOUBLE AS max_abs_diff FROM s GROUP BY ALL""")
def fill_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pixels(spark, sf_dir).withColumn("elev", F.floor("elev").cast("double"))
    return inspection.fill_report(inspection.side_by_side(rows, tuple(KEY)), "upper", "lower")


@query(f"""WITH {LOG}, a AS (SELECT *, max(t) OVER (PARTITION BY event, user_id) AS last, row_number() OVER (PARTITION BY event, user_id ORDER BY t DESC, v DESC) AS n FROM log),
  b AS (SELECT *, count(*) FILTER (WHERE t >= last - 86400) OVER (PARTITION BY event, user_id) AS k FROM a), c AS (SELECT * FROM b WHERE CASE WHEN k >= 2 THEN t >= last - 86400 ELSE n <= 10 END),
  d AS (SELECT event, user_id, first(v ORDER BY t, v) AS v0, first(v ORDER BY t DESC, v DESC) AS v1, min(t) AS t0, max(t) AS t1, count(*) AS n FROM c GROUP BY ALL)
  SELECT event, user_id, CASE WHEN n >= 2 AND t1 > t0 THEN (v1 - v0) / (t1 - t0) ELSE 0.0::DOUBLE END AS rate FROM d""")
def recent_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.recent_rate(logs(spark, sf_dir), ["event", "user_id"], seconds=86400)


@query(f"WITH {LOG} SELECT event, user_id, event_id, max(v) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS peak FROM log")
def running_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inspection.running_peak(logs(spark, sf_dir), ["user_id"], ["t", "event_id"], "v").select("event", "user_id", "event_id", "peak")


@query(f"""WITH {LOG}, n AS (SELECT event, event_id, row_number() OVER (PARTITION BY event ORDER BY t, event_id) AS n FROM log)
  SELECT event, event_id, (n - 1) // 250 AS batch_id, n % 1000 = 0 AS is_checkpoint FROM n""")
def batch_checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each hour of an event kind is numbered by itself, from the count of what came before."""
    hour = F.floor(F.col("t") / 3600)
    return inspection.numbered_batches(logs(spark, sf_dir), ["event"], ["t", "event_id"], 250, 1000, hour).select("event", "event_id", "batch_id", "is_checkpoint")


@query(f"""WITH {LOG} SELECT (t // 3600) * 3600 AS start, event, count(*) AS n, min(floor(v))::BIGINT AS low, max(floor(v))::BIGINT AS high FROM log GROUP BY ALL""")
def telemetry_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = logs(spark, sf_dir).select(F.timestamp_seconds("t").alias("at"), "event", F.floor("v").alias("wal_bytes"))
    out = telemetry.windowed_progress(rows, "1 hour")
    return out.select(F.unix_seconds("start").alias("start"), "event", "n", "low", "high")


@query(f"""WITH {LOG} SELECT (t // 3600) * 3600 AS start, event, count(*) AS n, min(floor(v))::BIGINT AS low, max(floor(v))::BIGINT AS high FROM log GROUP BY ALL""")
def telemetry_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same windows by Structured Streaming over the table's file, run until all that is there has been read."""
    at = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(at).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).selectExpr("timestamp_seconds(timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast(ts AS timestamp_ntz))) AS at", "event_type AS event", "cast(floor(value) AS bigint) AS wal_bytes")
    at = folders.shared(spark, "telemetry")
    windows = telemetry.windowed_progress(stream, "1 hour").select(F.unix_seconds("start").alias("start"), "event", "n", "low", "high")
    # Each batch's windows replace the former's table, so the result stays on the executors, and a replayed batch does no harm.
    run = windows.writeStream.outputMode("complete").foreachBatch(lambda batch, i: batch.write.mode("overwrite").parquet(f"{at}/windows"))
    run.option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(windows.schema).parquet(f"{at}/windows")


_PATTERNS = "(VALUES " + ", ".join(f"('{p}', {i}, {g[0]}, {g[1]}, {g[2]}::BIGINT, {g[3]}::DOUBLE)" for p, gs in zoom_split.PATTERNS.items() for i, g in enumerate(gs)) + ") AS t(pattern, ord, min_zoom, max_zoom, estimated_tiles, estimated_memory_gb)"


@query(f"""SELECT pattern, ord, CASE WHEN min_zoom = max_zoom THEN 'z' || min_zoom ELSE 'z' || min_zoom || '-' || max_zoom END AS name, coalesce(lag(max_zoom) OVER w + 1, 0) AS expected_start,
  min_zoom = coalesce(lag(max_zoom) OVER w + 1, 0) AND min_zoom <= max_zoom AND (lead(ord) OVER w IS NOT NULL OR max_zoom = 16) AS ok FROM {_PATTERNS} WINDOW w AS (PARTITION BY pattern ORDER BY ord)""")
def split_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoom_split.coverage_report(zoom_split.pattern_table(spark))


@query(f"SELECT pattern, sum(estimated_tiles)::BIGINT AS tiles, max(estimated_memory_gb) AS memory_gb, count(*) AS groups FROM {_PATTERNS} GROUP BY ALL")
def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling_job.split_report(zoom_split.pattern_table(spark))


def _frac(lat: str) -> str:
    return f"(1 - ln(tan(radians({lat}::DOUBLE)) + 1 / cos(radians({lat}::DOUBLE))) / pi()) / 2 * (1::BIGINT << z)"


@query(f"""WITH c AS (SELECT z::INT AS z, (greatest(1, ceil((154.0 - 122.0)::DOUBLE / 360 * (1::BIGINT << z))) * greatest(1, ceil(abs({_frac("24.0")} - {_frac("46.0")}))))::BIGINT AS tiles FROM (SELECT unnest(range(0, 17)) AS z))
  SELECT z, tiles, 4.0::DOUBLE + tiles / 1000000.0::DOUBLE * 2.0::DOUBLE AS memory_gb FROM c""")
def estimated_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = zoom_split.tiles_by_zoom(spark, 0, 16)
    return rows.withColumn("memory_gb", F.lit(zoom_split.BASE_GB) + F.col("tiles") / 1e6 * zoom_split.GB_PER_MILLION)


@query(f"WITH {GRID}, p AS (SELECT z, x, y, vec_id, unnest(embedding)::DOUBLE AS elev, generate_subscripts(embedding, 1) - 1 AS i FROM grid) SELECT z, x, y, vec_id, (i // 8)::INT AS \"row\", (i % 8)::INT AS \"col\", elev FROM p")
def tile_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").selectExpr("8 AS z", "int(vec_id % 16) AS x", "int((vec_id div 16) % 8) AS y", "vec_id", "embedding AS px")
    return merge.tile_pixels(rows, 8).withColumn("elev", F.col("elev").cast("double"))


_CELLS = f"WITH {GRID}, p AS (SELECT z, x, y, prio, vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM grid), q AS (SELECT z, x, y, prio, vec_id, i, CASE WHEN abs(v) < 0.05::DOUBLE THEN NULL ELSE v::DOUBLE END AS v FROM p)"


@query(_CELLS + " SELECT z, x, y, i::INT AS i, first(v ORDER BY prio, vec_id) FILTER (WHERE v IS NOT NULL) AS elev, coalesce(first(prio ORDER BY prio, vec_id) FILTER (WHERE v IS NOT NULL), -1)::INT AS prov FROM q GROUP BY z, x, y, i")
def grid_priority_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The array form of the priority merge, shown as rows."""
    merged = merge.merge_grids(grids(spark, sf_dir), ["prio", "vec_id"])
    return merged.select("z", "x", "y", F.posexplode(F.arrays_zip("px", "prov")).alias("i", "p")).select("z", "x", "y", "i", F.col("p.px").cast("double").alias("elev"), F.col("p.prov").cast("int").alias("prov"))


@query(_CELLS + " SELECT z, x, y, i::INT AS i, max(v) AS elev FROM q GROUP BY z, x, y, i")
def grid_max_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge.max_grids(grids(spark, sf_dir))
    return merged.select("z", "x", "y", F.posexplode("px").alias("i", "elev")).withColumn("elev", F.col("elev").cast("double"))


@query("SELECT o_orderkey, trunc(o_totalprice / 1000 * 1e7::DOUBLE)::BIGINT AS e7 FROM (SELECT o_orderkey, floor(o_totalprice) AS o_totalprice FROM orders)")
def degrees_e7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select("o_orderkey", M.e7(F.floor("o_totalprice") / 1000).alias("e7"))


@query(f"""WITH {FOOT}, s AS (SELECT fid, "left"::BIGINT || ',' || bottom::BIGINT || ',' || "right"::BIGINT || ',' || top::BIGINT AS bounds FROM foot)
  SELECT fid, bounds, split_part(bounds, ',', 1)::DOUBLE AS w, split_part(bounds, ',', 4)::DOUBLE AS n FROM s""")
def bounds_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = footprints(spark, sf_dir).select("fid", F.concat_ws(",", *(F.col(c).cast("long") for c in ("left", "bottom", "right", "top"))).alias("bounds"))
    parts = F.split("bounds", ",")
    return rows.select("fid", "bounds", parts[0].cast("double").alias("w"), parts[3].cast("double").alias("n"))


_CALLS = {
    "tms_y": "tile_flip_y(z, y)", "metres": "vertical_resolution(z)", "px": "tile_parent(x, z, 6)", "best": "recommended_max_zoom(100 * (1 + x % 7))", "col": "lon_to_tile_x(x / 8D, z)", "line": "lat_to_tile_y(y / 8D, z)",
    "o": "terrarium_offset(x / 2D, z)", "r": "terrarium_r(x / 2D, z)", "g": "terrarium_g(x / 2D, z)", "b": "terrarium_b(x / 2D, z)", "back": "terrarium_decode(x % 256, y % 256, z)",
    "west": "round(tile_bounds(z, x, y).w, 7)", "north": "round(tile_bounds(z, x, y).n, 7)", "left": "round(tile_mercator_bounds(z, x, y).l, 4)", "top": "round(tile_mercator_bounds(z, x, y).t, 4)", "id": "tile_id(z, x, y)",
}


@query(f"""WITH RECURSIVE {ARCH}, k AS (SELECT DISTINCT z, x, y FROM arch), h AS (SELECT z, x, y, x::BIGINT AS cx, y::BIGINT AS cy, z - 1 AS a, ((1::BIGINT << (2 * z)) - 1) // 3 AS d FROM k
  UNION ALL SELECT z, x, y, CASE WHEN (cy >> a) & 1 = 1 THEN cx & ((1::BIGINT << a) - 1) WHEN (cx >> a) & 1 = 1 THEN (1::BIGINT << a) - 1 - (cy & ((1::BIGINT << a) - 1)) ELSE cy & ((1::BIGINT << a) - 1) END,
  CASE WHEN (cy >> a) & 1 = 1 THEN cy & ((1::BIGINT << a) - 1) WHEN (cx >> a) & 1 = 1 THEN (1::BIGINT << a) - 1 - (cx & ((1::BIGINT << a) - 1)) ELSE cx & ((1::BIGINT << a) - 1) END, a - 1,
  d + (xor(3 * ((cx >> a) & 1), (cy >> a) & 1) << (2 * a)) FROM h WHERE a >= 0),
  f AS (SELECT *, round_even(x / 2.0::DOUBLE / (2::DOUBLE ^ (19 - z) / 256), 0) * (2::DOUBLE ^ (19 - z) / 256) + 32768 AS o FROM h WHERE a = -1)
  SELECT z, x, y, ((1::BIGINT << z) - 1 - y)::INT AS tms_y, 2::DOUBLE ^ (19 - z) / 256 AS metres, x >> (z - 6) AS px, least(17, greatest(0, ceil(log2({CE} / 512 / (100 * (1 + x % 7))))))::INT AS best,
  least((1::BIGINT << z) - 1, greatest(0, floor((x / 8.0::DOUBLE / 360 + 0.5::DOUBLE + 1e-14::DOUBLE) * (1::BIGINT << z))))::INT AS col,
  least((1::BIGINT << z) - 1, greatest(0, {_lat_row("least(85.0511287798066::DOUBLE, y / 8.0::DOUBLE)", "z")}))::INT AS line, o,
  least(255, greatest(0, floor(o / 256)))::INT AS r, floor(o - 256 * floor(o / 256))::INT AS g, floor((o - floor(o)) * 256)::INT AS b, (x % 256) * 256.0::DOUBLE + y % 256 + z / 256.0::DOUBLE - 32768 AS back,
  round(x / (1::BIGINT << z)::DOUBLE * 360 - 180, 7) AS west, round({_lat_sql("y")}, 7) AS north, round(x * ({CE} / (1::BIGINT << z)) - {HALF}, 4) AS "left", round({HALF} - y * ({CE} / (1::BIGINT << z)), 4) AS top, d AS id FROM f""")
def sql_function_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered scalar SQL functions, in SQL."""
    sql_functions.register(spark)
    calls = ", ".join(f"{call} AS {name}" for name, call in _CALLS.items())
    return spark.sql(f"SELECT z, x, y, {calls} FROM (SELECT DISTINCT z, x, y FROM {{arch}})", arch=archive_rows(spark, sf_dir))


@query(f"WITH {GRID}, p AS (SELECT z, x, y, vec_id, unnest(embedding)::DOUBLE AS elev, generate_subscripts(embedding, 1) - 1 AS i FROM grid) SELECT vec_id, (i // 8)::INT AS \"row\", (i % 8)::INT AS \"col\", elev, 1200::BIGINT AS covered FROM p")
def sql_table_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered table functions, in SQL: a grid's pixels, and the number of a box's tiles."""
    sql_functions.register(spark)
    covered = "(SELECT count(*) FROM tile_cover(122D, 24D, 154D, 46D, 8)) + 1200 - (SELECT count(*) FROM {tiles} WHERE z = 8)"
    return spark.sql(
        f"SELECT vec_id, p.row, p.col, p.elev, {covered} AS covered FROM (SELECT vec_id, transform(embedding, v -> double(v)) AS px FROM {{grids}}) g, LATERAL tile_pixels(g.px, 8) p",
        grids=_table(spark, sf_dir, "embeddings"), tiles=tiling.tile_cover(spark, JAPAN, 8, 8),
    )


_PIXELS = f"""WITH {GRID}, p AS (SELECT z, x, y, prio, vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM grid), q AS (SELECT z, x, y, prio, vec_id, i, CASE WHEN abs(v) < 0.05::DOUBLE THEN NULL ELSE v::DOUBLE * 4096 END AS v FROM p),
  m AS (SELECT z, x, y, i, first(v ORDER BY prio, vec_id) FILTER (WHERE v IS NOT NULL) AS v FROM q GROUP BY z, x, y, i)
  SELECT z, x, y, i::INT AS i, round_even(coalesce(v, 0) / 8, 0) * 8 AS elev FROM m"""


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged grids as images; their values span some thousand metres, in steps of 8 at zoom 8."""
    rows = grids(spark, sf_dir).withColumn("px", F.transform("px", lambda v: (v * 4096).cast("float")))
    return raster.encode_tiles(merge.merge_grids(rows, ["prio", "vec_id"]))


def _decoded(tiles: DataFrame) -> DataFrame:
    """Every pixel of the payloads."""
    return raster.decode_tiles(tiles).select("z", "x", "y", F.posexplode("px").alias("i", "elev")).withColumn("elev", F.col("elev").cast("double"))


@query(_PIXELS)
def mbtiles_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged grids encoded, written as MBTiles, read again and decoded."""
    at = f"{folders.local(spark, 'tiles')}/tiles.mbtiles"
    tiling_job.write_mbtiles(_payloads(spark, sf_dir), at, "grids")
    return _decoded(spark.read.format("mbtiles").load(at))


@query(_PIXELS)
def pmtiles_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = f"{folders.local(spark, 'tiles')}/tiles.pmtiles"
    tiling_job.write_pmtiles(_payloads(spark, sf_dir), at, {"name": "grids", "minzoom": "8"})
    return _decoded(spark.read.format("pmtiles").load(at))


@query(_PIXELS)
def codec_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grids encoded to images and decoded again."""
    return _decoded(_payloads(spark, sf_dir))


@query(f"""WITH c AS (SELECT z, {_SIDE} AS side FROM (SELECT unnest([8, 9])::INT AS z)), t AS (SELECT z, side, unnest(range(floor((15500000 + {HALF}) / side)::INT, floor((15532000 + {HALF}) / side)::INT + 1))::INT AS x FROM c),
  u AS (SELECT z, side, x, unnest(range(floor(({HALF} - 4260000) / side)::INT, floor(({HALF} - 4228000) / side)::INT + 1))::INT AS y FROM t), p AS (SELECT *, unnest(range(0, 1024)) AS i FROM u),
  g AS (SELECT z, x, y, (4260000 - ({HALF} - y * side - (i // 32 + 0.5) * side / 32)) / 500 - 0.5 AS r, (x * side - {HALF} + (i % 32 + 0.5) * side / 32 - 15500000) / 500 - 0.5 AS c FROM p),
  v AS (SELECT z, x, y, CASE WHEN r < -0.5 OR r > 63.5 OR c < -0.5 OR c > 63.5 THEN -1 WHEN round_even(least(63, greatest(0, r)), 0) BETWEEN 20 AND 39 AND round_even(least(63, greatest(0, c)), 0) BETWEEN 20 AND 39 THEN 1 ELSE 0 END AS prov FROM g),
  k AS (SELECT z, x, y FROM v GROUP BY ALL HAVING max(prov) >= 0)
  SELECT z, x, y, prov, count(*) AS n FROM v SEMI JOIN k USING (z, x, y) GROUP BY ALL""")
def raster_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two small GeoTIFFs, the better with a hole, through catalogue, join, sampling and merge."""
    root = folders.local(spark, "rasters")
    cols, rows = np.meshgrid(np.arange(64.0), np.arange(64.0))
    for name, base, hole in (("fine", 100.0, True), ("coarse", 500.0, False)):
        os.makedirs(f"{root}/{name}")
        grid = base + cols + 2 * rows
        if hole:
            grid[20:40, 20:40] = -9999
        geotiff.write(f"{root}/{name}/a.tif", grid, 15_500_000.0, 4_260_000.0, 500.0, nodata=-9999)
        catalog.write_bounds(catalog.scan_rasters(spark, f"{root}/{name}"), f"{root}/{name}/bounds.csv")
    records = catalog.records(spark, root, ["fine", "coarse"])
    merged = tiling_job.merged_tiles(records, 8, 9, size=32)
    return merged.select("z", "x", "y", F.posexplode("prov").alias("i", "prov")).groupBy("z", "x", "y", F.col("prov").cast("int").alias("prov")).agg(F.count("*").alias("n"))


@query(f"""WITH {_TILES}, {FOOT}, o AS (SELECT z, x, y, fid FROM tiles JOIN foot ON {_OVERLAP}),
  m AS (SELECT z, x, ((1::BIGINT << z) - 1 - y)::INT AS y, fid FROM (SELECT t.z, t.x, ((1::BIGINT << z) - 1 - t.y)::INT AS y FROM tiles t) JOIN foot ON {_OVERLAP})
  SELECT z, x, y, fid, min(mirrored) = 1 AS mirrored FROM (SELECT *, 0 AS mirrored FROM o UNION ALL SELECT *, 1 AS mirrored FROM m) GROUP BY z, x, y, fid""")
def overlap_either(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footprints that overlap a tile or its mirror image, the tile itself preferred."""
    return tiling.overlap_either(_tiles(spark), footprints(spark, sf_dir).select("fid", "left", "bottom", "right", "top")).select("z", "x", "y", "fid", "mirrored")


@query("""WITH m AS (SELECT c_custkey % 5 AS src_idx, c_custkey AS k, ['name', 'attribution', 'format', 'minzoom', 'bounds'][1 + c_custkey % 5 % 5] AS name, c_mktsegment AS value FROM customer WHERE c_custkey <= 40),
  n AS (SELECT src_idx, name, min(value) AS value FROM m GROUP BY ALL)
  SELECT 'name' AS name, coalesce((SELECT value FROM n WHERE src_idx = 0 AND name = 'name'), 'merged') AS value UNION ALL SELECT 'format', 'webp' UNION ALL SELECT 'encoding', 'terrarium' UNION ALL
  SELECT 'minzoom', '3' UNION ALL SELECT 'maxzoom', '6' UNION ALL SELECT 'attribution', (SELECT string_agg(DISTINCT trim(value), ' | ' ORDER BY trim(value)) FROM n WHERE name = 'attribution') UNION ALL
  SELECT 'bounds', '1.5,2.5,3.5,4.5' UNION ALL SELECT 'center', '2.5,3.5,4'""")
def union_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merged archive's metadata: base from the first input, attributions joined, zooms and bounds of the tiles."""
    rows = _table(spark, sf_dir, "customer").where("c_custkey <= 40").selectExpr("c_custkey % 5 AS src_idx", "element_at(array('name', 'attribution', 'format', 'minzoom', 'bounds'), int(1 + c_custkey % 5 % 5)) AS name", "c_mktsegment AS value")
    rows = rows.groupBy("src_idx", "name").agg(F.min("value").alias("value"))
    stats = spark.range(1).selectExpr("1L AS n", "3 AS min_zoom", "6 AS max_zoom", "1.5D AS west", "2.5D AS south", "3.5D AS east", "4.5D AS north")
    return archive.union_metadata(rows, stats, "merged")


def queries() -> dict[str, Query]:
    from . import run_queries  # noqa: F401, registers its queries beside these

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
