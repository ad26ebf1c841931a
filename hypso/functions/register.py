"""The expressions as SQL functions of a session: ``SELECT tile_flip_y(z, y)``, ``SELECT * FROM tile_cover(...)``.

All are SQL-bodied functions that Spark inlines into the plan, so they run in generated code.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..schema import BASE_RESOLUTION_M, EARTH_CIRCUMFERENCE_M, MAX_ZOOM

_HALF = EARTH_CIRCUMFERENCE_M / 2
_LAT = "85.0511287798066D"
_ROW = f"least(shiftleft(1L, z) - 1, greatest(0L, floor((0.5D - 0.25D * ln((1 + sin(radians(greatest(-{_LAT}, least({_LAT}, lat))))) / (1 - sin(radians(greatest(-{_LAT}, least({_LAT}, lat)))))) / pi() + 1e-14D) * shiftleft(1L, z))))"
# One step along the Hilbert curve at bit a: the quadrant's share, and the place inside it, turned as the curve turns.
_QUADRANT = "CASE WHEN (s.x & shiftleft(1L, a)) != 0 THEN CASE WHEN (s.y & shiftleft(1L, a)) != 0 THEN 2L ELSE 3L END WHEN (s.y & shiftleft(1L, a)) != 0 THEN 1L ELSE 0L END"
_LOW_X, _LOW_Y, _EDGE = "(s.x & (shiftleft(1L, a) - 1))", "(s.y & (shiftleft(1L, a) - 1))", "(shiftleft(1L, a) - 1)"
_TURN = f"named_struct('x', CASE WHEN (s.y & shiftleft(1L, a)) != 0 THEN {_LOW_X} WHEN (s.x & shiftleft(1L, a)) != 0 THEN {_EDGE} - {_LOW_Y} ELSE {_LOW_Y} END, 'y', CASE WHEN (s.y & shiftleft(1L, a)) != 0 THEN {_LOW_Y} WHEN (s.x & shiftleft(1L, a)) != 0 THEN {_EDGE} - {_LOW_X} ELSE {_LOW_X} END, 'd', s.d + shiftleft(1L, 2 * a) * ({_QUADRANT}))"
_COL = "least(shiftleft(1L, z) - 1, greatest(0L, floor((lon / 360 + 0.5D + 1e-14D) * shiftleft(1L, z))))"

SCALARS = {
    "tile_flip_y(z INT, y INT) RETURNS INT": "cast(shiftleft(1L, z) - 1 - y AS INT)",
    "vertical_resolution(z INT) RETURNS DOUBLE": "pow(2D, 19 - z) / 256",
    "recommended_max_zoom(px DOUBLE) RETURNS INT": f"CASE WHEN px IS NULL OR isnan(px) OR abs(px) >= double('Infinity') OR px <= 0 THEN {MAX_ZOOM} ELSE cast(least({MAX_ZOOM}, greatest(0, ceil(log2({BASE_RESOLUTION_M}D / px)))) AS INT) END",
    "lon_to_tile_x(lon DOUBLE, z INT) RETURNS INT": f"cast({_COL} AS INT)",
    "lat_to_tile_y(lat DOUBLE, z INT) RETURNS INT": f"cast({_ROW} AS INT)",
    "terrarium_offset(elev DOUBLE, z INT) RETURNS DOUBLE": "rint(coalesce(nanvl(elev, NULL), 0D) / (pow(2D, 19 - z) / 256)) * (pow(2D, 19 - z) / 256) + 32768",
    "terrarium_r(elev DOUBLE, z INT) RETURNS INT": "cast(least(255, greatest(0, floor(terrarium_offset(elev, z) / 256))) AS INT)",
    "terrarium_g(elev DOUBLE, z INT) RETURNS INT": "cast(pmod(floor(terrarium_offset(elev, z)), 256) AS INT)",
    "terrarium_b(elev DOUBLE, z INT) RETURNS INT": "cast((terrarium_offset(elev, z) - floor(terrarium_offset(elev, z))) * 256 AS INT)",
    "terrarium_decode(r INT, g INT, b INT) RETURNS DOUBLE": "r * 256D + g + b / 256D - 32768D",
    "tile_parent(c INT, z INT, up_to INT) RETURNS INT": "shiftright(c, greatest(z - up_to, 0))",
    "tile_id(z INT, x INT, y INT) RETURNS BIGINT": f"CASE WHEN z = 0 THEN 0L ELSE (shiftleft(1L, 2 * z) - 1) div 3 + aggregate(sequence(greatest(z - 1, 0), 0), named_struct('x', cast(x AS BIGINT), 'y', cast(y AS BIGINT), 'd', 0L), (s, a) -> {_TURN}, s -> s.d) END",
    "tile_bounds(z INT, x INT, y INT) RETURNS STRUCT<w DOUBLE, s DOUBLE, e DOUBLE, n DOUBLE>": (
        "named_struct('w', x / cast(shiftleft(1L, z) AS DOUBLE) * 360 - 180, 's', degrees(atan(sinh(pi() * (1 - 2 * (y + 1) / cast(shiftleft(1L, z) AS DOUBLE))))), "
        "'e', (x + 1) / cast(shiftleft(1L, z) AS DOUBLE) * 360 - 180, 'n', degrees(atan(sinh(pi() * (1 - 2 * y / cast(shiftleft(1L, z) AS DOUBLE))))))"
    ),
    "tile_mercator_bounds(z INT, x INT, y INT) RETURNS STRUCT<l DOUBLE, b DOUBLE, r DOUBLE, t DOUBLE>": (
        f"named_struct('l', x * ({EARTH_CIRCUMFERENCE_M}D / shiftleft(1L, z)) - {_HALF}D, 'b', {_HALF}D - (y + 1) * ({EARTH_CIRCUMFERENCE_M}D / shiftleft(1L, z)), "
        f"'r', (x + 1) * ({EARTH_CIRCUMFERENCE_M}D / shiftleft(1L, z)) - {_HALF}D, 't', {_HALF}D - y * ({EARTH_CIRCUMFERENCE_M}D / shiftleft(1L, z)))"
    ),
}
TABLES = {
    "tile_pixels(px ARRAY<DOUBLE>, width INT) RETURNS TABLE (row INT, col INT, elev DOUBLE)": (
        "SELECT cast(i div tile_pixels.width AS INT) AS row, cast(i % tile_pixels.width AS INT) AS col, elev FROM (SELECT posexplode(tile_pixels.px) AS (i, elev))"
    ),
    "tile_cover(w DOUBLE, s DOUBLE, e DOUBLE, n DOUBLE, z INT) RETURNS TABLE (z INT, x INT, y INT)": (
        "SELECT z, x, explode(sequence(y0, y1)) AS y FROM (SELECT z, y0, y1, explode(sequence(x0, x1)) AS x FROM (SELECT tile_cover.z AS z, lon_to_tile_x(tile_cover.w, tile_cover.z) AS x0, "
        "lon_to_tile_x(tile_cover.e - 1e-11D, tile_cover.z) AS x1, lat_to_tile_y(tile_cover.n, tile_cover.z) AS y0, lat_to_tile_y(tile_cover.s + 1e-11D, tile_cover.z) AS y1))"
    ),
}


def register(spark: SparkSession) -> None:
    for signature, body in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    for signature, body in TABLES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
