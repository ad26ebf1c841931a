"""Web-Mercator tile geometry as Column expressions, all inside Spark's generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import BASE_RESOLUTION_M, EARTH_CIRCUMFERENCE_M, MAX_ZOOM

HALF = EARTH_CIRCUMFERENCE_M / 2
MAX_LAT = 85.0511287798066
#: East and south edges are drawn in by this many degrees, so that a box that ends on a tile's edge doesn't reach the next.
EDGE = 1e-11

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _tiles(z: Column) -> Column:
    """2**z as long."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), z.cast("int"))


def flip_y(z: ColumnOrName, y: ColumnOrName) -> Column:
    """Between rows counted from the north and from the south; its own inverse."""
    return (_tiles(_c(z)) - 1 - _c(y)).cast("int")


def pixel_size(left: ColumnOrName, bottom: ColumnOrName, right: ColumnOrName, top: ColumnOrName, width: ColumnOrName, height: ColumnOrName) -> Column:
    """The coarser of both axes' metres per pixel; spans of zero and missing pixels are held off by floors."""

    def axis(a, b, n):
        return F.greatest(F.abs(_c(b) - _c(a)), F.lit(1e-6)) / F.greatest(_c(n), F.lit(1))

    return F.greatest(axis(left, right, width), axis(bottom, top, height))


def finite(c: ColumnOrName) -> Column:
    return _c(c).isNotNull() & ~F.isnan(_c(c)) & (F.abs(_c(c)) < F.lit(float("inf")))


def overlaps(a: tuple[ColumnOrName, ...], b: tuple[ColumnOrName, ...]) -> Column:
    """Whether two boxes (left, bottom, right, top) share inner points; boxes that only touch don't."""
    al, ab, ar, at = map(_c, a)
    bl, bb, br, bt = map(_c, b)
    return (ar > bl) & (al < br) & (at > bb) & (ab < bt)


def clip(a: tuple[ColumnOrName, ...], b: tuple[ColumnOrName, ...]) -> list[Column]:
    """The intersection of two boxes; empty if its left is not below its right or bottom not below top."""
    al, ab, ar, at = map(_c, a)
    bl, bb, br, bt = map(_c, b)
    return [F.greatest(al, bl), F.greatest(ab, bb), F.least(ar, br), F.least(at, bt)]


def recommended_max_zoom(px: ColumnOrName) -> Column:
    """The zoom whose pixels are as fine as ``px`` metres, in 0..17; 17 if ``px`` is not finite or not positive."""
    p = _c(px)
    fits = F.ceil(F.log2(F.lit(BASE_RESOLUTION_M) / p))
    return F.when(~finite(p) | (p <= 0), F.lit(MAX_ZOOM)).otherwise(F.least(F.lit(MAX_ZOOM), F.greatest(F.lit(0), fits))).cast("int")


def _cell(share: Column, z: Column) -> Column:
    n = _tiles(z)
    return F.least(n - 1, F.greatest(F.lit(0).cast("long"), F.floor((share + 1e-14) * n))).cast("int")


def lon_to_x(lon: ColumnOrName, z: ColumnOrName) -> Column:
    return _cell(_c(lon) / 360 + 0.5, _c(z))


def lat_to_y(lat: ColumnOrName, z: ColumnOrName) -> Column:
    s = F.sin(F.radians(F.least(F.lit(MAX_LAT), F.greatest(F.lit(-MAX_LAT), _c(lat)))))
    return _cell(F.lit(0.5) - F.lit(0.25) * F.log((1 + s) / (1 - s)) / math.pi, _c(z))


def fractional_y(lat: ColumnOrName, z: ColumnOrName) -> Column:
    r = F.radians(_c(lat))
    return (1 - F.log(F.tan(r) + 1 / F.cos(r)) / math.pi) / 2 * _tiles(_c(z))


def lonlat_bounds(z: ColumnOrName, x: ColumnOrName, y: ColumnOrName) -> dict[str, Column]:
    """A tile's west, south, east, north in degrees."""
    n = _tiles(_c(z)).cast("double")

    def lat(row: Column) -> Column:
        return F.degrees(F.atan(F.sinh(math.pi * (1 - 2 * row / n))))

    return {"west": _c(x) / n * 360 - 180, "south": lat(_c(y) + 1), "east": (_c(x) + 1) / n * 360 - 180, "north": lat(_c(y).cast("double"))}


def mercator_bounds(z: ColumnOrName, x: ColumnOrName, y: ColumnOrName) -> dict[str, Column]:
    """A tile's left, bottom, right, top in metres."""
    side = F.lit(EARTH_CIRCUMFERENCE_M) / _tiles(_c(z))
    return {"left": _c(x) * side - HALF, "bottom": HALF - (_c(y) + 1) * side, "right": (_c(x) + 1) * side - HALF, "top": HALF - _c(y) * side}


def mercator_to_lon(mx: ColumnOrName) -> Column:
    return _c(mx) / HALF * 180


def mercator_to_lat(my: ColumnOrName) -> Column:
    """Inverse Mercator is monotone on each axis, so a box's corners give its exact bounds."""
    return F.degrees(F.atan(F.sinh(_c(my) / HALF * math.pi)))


def lon_to_mercator(lon: ColumnOrName) -> Column:
    return _c(lon) / 180 * HALF


def lat_to_mercator(lat: ColumnOrName) -> Column:
    return F.log(F.tan(F.lit(math.pi / 4) + F.radians(_c(lat)) / 2)) / math.pi * HALF


def mercator_cells(left: ColumnOrName, bottom: ColumnOrName, right: ColumnOrName, top: ColumnOrName, z: ColumnOrName) -> dict[str, Column]:
    """First and last column and row of the tiles that a box in metres shares inner points with."""
    n = _tiles(_c(z))
    side = F.lit(EARTH_CIRCUMFERENCE_M) / n

    def inside(c: Column) -> Column:
        return F.least(n - 1, F.greatest(F.lit(0).cast("long"), c)).cast("int")

    return {
        "x0": inside(F.floor((_c(left) + HALF) / side)), "x1": inside(F.ceil((_c(right) + HALF) / side) - 1),
        "y0": inside(F.floor((HALF - _c(top)) / side)), "y1": inside(F.ceil((HALF - _c(bottom)) / side) - 1),
    }


def parent(c: ColumnOrName, z: ColumnOrName, to: int) -> Column:
    """A column's or row's ancestor at zoom ``to``; at or above that zoom, itself."""
    return F.call_function("shiftright", _c(c), F.greatest(_c(z) - to, F.lit(0)))


def tile_id(z: ColumnOrName, x: ColumnOrName, y: ColumnOrName) -> Column:
    """Position on the Hilbert curve after all lower zooms: sum of 4**i for i < z, plus the distance along the curve."""
    z, x, y = _c(z), _c(x).cast("long"), _c(y).cast("long")

    def step(s: Column, a: Column) -> Column:
        side = F.call_function("shiftleft", F.lit(1).cast("long"), a)
        rx = F.when(s["x"].bitwiseAND(side) != 0, 1).otherwise(0)
        ry = F.when(s["y"].bitwiseAND(side) != 0, 1).otherwise(0)
        low_x, low_y = s["x"].bitwiseAND(side - 1), s["y"].bitwiseAND(side - 1)
        turn, mirror = ry == 0, (ry == 0) & (rx == 1)
        nx = F.when(mirror, side - 1 - low_x).otherwise(low_x)
        ny = F.when(mirror, side - 1 - low_y).otherwise(low_y)
        far = F.when(rx == 1, F.when(ry == 1, 2).otherwise(3)).otherwise(ry)
        return F.struct(F.when(turn, ny).otherwise(nx).alias("x"), F.when(turn, nx).otherwise(ny).alias("y"), (s["d"] + side * side * far).alias("d"))

    start = F.struct(x.alias("x"), y.alias("y"), F.lit(0).cast("long").alias("d"))
    along = F.aggregate(F.sequence(F.greatest(z - 1, F.lit(0)).cast("int"), F.lit(0)), start, step, lambda s: s["d"])
    before = F.call_function("div", F.call_function("shiftleft", F.lit(1).cast("long"), (z * 2).cast("int")) - 1, F.lit(3).cast("long"))
    return F.when(z == 0, F.lit(0).cast("long")).otherwise(before + along)


def e7(degrees: ColumnOrName) -> Column:
    """Degrees as whole ten-millionths, cut towards zero."""
    return (_c(degrees) * 1e7).cast("long")


def estimated_tiles(z: ColumnOrName, bbox: tuple[float, float, float, float]) -> Column:
    """Tiles that a box of degrees covers at one zoom by its spans, at least one along each axis."""
    west, south, east, north = bbox
    across = F.ceil(F.lit((east - west) / 360) * _tiles(_c(z)))
    down = F.ceil(F.abs(fractional_y(F.lit(south), z) - fractional_y(F.lit(north), z)))
    one = F.lit(1).cast("long")
    return F.greatest(one, across) * F.greatest(one, down)
