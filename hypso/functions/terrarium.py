"""Elevations as Terrarium colours, and source numbers as palette colours, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .tilemath import ColumnOrName, _c

# The colours of no data and of the first sources.
PALETTE = {
    -1: (255, 255, 255), 0: (0, 100, 0), 1: (50, 205, 50), 2: (152, 251, 152),
    3: (34, 139, 34), 4: (60, 179, 113), 5: (144, 238, 144), 6: (193, 255, 193),
}


def extra_colour(i: int) -> tuple[int, int, int]:
    """The colour of a source number that the palette lacks."""
    return 200 - i % 60, 120 + i * 37 % 120, 100 + i * 23 % 120


def vertical_resolution(z: ColumnOrName) -> Column:
    """Metres that an elevation is rounded to: 2**(19 - z) / 256, so 1 m at zoom 11."""
    return F.pow(F.lit(2.0), 19 - _c(z)) / 256


def _byte(c: Column) -> Column:
    return F.least(F.lit(255.0), F.greatest(F.lit(0.0), c)).cast("int")


def encode(elev: ColumnOrName, z: ColumnOrName) -> dict[str, Column]:
    """r, g, b of an elevation; no data encodes as 0 m. Halves round to even. Values beyond the range clip red alone."""
    step = vertical_resolution(z)
    v = F.coalesce(F.nanvl(_c(elev).cast("double"), F.lit(None).cast("double")), F.lit(0.0))
    o = F.rint(v / step) * step + 32768
    whole = F.floor(o).cast("double")
    return {"r": _byte(F.floor(o / 256).cast("double")), "g": _byte(o - F.floor(o / 256) * 256), "b": _byte((o - whole) * 256)}


def decode(r: ColumnOrName, g: ColumnOrName, b: ColumnOrName) -> Column:
    return _c(r) * 256.0 + _c(g) + _c(b) / 256.0 - 32768.0


def palette_colour(source: ColumnOrName, palette: dict[int, tuple[int, int, int]] | None = None) -> Column:
    """struct(r, g, b) of a source number; numbers without a colour of their own get one by rule."""
    i = _c(source)
    out = F.struct((200 - F.pmod(i, F.lit(60))).cast("int").alias("r"), (120 + F.pmod(i * 37, F.lit(120))).cast("int").alias("g"), (100 + F.pmod(i * 23, F.lit(120))).cast("int").alias("b"))
    for n, (r, g, b) in (PALETTE if palette is None else palette).items():
        out = F.when(i == n, F.struct(F.lit(r).alias("r"), F.lit(g).alias("g"), F.lit(b).alias("b"))).otherwise(out)
    return F.when(i.isNotNull(), out)
