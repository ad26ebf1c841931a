"""Rasters onto tile grids: bilinear sampling with no-data-aware weights, and image payloads, as Arrow kernels.

A (tile, raster) pair's grid depends on nothing else, so pairs are spread freely; those of one raster and one block of
tiles are sampled together. Rasters never travel: a task opens them where they are and reads the header and the strips
or tiles that its pairs' windows touch.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.terrarium import PALETTE, extra_colour
from ..functions.tilemath import HALF
from ..schema import EARTH_CIRCUMFERENCE_M, TILE_SIZE
from ..sources import codec, geotiff
from .merge import unpacked


def bilinear(band: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Values at fractional pixel centres (0 is the first pixel's centre), as a (rows, cols) grid.

    Weights of no-data neighbours are left out and the others scaled up; where the nearest pixel is no data or the
    place is outside the raster, the result is NaN.
    """
    h, w = band.shape
    out = np.full((len(rows), len(cols)), np.nan)
    ok_r, ok_c = (rows >= -0.5) & (rows <= h - 0.5), (cols >= -0.5) & (cols <= w - 0.5)
    if not ok_r.any() or not ok_c.any():
        return out
    r, c = np.clip(rows[ok_r], 0, h - 1), np.clip(cols[ok_c], 0, w - 1)
    r0, c0 = np.floor(r).astype(int), np.floor(c).astype(int)
    r1, c1 = np.minimum(r0 + 1, h - 1), np.minimum(c0 + 1, w - 1)
    fr, fc = (r - r0)[:, None], (c - c0)[None, :]
    total, weight = np.zeros((len(r), len(c))), np.zeros((len(r), len(c)))
    for ri, wr in ((r0, 1 - fr), (r1, fr)):
        for ci, wc in ((c0, 1 - fc), (c1, fc)):
            v = band[np.ix_(ri, ci)]
            there = ~np.isnan(v)
            total += np.where(there, v, 0) * wr * wc
            weight += there * wr * wc
    nearest = band[np.ix_(np.rint(r).astype(int), np.rint(c).astype(int))]
    with np.errstate(invalid="ignore", divide="ignore"):
        out[np.ix_(ok_r, ok_c)] = np.where((weight > 0) & ~np.isnan(nearest), total / weight, np.nan)
    return out


def scattered(band: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """As ``bilinear``, at a grid of places that isn't a raster's rows and columns."""
    h, w = band.shape
    out = np.full(rows.shape, np.nan)
    ok = (rows >= -0.5) & (rows <= h - 0.5) & (cols >= -0.5) & (cols <= w - 0.5)
    r, c = np.clip(rows[ok], 0, h - 1), np.clip(cols[ok], 0, w - 1)
    r0, c0 = np.floor(r).astype(int), np.floor(c).astype(int)
    r1, c1 = np.minimum(r0 + 1, h - 1), np.minimum(c0 + 1, w - 1)
    total, weight = np.zeros(len(r)), np.zeros(len(r))
    for ri, wr in ((r0, 1 - (r - r0)), (r1, r - r0)):
        for ci, wc in ((c0, 1 - (c - c0)), (c1, c - c0)):
            v = band[ri, ci]
            there = ~np.isnan(v)
            total += np.where(there, v, 0) * wr * wc
            weight += there * wr * wc
    nearest = band[np.rint(r).astype(int), np.rint(c).astype(int)]
    with np.errstate(invalid="ignore", divide="ignore"):
        out[ok] = np.where((weight > 0) & ~np.isnan(nearest), total / weight, np.nan)
    return out


def sample(source: geotiff.Raster, z: int, x: int, y: int, size: int = TILE_SIZE) -> np.ndarray:
    """A raster's values at the pixel centres of a tile; only the window that they need is read."""
    side, h = EARTH_CIRCUMFERENCE_M / (1 << z), source.h
    mx = x * side - HALF + (np.arange(size) + 0.5) * side / size
    my = HALF - y * side - (np.arange(size) + 0.5) * side / size
    rows, cols = h.place(mx, my)
    in_r, in_c = rows[(rows >= -0.5) & (rows <= h.height - 0.5)], cols[(cols >= -0.5) & (cols <= h.width - 0.5)]
    if not len(in_r) or not len(in_c):
        return np.full((size, size), np.nan)
    row0, row1 = max(0, int(in_r.min()) - 1), min(h.height, int(in_r.max()) + 3)
    col0, col1 = max(0, int(in_c.min()) - 1), min(h.width, int(in_c.max()) + 3)
    part = source.window(row0, row1, col0, col1)
    # Outside the window, but for the raster's own edge, no place is asked for.
    edge = lambda v, first, last, all_: np.where((v < first - 0.5) | (v > last - 0.5) | (v < -0.5) | (v > all_ - 0.5), -9.0, v - first)
    rows, cols = edge(rows, row0, row1, h.height), edge(cols, col0, col1, h.width)
    return bilinear(part, rows, cols) if rows.ndim == 1 else scattered(part, rows, cols)


def read_tiles(pairs: DataFrame, size: int = TILE_SIZE, packed: bool = False) -> DataFrame:
    """(z, x, y, path, ...) to the same rows with ``px``, the raster's values on the tile, null where it has none; or
    ``packed`` as bytes, see ``merge.merge_grids``.

    Pairs of rasters that can't be read, and grids without any value, are left out. A unit of work is a raster and a
    block of 8 x 8 tiles, so a huge raster is sampled by many tasks and a strip is decoded once for its block.
    """
    block = [F.call_function("shiftright", F.col(c), F.lit(3)) for c in ("x", "y")]
    dealt = pairs.repartition("path", "z", *block).sortWithinPartitions("path", "z", *block, "y", "x")
    names = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, source, close = None, None, lambda: None
        for batch in batches:
            z, x, y, paths = (batch.column(names.index(c)).to_pylist() for c in ("z", "x", "y", "path"))
            for k in range(len(batch)):
                if paths[k] != path:
                    close()
                    path, source, close = paths[k], None, lambda: None
                    try:
                        read, close = geotiff.ranges(path)
                        source = geotiff.Raster(read, geotiff.header(read))
                    except (OSError, ValueError, KeyError, IndexError, struct.error):
                        continue
                if source is None:
                    continue
                try:
                    grid = sample(source, z[k], x[k], y[k], size)
                except (OSError, ValueError, KeyError, IndexError, struct.error, zlib.error):
                    continue
                if np.isnan(grid).all():
                    continue
                flat = grid.astype(np.float32).ravel()
                one = batch.slice(k, 1)
                px = pa.array([flat.astype("<f4").tobytes()], pa.binary()) if packed else pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), pa.array(flat, mask=np.isnan(flat)))
                yield pa.RecordBatch.from_arrays([*one.columns, px], [*one.schema.names, "px"])
        close()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema.fields)
    return dealt.mapInArrow(run, f"{fields}, px {'binary' if packed else 'array<float>'}")


def terrarium_rgb(px: np.ndarray, z: int) -> np.ndarray:
    """A grid's Terrarium colours, as the column expressions give them."""
    step = 2.0 ** (19 - z) / 256
    v = np.where(np.isnan(px), 0.0, px.astype(np.float64))
    o = np.rint(v / step) * step + 32768.0
    whole = np.floor(o)
    parts = (np.floor(o / 256), o - np.floor(o / 256) * 256, (o - whole) * 256)
    return np.stack([np.clip(p, 0, 255).astype(np.uint8) for p in parts], axis=-1)


def encode_tiles(grids: DataFrame, method: int | None = None, image: str | None = None) -> DataFrame:
    """(z, x, y, px) to (z, x, y, tile_data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = []
            for z, px in zip(batch.column(0).to_pylist(), unpacked(batch.column(3), "<f4"), strict=True):
                side = round(len(px) ** 0.5)
                data.append(codec.encode(terrarium_rgb(px.astype(np.float64).reshape(side, side), z), method, image))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(data, pa.binary())], ["z", "x", "y", "tile_data"])

    return grids.select("z", "x", "y", "px").mapInArrow(run, "z int, x int, y int, tile_data binary")


def decode_tiles(tiles: DataFrame, keep: tuple[str, ...] = (), packed: bool = False) -> DataFrame:
    """(z, x, y, tile_data, ...) to (z, x, y, ..., px), lists or packed; payloads that can't be decoded give null."""
    kind, sql = (pa.binary(), "binary") if packed else (pa.list_(pa.float32()), "array<float>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grids = []
            for data in batch.column(batch.num_columns - 1).to_pylist():
                try:
                    c = codec.decode(data).astype(np.float64)
                    grids.append((c[:, :, 0] * 256 + c[:, :, 1] + c[:, :, 2] / 256 - 32768).astype("<f4").ravel())
                    if packed:
                        grids[-1] = grids[-1].tobytes()
                except Exception:  # a broken payload is no tile, whatever the codec raises
                    grids.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(grids, kind)], [*batch.schema.names[:-1], "px"])

    columns = ["z", "x", "y", *keep]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tiles.select(*columns).schema.fields)
    return tiles.select(*columns, "tile_data").mapInArrow(run, f"{fields}, px {sql}")


def lineage_tiles(merged: DataFrame, palette: dict[int, tuple[int, int, int]] | None = None, image: str | None = None) -> DataFrame:
    """(z, x, y, prov) to images in the palette's colours."""
    colours = PALETTE if palette is None else palette

    def colour(i: int) -> tuple[int, int, int]:
        return colours.get(i, extra_colour(i))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [codec.encode(lineage_image(prov, colour), image=image) for prov in unpacked(batch.column(3), "<i2")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(data, pa.binary())], ["z", "x", "y", "tile_data"])

    return merged.select("z", "x", "y", "prov").mapInArrow(run, "z int, x int, y int, tile_data binary")


def lineage_image(prov: np.ndarray, colour) -> np.ndarray:
    """A square grid of source numbers in their colours."""
    x = np.asarray(prov, np.int64)
    side = round(len(x) ** 0.5)
    own, at = np.unique(x, return_inverse=True)
    return np.array([colour(int(i)) for i in own], np.uint8)[at].reshape(side, side, 3)
