"""Merging pixels and tiles of prioritised sources.

In long form (a row per pixel) every merge is one commutative aggregate, since the order lives in the key that is
compared and not in arrival: Spark combines map-side and shuffles one row per pixel and task. In array form (a row per
tile and source) each grid is shuffled once, and a tile's few candidates are folded by an Arrow kernel.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import terrarium

TILE = ("z", "x", "y")


def no_data(value: Column, marker: float | None = None) -> Column:
    """NaN and the source's marker as null; Spark would take NaN for the largest number."""
    v = F.nanvl(value, F.lit(None).cast("double"))
    return v if marker is None else F.nullif(v, F.lit(marker))


def priority_merge(pixels: DataFrame, key: Sequence[str], order: Sequence[str], value: str = "elev", source: str = "prio") -> DataFrame:
    """Of each pixel the first value that isn't null in the order of ``order``, and its source (-1 if all are null).

    Value and source come from one aggregate, so no second pass is needed for the lineage.
    """
    best = F.expr(f"min_by(struct({value} AS v, {source} AS s), struct({', '.join(order)})) FILTER (WHERE {value} IS NOT NULL)")
    merged = pixels.groupBy(*key).agg(best.alias("_best"))
    return merged.select(*key, F.col("_best.v").alias(value), F.coalesce(F.col("_best.s"), F.lit(-1)).alias("prov"))


def max_merge(pixels: DataFrame, key: Sequence[str], value: str = "elev") -> DataFrame:
    """The largest value of each pixel. No data that was encoded as 0 m counts as 0."""
    return pixels.groupBy(*key).agg(F.max(value).alias(value))


def drop_empty_tiles(pixels: DataFrame, value: str = "elev", tile: Sequence[str] = TILE) -> DataFrame:
    """Pixels of the tiles that hold any value."""
    return pixels.withColumn("_any", F.count(value).over(Window.partitionBy(*tile))).where("_any > 0").drop("_any")


def encoded(merged: DataFrame, value: str = "elev") -> DataFrame:
    """With r, g, b at each row's zoom."""
    return merged.withColumns(terrarium.encode(value, "z"))


def unpacked(column: pa.Array | pa.ChunkedArray, kind: str) -> Iterator[np.ndarray]:
    """A column's grids, from lists or packed as bytes; null elements of lists are NaN."""
    packed = pa.types.is_binary(column.type)
    for v in column:
        yield np.frombuffer(v.as_buffer(), kind) if packed else v.values.to_numpy(zero_copy_only=False).astype(kind)


def _one(group: pa.Table, grids: dict[str, np.ndarray], value: str, packed: bool) -> pa.Table:
    """A tile's row; none if it has no value."""

    def column(name: str, x: np.ndarray) -> pa.Array:
        if packed:
            return pa.array([x.tobytes()], pa.binary())
        return pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, mask=np.isnan(x) if name == value else None))

    out = pa.table({c: group.column(c).slice(0, 1) for c in TILE} | {n: column(n, x) for n, x in grids.items()})
    return out.slice(0, 0) if np.isnan(grids[value]).all() else out


def _kinds(grids: DataFrame, value: str, *more: str) -> tuple[bool, str]:
    """Whether grids are packed, and the result's columns."""
    packed = isinstance(grids.schema[value].dataType, T.BinaryType)
    told = [f"{f.name} {f.dataType.simpleString()}" for f in grids.select(*TILE).schema.fields]
    return packed, ", ".join([*told, f"{value} {'binary' if packed else 'array<float>'}", *(f"{m} {'binary' if packed else 'array<smallint>'}" for m in more)])


def merge_grids(grids: DataFrame, order: Sequence[str], value: str = "px", source: str = "prio") -> DataFrame:
    """Array form: (z, x, y, px, prio, ...) to (z, x, y, px, prov), tiles without any value left out.

    A tile's candidates meet in one task; they are as many as sources overlap it, not as many as there are tiles.
    Grids are lists, or packed as the bytes of little-endian float32 with NaN for no data; then the sources are the
    bytes of int16. Packed ones pass between Spark and Arrow as they are, lists element by element.
    """
    packed, schema = _kinds(grids, value, "prov")

    def fold(group: pa.Table) -> pa.Table:
        group = group.sort_by([(c, "ascending") for c in order])
        px, prov = None, None
        for grid, name in zip(unpacked(group.column(value), "<f4"), group.column(source).to_pylist(), strict=True):
            if px is None:
                px, prov = np.full(len(grid), np.nan, "<f4"), np.full(len(grid), -1, "<i2")
            take = np.isnan(px) & ~np.isnan(grid)
            px[take], prov[take] = grid[take], name
        return _one(group, {value: px, "prov": prov}, value, packed)

    rows = grids.select(*dict.fromkeys([*TILE, *order, source, value]))
    return rows.groupBy(*TILE).applyInArrow(fold, schema)


def max_grids(grids: DataFrame, value: str = "px") -> DataFrame:
    """Array form of ``max_merge``, of lists or packed grids; tiles without any value are left out."""
    packed, schema = _kinds(grids, value)

    def fold(group: pa.Table) -> pa.Table:
        return _one(group, {value: functools.reduce(np.fmax, unpacked(group.column(value), "<f4"))}, value, packed)

    return grids.select(*TILE, value).groupBy(*TILE).applyInArrow(fold, schema)


def tile_pixels(grids: DataFrame, width: int, value: str = "px") -> DataFrame:
    """A grid's pixels as rows (row, col, elev)."""
    others = [c for c in grids.columns if c != value]
    return grids.select(*others, F.posexplode(value).alias("_i", "elev")).select(*others, F.call_function("div", "_i", F.lit(width)).cast("int").alias("row"), (F.col("_i") % width).cast("int").alias("col"), "elev")


def ranked_candidates(candidates: DataFrame, order: Sequence[str], tile: Sequence[str] = TILE) -> DataFrame:
    """With ``rank`` 1, 2, ... in the order of reading inside each tile."""
    return candidates.withColumn("rank", F.row_number().over(Window.partitionBy(*tile).orderBy(*order)))


def tile_priority(tiles: DataFrame, order: str = "src_idx", empty_is_missing: bool = True) -> DataFrame:
    """Of each tile the payload of the first archive that has it."""
    there = "tile_data IS NOT NULL" + (" AND length(tile_data) > 0" if empty_is_missing else "")
    best = F.expr(f"min_by(struct(tile_data AS d, {order} AS s), {order}) FILTER (WHERE {there})")
    return tiles.groupBy(*TILE).agg(best.alias("_b")).where("_b IS NOT NULL").select(*TILE, F.col("_b.d").alias("tile_data"), F.col("_b.s").alias(order))


def last_wins(tiles: DataFrame, order: Sequence[str], key: Sequence[str] = TILE) -> DataFrame:
    """Upsert: of rows with one key, the last in the order stays."""
    w = Window.partitionBy(*key).orderBy(*(F.desc(c) for c in order))
    return tiles.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def first_wins(tiles: DataFrame, order: Sequence[str], key: Sequence[str] = TILE) -> DataFrame:
    """Insert or ignore: of rows with one key, the first in the order stays."""
    w = Window.partitionBy(*key).orderBy(*order)
    return tiles.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def insert_missing(target: DataFrame, tiles: DataFrame, key: Sequence[str] = TILE) -> DataFrame:
    """``target`` and those of ``tiles`` whose key it lacks."""
    return target.unionByName(tiles.join(target, list(key), "left_anti"))
