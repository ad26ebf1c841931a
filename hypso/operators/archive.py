"""Statistics, comparison and union of tile archives."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tilemath as M
from . import merge

TILE = merge.TILE


def tile_stats(tiles: DataFrame) -> DataFrame:
    """Count, lowest and highest zoom, and extent in degrees; nulls for an empty archive.

    Columns and rows are monotone in degrees inside a zoom, so the extent needs only each zoom's extremes.
    """
    per_zoom = tiles.groupBy("z").agg(F.count("*").alias("n"), *(f(c).alias(f"{c}{i}") for c in ("x", "y") for i, f in enumerate((F.min, F.max))))
    low, high = M.lonlat_bounds("z", "x0", "y0"), M.lonlat_bounds("z", "x1", "y1")
    return per_zoom.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.min("z").alias("min_zoom"), F.max("z").alias("max_zoom"),
        F.min(low["west"]).alias("west"), F.min(high["south"]).alias("south"), F.max(high["east"]).alias("east"), F.max(low["north"]).alias("north"),
    )


def duplicate_tiles(tiles: DataFrame, file: str = "file", order: str = "src_idx") -> DataFrame:
    """A row for each later file that has a tile which an earlier one holds, naming the first holder."""
    w = Window.partitionBy(*TILE).orderBy(order)
    first = F.first(file).over(w)
    rows = tiles.select(*TILE, file, order).distinct()
    rows = rows.withColumns({"first_holder": first, "_n": F.row_number().over(w)}).where("_n > 1")
    return rows.select(*TILE, "first_holder", file, F.format_string("Duplicate tile at z%d/x%d/y%d: found in both %s and %s", "z", "x", "y", "first_holder", file).alias("message"))


def union_archives(archives: Sequence[DataFrame], verify: bool = True) -> DataFrame:
    """All tiles of disjoint archives; with ``verify`` a shared tile is an error, else the last archive wins.

    Verification shuffles keys alone, and once the archives are known to be disjoint no payload is shuffled.
    """
    if not archives:
        raise ValueError("no archives")
    every = reduce(DataFrame.unionByName, (a.select(*TILE, "tile_data", F.lit(i).alias("src_idx")) for i, a in enumerate(archives)))
    if not verify:
        return every.groupBy(*TILE).agg(F.max_by("tile_data", "src_idx").alias("tile_data"))
    shared = every.groupBy(*TILE).agg(F.countDistinct("src_idx").alias("n")).where("n > 1").orderBy(*TILE).limit(3).collect()
    if shared:
        raise ValueError("archives overlap, first at " + ", ".join(f"z{r.z}/x{r.x}/y{r.y}" for r in shared))
    return every.drop("src_idx")


def key_union(archives: Sequence[DataFrame]) -> DataFrame:
    out = None
    for a in archives:
        keys = a.select(*TILE)
        out = keys if out is None else out.union(keys)
    return out.distinct()


def archive_diff(reference: DataFrame, archive: DataFrame) -> DataFrame:
    """Per tile of either: matched, mismatch, missing (not in the archive) or extra."""
    a = reference.select(*TILE, F.col("tile_data").alias("_a"), F.lit(True).alias("_in_a"))
    b = archive.select(*TILE, F.col("tile_data").alias("_b"), F.lit(True).alias("_in_b"))
    both = a.join(b, list(TILE), "full_outer")
    status = F.when(F.col("_in_a").isNull(), "extra").when(F.col("_in_b").isNull(), "missing").when(F.col("_a").eqNullSafe(F.col("_b")), "matched").otherwise("mismatch")
    return both.select(*TILE, status.alias("status"))


def flip_lookup(keys: DataFrame, archive: DataFrame) -> DataFrame:
    """Payloads by XYZ keys from rows that may count from the south; where that finds none, from the row as given."""
    stored = archive.select("z", "x", F.col("y").alias("_row"), "tile_data")
    flipped = keys.withColumn("_row", M.flip_y("z", "y")).join(stored, ["z", "x", "_row"], "left").select("z", "x", "y", F.col("tile_data").alias("_first"))
    plain = stored.withColumnRenamed("_row", "y").withColumnRenamed("tile_data", "_second")
    return flipped.join(plain, ["z", "x", "y"], "left").select("z", "x", "y", F.coalesce("_first", "_second").alias("tile_data"))


def middle_zoom():
    """The zoom half way between an archive's lowest and highest, rounded down."""
    return F.floor((F.col("min_zoom") + F.col("max_zoom")) / 2)


def metadata_rows(stats: DataFrame, name: str, extra: dict[str, str] | None = None, encoding: str = "terrarium", image: str = "webp", attribution: str = "") -> DataFrame:
    """An archive's metadata (name, value) from its statistics; ``extra`` overrides. No rows for an empty archive."""
    text = lambda c: F.col(c).cast("string")
    mid = lambda a, b: ((F.col(a) + F.col(b)) / 2).cast("string")
    values = {
        "name": F.lit(name), "format": F.lit(image), "bounds": F.concat_ws(",", text("west"), text("south"), text("east"), text("north")),
        "minzoom": text("min_zoom"), "maxzoom": text("max_zoom"), "center": F.concat_ws(",", mid("west", "east"), mid("south", "north"), text("min_zoom")),
        "attribution": F.lit(attribution), "encoding": F.lit(encoding),
    } | {k: F.lit(str(v)) for k, v in (extra or {}).items()}
    return stats.where("n > 0").select(F.explode(F.array(*(F.struct(F.lit(k).alias("name"), v.alias("value")) for k, v in values.items()))).alias("m")).select("m.name", "m.value")


def merged_metadata(metadata: DataFrame) -> DataFrame:
    """One (name, value) set from several archives' (src_idx, name, value).

    Attributions are trimmed, made distinct, sorted and joined; all other names come from the first archive that has
    them. ``union_metadata`` gives a merged archive's own set.
    """
    trimmed = F.trim("value")
    joined = F.array_join(F.sort_array(F.collect_set(F.when((F.col("name") == "attribution") & (trimmed != ""), trimmed))), " | ")
    first = F.min_by("value", "src_idx")
    return metadata.groupBy("name").agg(F.when(F.col("name") == "attribution", joined).otherwise(first).alias("value"))


# What a merged archive says where its first input says nothing.
DEFAULTS = {"format": "webp", "encoding": "terrarium", "minzoom": "0", "maxzoom": "0"}


def union_metadata(metadata: DataFrame, stats: DataFrame, name: str, attribution: str = "") -> DataFrame:
    """(name, value) of a merged archive.

    Name, format and encoding are the first input's, else ``name`` and the defaults; the attribution is that of all
    inputs, else ``attribution``. Zooms and bounds are the tiles', of an archive without tiles the first input's, else
    zoom 0 and none. The center is the bounds' with the zoom between, and only set where there are tiles.
    """
    base = metadata.where("src_idx = 0").groupBy().pivot("name", ["name", "format", "encoding", "minzoom", "maxzoom", "bounds"]).agg(F.first("value"))
    base = base.select(*(F.col(c).alias(f"_{c}") for c in ("name", "format", "encoding", "minzoom", "maxzoom", "bounds")))
    told = merged_metadata(metadata.where("name = 'attribution'")).agg(F.max("value").alias("_attribution"))
    one = stats.join(told).join(base, how="left")  # one row each
    text = lambda c: F.col(c).cast("string")
    box = F.concat_ws(",", text("west"), text("south"), text("east"), text("north"))
    there = F.col("n") > 0
    values = {
        "name": F.coalesce("_name", F.lit(name)), "format": F.coalesce("_format", F.lit(DEFAULTS["format"])), "encoding": F.coalesce("_encoding", F.lit(DEFAULTS["encoding"])),
        "minzoom": F.coalesce(text("min_zoom"), "_minzoom", F.lit(DEFAULTS["minzoom"])), "maxzoom": F.coalesce(text("max_zoom"), "_maxzoom", F.lit(DEFAULTS["maxzoom"])),
        "attribution": F.coalesce(F.nullif("_attribution", F.lit("")), F.lit(attribution)), "bounds": F.when(there, box).otherwise(F.col("_bounds")),
        "center": F.when(there, F.concat_ws(",", ((F.col("west") + F.col("east")) / 2).cast("string"), ((F.col("south") + F.col("north")) / 2).cast("string"), middle_zoom().cast("string"))),
    }
    rows = one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("name"), v.alias("value")) for k, v in values.items()))).alias("m"))
    return rows.select("m.name", "m.value").where("value IS NOT NULL")


def upsert_metadata(metadata: DataFrame, new: dict[str, object]) -> DataFrame:
    """The rows of ``metadata`` with values replaced or added."""
    spark = metadata.sparkSession
    rows = spark.createDataFrame([(k, str(v)) for k, v in new.items()], "name string, value string")
    return metadata.join(rows, "name", "left_anti").unionByName(rows)


def key_check(tiles: DataFrame) -> DataFrame:
    """All rows against distinct keys."""
    return tiles.agg(F.count("*").alias("total"), F.countDistinct(*TILE).alias("distinct_keys"))
