"""Zoom groups: named patterns, estimates, validation, and splits by a memory target.

Spark needs no split to bound memory; groups serve as output partitions and as units of a resumable run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import tilemath as M
from ..schema import JAPAN

BASE_GB, GB_PER_MILLION = 4.0, 2.0


@dataclass(frozen=True)
class ZoomGroup:
    min_zoom: int
    max_zoom: int
    estimated_tiles: int
    estimated_memory_gb: float

    @property
    def name(self) -> str:
        return f"z{self.min_zoom}" if self.min_zoom == self.max_zoom else f"z{self.min_zoom}-{self.max_zoom}"


# Fixed values: (lowest zoom, highest zoom, tiles, GB) of each group.
PATTERNS: dict[str, tuple[tuple[int, int, int, float], ...]] = {
    "single": ((0, 16, 20_000_000, 40.0),),
    "balanced": ((0, 10, 55_000, 6.0), (11, 12, 200_000, 8.0), (13, 14, 1_000_000, 10.0), (15, 16, 20_000_000, 10.0)),
    "safe": ((0, 9, 14_000, 5.0), (10, 11, 90_000, 6.0), (12, 12, 130_000, 7.0), (13, 13, 500_000, 8.0), (14, 14, 2_000_000, 9.0), (15, 16, 20_000_000, 10.0)),
    "fast": ((0, 11, 250_000, 8.0), (12, 13, 1_500_000, 12.0), (14, 16, 22_000_000, 12.0)),
    "incremental": ((0, 6, 5_000, 3.0), (7, 9, 9_000, 4.0), (10, 10, 40_000, 5.0), (11, 11, 80_000, 6.0), (12, 12, 130_000, 7.0), (13, 13, 500_000, 8.0), (14, 14, 2_000_000, 9.0), (15, 15, 8_000_000, 10.0), (16, 16, 12_000_000, 10.0)),
}


def pattern(name: str = "balanced") -> list[ZoomGroup]:
    try:
        return [ZoomGroup(*g) for g in PATTERNS[name]]
    except KeyError:
        raise ValueError(f"no such pattern: {name}; there are {', '.join(PATTERNS)}") from None


def pattern_table(spark: SparkSession) -> DataFrame:
    rows = [(n, i, *g) for n, groups in PATTERNS.items() for i, g in enumerate(groups)]
    return spark.createDataFrame(rows, "pattern string, ord int, min_zoom int, max_zoom int, estimated_tiles bigint, estimated_memory_gb double")


def coverage_report(groups: DataFrame, max_zoom: int = 16) -> DataFrame:
    """Per group, whether it begins right after its predecessor, is not inverted, and, if last, ends at ``max_zoom``."""
    w = Window.partitionBy("pattern").orderBy("ord")
    starts = F.coalesce(F.lag("max_zoom").over(w) + 1, F.lit(0))
    last = F.lead("ord").over(w).isNull()
    ok = (F.col("min_zoom") == starts) & (F.col("min_zoom") <= F.col("max_zoom")) & (~last | (F.col("max_zoom") == max_zoom))
    name = F.when(F.col("min_zoom") == F.col("max_zoom"), F.format_string("z%d", "min_zoom")).otherwise(F.format_string("z%d-%d", "min_zoom", "max_zoom"))
    return groups.select("pattern", "ord", name.alias("name"), starts.alias("expected_start"), ok.alias("ok"))


def validate(groups: list[ZoomGroup], max_zoom: int = 16) -> None:
    """Raises ValueError unless the groups cover 0 to ``max_zoom`` without gap."""
    if not groups:
        raise ValueError("there are no groups")
    start = 0
    for g in groups:
        if g.min_zoom != start:
            raise ValueError(f"group {g.name} should begin at z{start}")
        if g.max_zoom < g.min_zoom:
            raise ValueError(f"group {g.name} is inverted")
        start = g.max_zoom + 1
    if start != max_zoom + 1:
        raise ValueError(f"the groups end at z{start - 1}, not at z{max_zoom}")


def tiles_by_zoom(spark: SparkSession, low: int, high: int, bbox: tuple[float, float, float, float] = JAPAN) -> DataFrame:
    return spark.range(low, high + 1).select(F.col("id").cast("int").alias("z")).withColumn("tiles", M.estimated_tiles("z", bbox))


def estimate_tiles(spark: SparkSession, low: int, high: int, bbox: tuple[float, float, float, float] = JAPAN) -> int:
    return max(1, tiles_by_zoom(spark, low, high, bbox).agg(F.sum("tiles")).first()[0] or 0)


def memory_gb(tiles: float) -> float:
    return BASE_GB + tiles / 1e6 * GB_PER_MILLION


def custom_split(spark: SparkSession, max_zoom: int, target_gb: float = 10.0, bbox: tuple[float, float, float, float] = JAPAN) -> list[ZoomGroup]:
    """Greedy groups: one is closed at the zoom where its estimate reaches the target. At most 18 rows are folded."""
    counts = {r["z"]: r["tiles"] for r in tiles_by_zoom(spark, 0, max_zoom, bbox).collect()}
    out, low, tiles = [], 0, 0
    for z in range(max_zoom + 1):
        tiles += counts[z]
        if memory_gb(tiles) >= target_gb or z == max_zoom:
            out.append(ZoomGroup(low, z, tiles, memory_gb(tiles)))
            low, tiles = z + 1, 0
    return out
