"""Inspection of merged tiles and of run telemetry."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE = ("z", "x", "y")


def fill_report(pixels: DataFrame, upper: str, lower: str, key: tuple[str, ...] = TILE) -> DataFrame:
    """Per tile, how a lower-priority source fills the upper one.

    ``pixels`` has both sources' values as columns. Valid pixels of each, pixels filled by the lower alone and their
    share in percent of all, mean and largest absolute difference where both are valid.
    """
    a, b = F.col(upper), F.col(lower)
    both = a.isNotNull() & b.isNotNull()
    gap = F.when(both, F.abs(a - b))
    filled = F.count_if(a.isNull() & b.isNotNull())
    return pixels.groupBy(*key).agg(
        F.count(a).alias("upper_valid"), F.count(b).alias("lower_valid"), filled.alias("filled_by_lower"),
        (F.lit(100.0) * filled / F.count("*")).alias("filled_percent"), F.avg(gap).alias("mean_abs_diff"), F.max(gap).alias("max_abs_diff"),
    )


def fill_by_source(pixels: DataFrame) -> DataFrame:
    """Per source (priority, source), from rows with an archive's ``stored`` value, the source's ``elev`` and ``in_first``:
    see ``inspect_fill`` of the plans."""
    has, stored = F.col("elev").isNotNull(), F.col("stored").isNotNull()
    gap, filled = F.when(has & stored, F.abs(F.col("elev") - F.col("stored"))), F.count_if(~has & stored)
    return pixels.groupBy("priority", "source").agg(
        F.count("elev").alias("valid_pixels"), filled.alias("filled_pixels"), (F.lit(100.0) * filled / F.count("*")).alias("filled_percent"),
        F.avg(gap).alias("mean_abs_diff"), F.max(gap).alias("max_abs_diff"), F.count_if(has & F.col("in_first").isNull()).alias("candidates"),
    )


def side_by_side(pixels: DataFrame, key: tuple[str, ...], upper: int = 0, lower: int = 1) -> DataFrame:
    """Long pixels (key, prio, elev) to a row per pixel with the two sources' values."""
    return pixels.groupBy(*key).agg(F.expr(f"max(elev) FILTER (WHERE prio = {upper})").alias("upper"), F.expr(f"max(elev) FILTER (WHERE prio = {lower})").alias("lower"))


def recent_rate(events: DataFrame, by: list[str], at: str = "t", value: str = "v", seconds: int = 300, fewest: int = 2, fallback: int = 10) -> DataFrame:
    """Rate of change over the last ``seconds`` before each group's newest event, between the first and last there.

    If fewer than ``fewest`` events lie in that span, the last ``fallback`` events count; no span of time gives 0.
    ``at`` is in seconds. Ties in time are ordered by value.
    """
    group, newest = Window.partitionBy(*by), Window.partitionBy(*by).orderBy(F.desc(at), F.desc(value))
    rows = events.select(*by, F.col(at).alias("_t"), F.col(value).alias("_v"))
    newest = Window.partitionBy(*by).orderBy(F.desc("_t"), F.desc("_v"))
    rows = rows.withColumns({"_last": F.max("_t").over(group), "_n": F.row_number().over(newest)})
    recent = F.col("_t") >= F.col("_last") - seconds
    rows = rows.withColumn("_recent", F.count_if(recent).over(group))
    rows = rows.where(F.when(F.col("_recent") >= fewest, recent).otherwise(F.col("_n") <= fallback))
    key = F.struct("_t", "_v")
    ends = rows.groupBy(*by).agg(F.min_by("_v", key).alias("v0"), F.max_by("_v", key).alias("v1"), F.min("_t").alias("t0"), F.max("_t").alias("t1"), F.count("*").alias("n"))
    return ends.select(*by, F.when((F.col("n") >= 2) & (F.col("t1") > F.col("t0")), (F.col("v1") - F.col("v0")) / (F.col("t1") - F.col("t0"))).otherwise(F.lit(0.0)).alias("rate"))


def eta_seconds(rate, remaining):
    """Seconds to go; infinite at no progress."""
    return F.when(rate > 0, remaining / rate).otherwise(F.lit(float("inf")))


def running_peak(events: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return events.withColumn("peak", F.max(value).over(w))


def numbered_batches(rows: DataFrame, by: list[str], order: list[str], size: int = 250, checkpoint: int = 10_000, stretch: Column | None = None) -> DataFrame:
    """Batch numbers from 0 of ``size`` rows in order inside each group, and the rows after which a checkpoint falls.

    ``stretch``, which must not fall along the order (as an hour does not along time), cuts long groups: each stretch is
    numbered by a task of its own, from the count of the rows before it. Without it a group is numbered by one task.
    """
    if stretch is None:
        n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumns({"batch_id": F.floor((n - 1) / size), "is_checkpoint": n % checkpoint == 0})
    cut = rows.withColumn("_stretch", stretch)
    counts = cut.groupBy(*by, "_stretch").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    keys = [*by, "_stretch"]
    counts = counts.select(*(F.col(c).alias(f"_of_{c}") for c in keys), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy(*by, "_stretch").orderBy(*order))
    n = F.col("_before") + F.col("_within")
    same = reduce(operator.and_, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys))
    numbered = cut.withColumn("_within", within).join(counts, same)
    return numbered.select(*rows.columns, F.floor((n - 1) / size).alias("batch_id"), (n % checkpoint == 0).alias("is_checkpoint"))


def human_bytes(size):
    """Bytes in steps of 1024 with one decimal."""
    out = F.format_string("%.1f PB", size / float(1024**5))
    for k, unit in reversed(list(enumerate(("B", "KB", "MB", "GB", "TB")))):
        out = F.when(F.abs(size) < 1024.0 ** (k + 1), F.format_string(f"%.1f {unit}", size / 1024.0**k)).otherwise(out)
    return out
