"""Sharding by a Feistel permutation with cycle walking over global row numbers, in DataFrame functions only.

Every row gets a global number: rows equal in all columns are counted first, the different ones are hashed into buckets
whose number grows with the rows, bucket sizes give each bucket's first number (as many counts as buckets reach the
driver), and rows are numbered inside their bucket, a repeated one with as many numbers as it has copies. A Feistel network over a grid of a x b cells, a * b >= N, permutes the numbers under a seed; a cell beyond N is walked
on until it falls below N. With p the permuted number, the shard is p mod shards and the slot p div shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, small

ROUNDS = 6
STEPS = 64
#: Different rows that one task numbers, about, and copies of a row that one task unfolds at once.
EACH, RUN = 250_000, 10_000


def grid(n: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid with n cells or more; fewer cells are left over than one side has."""
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _div(x: Column, by: int) -> Column:
    """Whole division of longs, exact at any size."""
    return F.call_function("div", x, F.lit(by).cast("long"))


def _once(p: Column, a: int, b: int, seed: int) -> Column:
    def turn(s: Column, i: Column) -> Column:
        left, right = s["l"], s["r"]
        return F.when(
            i % 2 == 0, F.struct(F.pmod(left + F.pmod(F.xxhash64(F.lit(seed), i, right), F.lit(a)), F.lit(a)).cast("long").alias("l"), right.alias("r"))
        ).otherwise(F.struct(left.alias("l"), F.pmod(right + F.pmod(F.xxhash64(F.lit(seed), i, left), F.lit(b)), F.lit(b)).cast("long").alias("r")))

    start = F.struct(_div(p, b).alias("l"), F.pmod(p, F.lit(b)).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["l"] * F.lit(b) + s["r"])


def permuted(number: Column, n: int, seed: int) -> Column:
    """A permutation of 0 .. n-1, computable for any number alone.

    The walk ends within as many steps as cells are left over, or after a few, since they are fewer than one row of
    the grid; STEPS is never reached in practice, and reaching it raises an error.
    """
    a, b = grid(n)
    first = _once(number, a, b, seed)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), first, lambda p, _: F.when(p < F.lit(n), p).otherwise(_once(p, a, b, seed)))
    return F.when(walked < F.lit(n), walked).otherwise(F.raise_error(F.lit("the cycle walk did not end")).cast("long"))


def numbered(rows: DataFrame, by: list[str], least: int = 64, each: int = EACH) -> tuple[DataFrame, int]:
    """The columns ``by`` of all rows with ``number`` 0 .. N-1, and N. The order follows a hash of ``by``, then ``by``:
    the same rows get the same numbers in any layout, and rows that are equal get different ones.

    There is a bucket for every ``each`` different rows, ``least`` at least. Copies of one row become rows again in
    two steps of bounded width, so that no task unfolds a row that a third of the table repeats.
    """
    once = cut(rows.groupBy(*by).agg(F.count("*").alias("_copies")))
    buckets = max(least, -(-once.count() // each))
    once = once.withColumn("_bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int"))
    counts = sorted((r["_bucket"], r["n"]) for r in once.groupBy("_bucket").agg(F.sum("_copies").alias("n")).collect())
    first, total = [], 0
    for bucket, count in counts:
        first.append((bucket, total))
        total += count
    starts = small(rows.sparkSession, first, "_bucket int, _first long")
    before = Window.partitionBy("_bucket").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    out = once.withColumn("_at", F.coalesce(F.sum("_copies").over(before), F.lit(0)))
    out = out.join(F.broadcast(starts), "_bucket").withColumn("_at", F.col("_first") + F.col("_at"))  # one row per bucket
    alone = out.where("_copies = 1").select(*by, F.col("_at").alias("number"))
    # Runs of so many copies, dealt out, then the copies.
    runs = out.where("_copies > 1").withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), _div(F.col("_copies") - 1, RUN))))
    runs = runs.repartition(F.xxhash64(*by, "_run")).withColumn("_last", F.least(F.col("_copies"), (F.col("_run") + 1) * RUN) - 1)
    copies = runs.withColumn("_i", F.explode(F.sequence(F.col("_run") * RUN, F.col("_last")))).select(*by, (F.col("_at") + F.col("_i")).alias("number"))
    return alone.unionByName(copies), total


def shard_rows(docs: DataFrame, shards: int, seed: int = 20240229, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Law ``rows``: shard sizes differ by one row at most, and the slots of a shard are gapless from 0. A null text has
    size 8 and the checksum of the empty text; a null id is a value like any other. Equal rows get different slots.
    An empty table gives no rows; very long texts count by their bytes like others; other columns of the input, whatever
    their names, play no part. ``grown_shard`` is null under this law.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
    )
    rows, total = numbered(rows, ["doc_id", "size", "text_crc32"])
    p = permuted(F.col("number"), max(total, 1), seed)
    rows = rows.withColumn("_p", p)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.pmod("_p", F.lit(shards)).cast("int").alias("shard"),
        _div(F.col("_p"), shards).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
