"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

A Misra-Gries sketch (Spark's frequent-items aggregate, bounded counters, mergeable) names the digests that may hold
a large share of the rows. An exact count of just those digests, combined map-side, verifies them. The verified
winners, at most ``tracked`` rows, are broadcast, so rows of hot digests are settled where they lie; all other
digests, none of them hot, go through one ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, fresh

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A to Z and nothing else; texts of ASCII alone take the fast built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def frequent(keyed: DataFrame, key: str, tracked: int = 1024, groups: int = 64) -> DataFrame:
    """Keys that hold more than about one in ``tracked`` rows, and perhaps some others; at most ``tracked // 2``.

    Sketches are merged in two steps, so that no task reads a sketch from every partition of a large input.
    """
    first = keyed.groupBy((F.spark_partition_id() % groups).alias("_g")).agg(F.expr(f"approx_top_k_accumulate({key}, {tracked})").alias("s"))
    # A grouped aggregate: a global one would also merge the empty states of tasks without rows, which it can't.
    top = first.groupBy((F.col("_g") >= 0).alias("_one")).agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {tracked}), {tracked // 2})").alias("top"))
    return top.select(F.explode("top").alias("t")).where("t.count > 1").select(F.col("t.item").alias(key))


def settle(rows: DataFrame, key: str, order: str, largest: bool = True, tracked: int = 1024) -> DataFrame:
    """Adds ``best`` (the largest or smallest ``order`` of the rows with equal ``key``) and ``n`` (their number).

    ``rows`` is read several times, so it should be a checkpoint or a table. Rows with null ``order`` never win
    against others; if all are null, ``best`` is null.
    """
    best = F.max if largest else F.min
    hot = frequent(rows, key, tracked)
    verified = rows.join(F.broadcast(hot), key, "left_semi").groupBy(key).agg(best(order).alias("best"), F.count("*").alias("n")).where("n > 1")
    verified = cut(verified, tracked // 2)  # at most as many rows, a proven bound
    near = rows.join(F.broadcast(verified), key)
    cold = rows.join(F.broadcast(verified.select(key)), key, "left_anti")
    by = Window.partitionBy(key)
    cold = cold.withColumns({"best": best(order).over(by), "n": F.count("*").over(by)})
    return near.unionByName(cold)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = 1024) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A to Z; null counts as empty. Of equal texts the row with the
    largest id stays; a null id loses against any other. Of rows that repeat both id and text, one stays. An empty
    table gives no rows; other columns of the input, whatever their names, play no part.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.sha2(ascii_lower(text), 256).alias("text_sha256"))
    rows = cut(rows.withColumn("_row", F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"), F.monotonically_increasing_id().alias("row"))))
    out = settle(rows, "text_sha256", "_row", True, tracked)
    return out.select("doc_id", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("best.row") == F.col("_row.row")).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents themselves, one of each group of equal texts, with their own columns and no others.

    Whole rows move once, by id, which no hot text can skew. Null texts count as empty, null ids lose against others,
    of rows that repeat both id and text one stays, and an empty table stays empty, as ``exact_dedup`` has it.
    """
    # One key for the join and for rows that repeat both id and text, so that whole rows are dealt out once.
    def key(known: Column, sha: Column) -> Column:
        return F.concat(F.coalesce(known.cast("string"), F.lit("null")), F.lit(":"), sha)

    told = exact_dedup(docs, id_col, text_col)
    own = fresh(docs, "_own_key")
    stays = told.where("kept").select(key(F.col("doc_id"), F.col("text_sha256")).alias(own))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.withColumn(own, key(F.col(id_col), F.sha2(ascii_lower(text), 256)))
    return keyed.join(stays, own, "left_semi").dropDuplicates([own]).drop(own)
