"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns a unit vector; its hash is the
signed axis nearest to it, the coordinate of largest absolute value with its sign, among the first AXES coordinates.
A table concatenates two such hashes, or more as vectors grow in number, so that buckets stay small; each table has
rotations of its own. A vector lies in one bucket of each table; a query probes, in each table, the buckets of the
largest sums of its signed coordinates. Their number is a share of the buckets that falls with the vectors' number,
since the nearest of more are nearer: candidates grow more slowly than the table. They are reranked by exact cosines in
double precision. Queries that found fewer neighbours than asked for are then searched exactly, in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bytesvec import ragged
from .dedup_exact import settle
from .shared import cut

TABLES, AXES = 16, 64
#: A table's buckets hold so many vectors at most, on average.
CROWD = 64
#: The share of a table's buckets that is probed among FEW vectors. Among more it falls with the cube root of their
#: number, among fewer it rises with its square; of up to ALL vectors every bucket is probed, so none is missed.
SHARE, FEW, ALL = 0.026, 500, 128
#: Rows of a cell, and queries, that one task holds at most, and pairs whose vectors it holds at once.
BLOCK_ROWS, BLOCK_QUERIES, PAIRS = 8192, 2048, 100_000
#: Vectors that one task hashes, about.
EACH = 2000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, h = x.shape[1], 1
    x = x.copy()
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(x: np.ndarray, number: int, seed: int) -> np.ndarray:
    width = 1 << max(0, (x.shape[1] - 1).bit_length())
    if width != x.shape[1]:
        x = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    signs = np.random.Generator(np.random.PCG64([seed, number])).integers(0, 2, (3, width)) * 2.0 - 1.0
    for s in signs:
        x = hadamard(x * s)
    return x


def signed_axes(x: np.ndarray, table: int, rotations: int, seed: int) -> list[np.ndarray]:
    """For each rotation of a table, every row's coordinates on the signed axes: axis 0, its opposite, axis 1, ..."""
    out = []
    for r in range(rotations):
        y = rotated(x, table * 16 + r, seed)[:, :AXES]
        out.append(np.stack([y, -y], axis=2).reshape(len(y), -1))
    return out


def own_bucket(x: np.ndarray, table: int, rotations: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest signed axis of the first rotation, and of the others together as one number."""
    first, *others = (y.argmax(axis=1) for y in signed_axes(x, table, rotations, seed))
    rest = np.zeros(len(x), np.int64)
    wide = 2 * min(AXES, 1 << max(0, (x.shape[1] - 1).bit_length()))
    for y in others:
        rest = rest * wide + y
    return first, rest


def probed(x: np.ndarray, table: int, rotations: int, probes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first axis, others) of the ``probes`` buckets with the largest sums of coordinates, for each row."""
    names, total = None, None
    for y in signed_axes(x, table, rotations, seed):
        # No more than the nearest ``probes`` axes of a rotation can be part of the nearest ``probes`` buckets.
        at = np.argsort(-y, axis=1, kind="stable")[:, :probes]
        own = np.take_along_axis(y, at, 1)
        if names is None:
            names, total = at.astype(np.int64), own
            continue
        names = (names[:, :, None] * y.shape[1] + at[:, None, :]).reshape(len(y), -1)
        total = (total[:, :, None] + own[:, None, :]).reshape(len(y), -1)
        if names.shape[1] > probes:
            best = np.sort(np.argpartition(-total, probes - 1, axis=1)[:, :probes], axis=1)
            names, total = np.take_along_axis(names, best, 1), np.take_along_axis(total, best, 1)
    others = signed_axes(x[:1], table, 1, seed)[0].shape[1] ** (rotations - 1)
    return names // others, names % others


def plan(n: int, width: int) -> tuple[int, int]:
    """Rotations a table concatenates for ``n`` vectors, and buckets a query probes in it."""
    wide = 2 * min(AXES, 1 << max(0, (width - 1).bit_length()))
    rotations = 2
    while wide**rotations * CROWD < n and rotations < 6:
        rotations += 1
    share = 1.0 if n <= ALL else SHARE * (FEW / n) ** (2 if n < FEW else 1 / 3)
    return rotations, max(4, int(np.ceil(share * wide**rotations)))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column's rows, all of one width, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(vec: str) -> Column:
    """Vectors that take part: not null, not empty, all components finite, not all zero."""
    c = F.col(vec)
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & ~bad & F.exists(c, lambda v: v != 0), F.lit(False))


def _by_width(batch: pa.RecordBatch, rows: int = 1024) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of a batch whose vectors (column ``vec``) have one width, with their unit vectors."""
    sizes = np.diff(batch.column("vec").offsets.to_numpy())
    for w in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == w)
        for i in range(0, len(at), rows):
            part = batch.take(pa.array(at[i : i + rows]))
            x = matrix(part.column("vec"))
            scale = np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
            x = x / scale
            yield part, x / np.linalg.norm(x, axis=1, keepdims=True)


def _buckets(entries: DataFrame, n: int, tables: int, seed: int) -> DataFrame:
    """Entries with (cell, code) for each table: a cell is a table and its first axis, for one width of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _by_width(batch):
                rotations, _ = plan(n, x.shape[1])
                for t in range(tables):
                    first, rest = own_bucket(x, t, rotations, seed)
                    cell = (np.int64(x.shape[1]) * tables + t) * (2 * AXES) + first
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell), pa.array(rest)], [*part.schema.names, "cell", "code"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in entries.schema)
    return entries.mapInArrow(run, f"{kinds}, cell long, code long")


def _probes(asked: DataFrame, n: int, tables: int, seed: int) -> DataFrame:
    """Queries with (cell, codes) for each cell that holds a probed bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in _by_width(batch, 128):
                rotations, probes = plan(n, x.shape[1])
                for t in range(tables):
                    first, rest = probed(x, t, rotations, probes, seed)
                    owner = np.repeat(np.arange(len(x)), first.shape[1])
                    order = np.lexsort((rest.ravel(), first.ravel(), owner))
                    owner, first, rest = owner[order], first.ravel()[order], rest.ravel()[order]
                    begin = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (first[1:] != first[:-1])))
                    codes = pa.ListArray.from_arrays(pa.array(np.append(begin, len(rest)).astype(np.int32)), pa.array(rest))
                    cell = (np.int64(x.shape[1]) * tables + t) * (2 * AXES) + first[begin]
                    told = part.take(pa.array(owner[begin]))
                    yield pa.RecordBatch.from_arrays([*told.columns, pa.array(cell), codes], [*told.schema.names, "cell", "codes"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema)
    return asked.mapInArrow(run, f"{kinds}, cell long, codes array<long>")


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows. Each depends on its pair alone, not on the others computed with it."""
    a, b = np.abs(x).max(axis=1, keepdims=True), np.abs(y).max(axis=1, keepdims=True)
    a, b = np.exp2(np.floor(np.log2(a))), np.exp2(np.floor(np.log2(b)))  # powers of two: nothing is rounded
    x, y = x / a, y / b
    return (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((y * y).sum(axis=1))


_FOUND = "query_id long, vec_id long, key string, copied boolean, score double"


def _reranked(k: int):
    """A kernel for one cell: of each query's candidates there, those of the best k + 1 ids. One more than asked for, as
    the entry that holds the query itself may be expanded to others. Of equal scores the smaller ids come first. An
    id's other vectors are kept where copies of them have other ids."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if left.num_rows and right.num_rows:
            code, x, y = left.column("code").to_numpy(), matrix(left.column("vec")), matrix(right.column("vec"))
            order = np.argsort(code, kind="stable")
            code, ids, copied = code[order], left.column("vec_id").to_numpy(), left.column("copied").to_numpy()
            codes = right.column("codes").combine_chunks()
            if codes.null_count:  # an exact search: all rows are candidates
                low, high, owner = np.zeros(len(y), np.int64), np.full(len(y), len(x)), np.arange(len(y))
            else:
                wanted = codes.flatten().to_numpy()
                low, high = np.searchsorted(code, wanted, "left"), np.searchsorted(code, wanted, "right")
                owner = np.repeat(np.arange(len(y)), np.diff(codes.offsets.to_numpy()))
            size = high - low
            # Runs of whole queries with about PAIRS pairs.
            each = np.bincount(owner, size, len(y)).astype(np.int64)
            ends = np.cumsum(each)
            start = 0
            while start < len(y):
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + PAIRS, "right")))
                own = np.flatnonzero((owner >= start) & (owner < stop) & (size > 0))
                start = stop
                q, r = np.repeat(owner[own], size[own]), order[ragged(low[own], size[own])]
                score = np.concatenate([cosines(x[r[i : i + PAIRS]], y[q[i : i + PAIRS]]) for i in range(0, len(q), PAIRS)]) if len(q) else np.zeros(0)
                best = np.lexsort((ids[r], -score, q))
                q, r, score = q[best], r[best], score[best]
                first = np.zeros(len(q), bool)
                first[np.unique(np.stack([q, ids[r]]), axis=1, return_index=True)[1]] = True
                seen = np.concatenate([[0], np.cumsum(first)])
                keep = (seen[1:] - seen[np.searchsorted(q, q, "left")] <= k + 1) & (first | copied[r])
                out.append((q[keep], r[keep], score[keep]))
        q, r, score = (np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out, strict=True) if out else ((), (), ())))
        q, r = pa.array(q.astype(np.int64)), pa.array(r.astype(np.int64))
        return pa.table({"query_id": right.column("query_id").take(q), "vec_id": left.column("vec_id").take(r), "key": left.column("key").take(r), "copied": left.column("copied").take(r), "score": pa.array(score.astype(np.float64))})

    return run


def _met(base: DataFrame, probe: DataFrame, k: int) -> DataFrame:
    """Reranked candidates of rows and probes by cell; crowded cells are cut into parts that meet all their probes."""
    n = base.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("parts"))
    q = probe.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("turns"))
    sizes = n.join(q, "cell")
    base = base.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id", "key"), F.col("parts")).cast("int"))
    base = base.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    probe = probe.join(sizes, "cell").withColumn("turn", F.pmod(F.xxhash64("query_id", "key"), F.col("turns")).cast("int"))
    probe = probe.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    left = base.select("cell", "part", "turn", "vec_id", "key", "copied", "vec", "code").groupBy("cell", "part", "turn")
    # The vectors of both sides may be one column of one table; its alias is another column.
    right = probe.select("cell", "part", "turn", "query_id", F.col("vec").alias("vec"), "codes").groupBy("cell", "part", "turn")
    return left.cogroup(right).applyInArrow(_reranked(k), _FOUND)


def _named(found: DataFrame, copies: DataFrame, k: int) -> DataFrame:
    """The best k of each query, entries expanded to the ids of all equal vectors."""
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.groupBy("query_id", "vec_id", "key", "copied").agg(F.max("score").alias("score"))
    order = (F.desc("score"), "vec_id", "key")
    found = found.withColumn("first", (F.row_number().over(Window.partitionBy("query_id", "vec_id").orderBy(*order)) == 1).cast("int"))
    found = found.withColumn("ids", F.sum("first").over(Window.partitionBy("query_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).where(F.col("ids") <= k + 1)
    more = found.withColumnRenamed("vec_id", "entry").join(copies, ["entry", "key"]).select("query_id", F.col("copy").alias("vec_id"), "score")
    every = found.select("query_id", "vec_id", "score").unionByName(more).where("vec_id <> query_id")
    every = every.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return every.withColumn("rank", F.row_number().over(by_query).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, tables: int = TABLES, seed: int = 7) -> DataFrame:
    """For each query its k nearest found: query_id, rank, vec_id, score (the cosine in double precision).

    ``vectors`` and ``queries`` hold (vec_id long, vec array<float> or array<double>); a query's own id is no candidate.
    Vectors that are null, zero or hold null or non-finite components, and null ids, take no part. Vectors of several
    widths are searched each among those of its own. Equal vectors are indexed once and expanded at the end, of each
    the k + 2 smallest ids, which loses nothing since ties go to the smaller id. An id given several times stands for
    each of its different vectors, and the best of their cosines counts. A query that hashing gives fewer than k
    neighbours is searched exactly among all vectors, so it gets all candidates where there are fewer. An empty table
    gives no rows; other columns of the inputs, whatever their names, play no part.
    """
    def named(rows: DataFrame) -> DataFrame:
        text = F.array_join(F.col("vec").cast("array<string>"), ",").cast("binary")
        return rows.where(usable("vec") & F.col("vec_id").isNotNull()).select("vec_id", "vec", F.sha2(text, 256).alias("key"))

    keyed = cut(named(vectors))
    n = keyed.count()
    asked = cut(named(queries).dropDuplicates(["vec_id", "key"]).select(F.col("vec_id").alias("query_id"), "key", "vec"), n, EACH)
    # Equal vectors: one entry, named by its smallest id.
    grouped = cut(settle(keyed.select("vec_id", "key"), "key", "vec_id", largest=False).select("vec_id", "key", "best", (F.col("n") > 1).alias("copied")), n)
    entries = keyed.join(grouped.where("vec_id = best").select("vec_id", "key", "copied").distinct(), ["vec_id", "key"]).dropDuplicates(["vec_id", "key"])
    entries = cut(entries.select("vec_id", "key", "copied", "vec"), n, EACH)
    few = Window.partitionBy("best", "key").orderBy("vec_id")
    copies = grouped.where("vec_id <> best").select("best", "key", "vec_id").distinct()
    copies = copies.withColumn("r", F.row_number().over(few)).where(F.col("r") <= k + 1).select(F.col("best").alias("entry"), "key", F.col("vec_id").alias("copy"))
    base, probe = cut(_buckets(entries, n, tables, seed)), cut(_probes(asked, n, tables, seed))
    told = cut(_named(_met(base, probe, k), copies, k), n)
    short = asked.join(told.where(F.col("rank") == k).select("query_id"), "query_id", "left_anti")
    short = cut(short.select("query_id", "key", "vec", F.size("vec").cast("long").alias("cell"), F.lit(None).cast("array<long>").alias("codes")), n, EACH)
    if short.isEmpty():
        return told
    whole = entries.select("vec_id", "key", "copied", "vec", F.size("vec").cast("long").alias("cell"), F.lit(0).cast("long").alias("code"))
    exact = _named(_met(whole, short, k), copies, k)
    return told.join(short.select("query_id").distinct(), "query_id", "left_anti").unionByName(exact)


def search_table(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows."""
    vec = F.col("embedding")
    if dict(embeddings.select("embedding").dtypes)["embedding"] != "array<float>":  # floats are as exact in half the space
        vec = vec.cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"))
    return nearest(rows, rows.where(F.col("vec_id") % every == 0), k)
