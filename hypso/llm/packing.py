"""Best-fit packing of token sequences after the Martello-Toth dominance reduction.

A packing instance is its histogram: how many pieces have each length, at most as many numbers as a sequence has
tokens. So only the histogram reaches the driver, whatever the data. There the reduction fixes small sets that
provably dominate every other way to fill a piece's sequence, for whole multiplicities at once; best fit in decreasing
order packs what remains, again by multiplicity. The plan is a bounded list of runs (length, ranks, first sequence,
offset); pieces are ranked inside their length by a distributed count and look their place up.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import wordbpe
from .shared import bounded_batches, cut, small, trim

SIZE = 2048
END = 0
#: Pieces of one length that one task ranks, about.
EACH = 500_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenized(docs: DataFrame, spec: bytes, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: each document's ids, then END; only longer ones are cut, every ``size`` ids."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = wordbpe.of(shared.value)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for i in range(0, len(texts), 512):
                own = [t or b"" for t in texts[i : i + 512]]
                flat, counts = encoder.encode(own)
                flat, at, rows = flat.astype("<u4"), 0, []
                for k, n in enumerate(counts.tolist()):
                    whole = np.append(flat[at : at + n], np.uint32(END)).astype("<u4")
                    at += n
                    for p, s in enumerate(range(0, n + 1, size)):
                        cutout = whole[s : s + size]
                        rows.append((ids[i + k], p, s, len(cutout), zlib.crc32(cutout.tobytes())))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])
        trim()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, PIECES)


class _Items:
    """Lengths still to place, with their counts."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {w: n for w, n in counts.items() if n > 0}
        self.order = sorted(self.counts)

    def take(self, w: int, n: int) -> None:
        self.counts[w] -= n
        if not self.counts[w]:
            del self.counts[w]
            self.order.pop(bisect.bisect_left(self.order, w))

    def put(self, w: int) -> None:
        if w not in self.counts:
            bisect.insort(self.order, w)
            self.counts[w] = 0
        self.counts[w] += 1

    def partner(self, i: int, room: int) -> int | None:
        """The longest item that fits beside one item ``i``."""
        k = bisect.bisect_right(self.order, room)
        if k and self.order[k - 1] == i and self.counts[i] < 2:
            k -= 1
        return self.order[k - 1] if k else None

    def at_most(self, w: int) -> int | None:
        k = bisect.bisect_right(self.order, w)
        return self.order[k - 1] if k else None

    def smallest(self, k: int) -> list[int]:
        out: list[int] = []
        for w in self.order:
            out += [w] * min(self.counts[w], k - len(out))
            if len(out) == k:
                break
        return out

    def best_pair(self, room: int) -> tuple[int, int] | None:
        """Two items with the largest sum that fits; of equal sums, the one with the largest item."""
        best, i, j = None, 0, len(self.order) - 1
        while i <= j:
            a, b = self.order[i], self.order[j]
            if a + b > room or (i == j and self.counts[a] < 2):
                j -= 1
                continue
            if best is None or a + b > sum(best):
                best = (b, a)
            i += 1
        return best


def reduce_instance(counts: dict[int, int], size: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """Sets fixed by dominance, as (lengths, times), and the counts that remain.

    For an item j, the largest first, with room r = size - j, and i the largest other item that fits:
    nothing fits: {j}. i fills the room: {j, i}, since i can be exchanged for whatever shares j's sequence. No two
    items fit: {j, i}. No three fit, and i is as long as the best pair: {j, i}. No three fit, the pair (i, b) is the
    best partner of i, and no pair with both items longer than b fits: {j, i, b}, since of any pair one goes into i's
    place and the other into b's. Else j remains for best fit.
    """
    left, fixed = _Items(counts), []
    for j in sorted(counts, reverse=True):
        while left.counts.get(j):
            room = size - j
            left.take(j, 1)
            chosen = _dominating(left, j, room)
            left.put(j)
            if chosen is None:
                break  # these stay for best fit, and stay in view as partners of smaller ones
            need = defaultdict(int)
            for w in chosen:
                need[w] += 1
            # The argument holds again while every length in view is still there: the smallest items only grow and
            # the best pair only shrinks. The last of a length is looked at anew.
            times = min(left.counts[w] // n for w, n in need.items())
            if len(chosen) > 1:
                times = max(1, min(times, *((left.counts[w] - 1) // n for w, n in need.items())))
            fixed.append((chosen, times))
            for w, n in need.items():
                left.take(w, n * times)
    return fixed, dict(left.counts)


def _dominating(left: _Items, j: int, room: int) -> tuple[int, ...] | None:
    i = left.at_most(room)
    small = left.smallest(3)
    if i is None:
        return (j,)
    if i == room or len(small) < 2 or sum(small[:2]) > room:
        return j, i
    if len(small) > 2 and sum(small) <= room:
        return None
    if i >= sum(left.best_pair(room)):
        return j, i
    b = left.partner(i, room - i)
    if b is not None:
        longer = left.order[bisect.bisect_right(left.order, b) :]
        if not longer or longer[0] + (longer[0] if left.counts[longer[0]] > 1 else longer[1] if len(longer) > 1 else room) > room:
            return j, i, b
    return None


def best_fit(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit in decreasing order on multiplicities: (lengths, times) of each kind of sequence."""
    open_: dict[int, list[list]] = defaultdict(list)  # room -> [lengths, times]
    rooms: list[int] = []

    def put(room: int, lengths: tuple[int, ...], times: int) -> None:
        if room not in open_:
            bisect.insort(rooms, room)
        for kind in open_[room]:
            if kind[0] == lengths:
                kind[1] += times
                return
        open_[room].append([lengths, times])

    for w in sorted(counts, reverse=True):
        n = counts[w]
        while n:
            k = bisect.bisect_left(rooms, w)
            if k == len(rooms):
                each = size // w
                if n // each:
                    put(size - w * each, (w,) * each, n // each)
                if n % each:
                    put(size - w * (n % each), (w,) * (n % each), 1)
                break
            room = rooms[k]
            kinds = open_[room]
            lengths, times = kinds[-1]
            each = min(room // w, n)
            took = min(times, n // each)
            kinds[-1][1] -= took
            if not kinds[-1][1]:
                kinds.pop()
            if not kinds:
                del open_[room]
                rooms.pop(k)
            put(room - w * each, lengths + (w,) * each, took)
            n -= took * each
    return [(lengths, times) for kinds in open_.values() for lengths, times in kinds]


def plan(counts: dict[int, int], size: int = SIZE) -> tuple[dict[int, np.ndarray], int]:
    """For each length, runs (first rank, first sequence, stride 1, offset) in rank order; and the number of sequences."""
    fixed, rest = reduce_instance(counts, size)
    ranks, runs, sequence = defaultdict(int), defaultdict(list), 0
    for lengths, times in fixed + best_fit(rest, size):
        offset = 0
        for w in lengths:
            runs[w].append((ranks[w], sequence, offset))
            ranks[w] += times
            offset += w
        sequence += times
    return {w: np.array(r, np.int64) for w, r in runs.items()}, sequence


def pack(pieces: DataFrame, size: int = SIZE, each: int = EACH) -> DataFrame:
    """``pieces``, which are read once and checkpointed, with sequence_id and offset.

    Ranks inside a length come from counts by (length, bucket): a length has a bucket for every ``each`` pieces, so a
    length that very many pieces share is ranked by as many tasks as it needs, and at most ``size`` counts plus one for
    every ``each`` pieces reach the driver. Buckets are dealt by a row's own salt, so repeated rows don't crowd one; it is
    part of the checkpoint, as a row that changed its bucket between the counts and the ranks would tear the plan.
    """
    spark = pieces.sparkSession
    pieces = cut(pieces.withColumn("_salt", F.xxhash64("doc_id", "piece", F.monotonically_increasing_id())))
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    buckets = {w: -(-n // each) for w, n in counts.items() if n > each}
    many = F.create_map(*(F.lit(x) for pair in buckets.items() for x in pair))[F.col("length")] if buckets else F.lit(None).cast("int")
    salted = pieces.withColumn("_bucket", F.pmod("_salt", F.coalesce(many, F.lit(1))).cast("int"))
    first, before = [], defaultdict(int)
    for w, bucket, n in sorted((r["length"], r["_bucket"], r["count"]) for r in salted.groupBy("length", "_bucket").count().collect()):
        first.append((w, bucket, before[w]))
        before[w] += n
    runs, _ = plan(counts, size)
    shared = spark.sparkContext.broadcast(runs)
    starts = small(spark, first, "length long, _bucket int, _first long")
    rank = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")).cast("long") - 1
    ranked = salted.withColumn("_at", rank).join(F.broadcast(starts), ["length", "_bucket"])  # a row for each count above
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("_first") + F.col("_at")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lengths, ranks = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            for w in np.unique(lengths).tolist():
                own, table = np.flatnonzero(lengths == w), known[w]
                k = np.searchsorted(table[:, 0], ranks[own], "right") - 1
                sequence[own] = table[k, 1] + ranks[own] - table[k, 0]
                offset[own] = table[k, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, spec: bytes, size: int = SIZE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts count as empty: one piece that holds END alone. Null ids are kept; repeated rows are packed each.
    A very long text gives as many full pieces as needed. An empty table gives no rows; other columns play no part.
    """
    return pack(tokenized(docs, spec, size), size)
