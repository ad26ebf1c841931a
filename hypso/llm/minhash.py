"""Near-duplicate detection by MinHash with sequential Bayesian verification.

Texts with the same words (by the SHA-256 of their word sequence) are collapsed first. Signatures of the others are banded; documents that share a band's
bucket are candidates. A candidate pair's signatures are compared a batch at a time: after each batch, the posterior
of the similarity (binomial matches, uniform prior) gives the probability that the threshold is reached, and the pair
is pruned once that falls below ``miss``. Survivors are verified on their full shingle sets.

Candidates are never all pairs of a bucket. First every member meets one smallest id, that of its buckets' smallest
ids; verified links are contracted to components. Then members meet the smallest ids of their other buckets, where
those are of other components still. Only then, in buckets that hold several components, members outside the bucket's
largest component meet the members of other components, in blocks of bounded size. Blocks carry the hashed shingle
sets, so these pairs are verified where they meet and never become rows: a block gives a link only where it joins two
of its components. Pairs inside one component need no test, as no link can change the result, so no link that the
bands offer is lost; links are confirmed on the shingles themselves.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesvec as V
from .dedup_exact import settle
from .shared import bounded_batches, cut, files, release, trim

SHINGLE, PERCENT = 5, 80
BANDS, ROWS, BATCH = 24, 4, 16
MISS = 1e-9
#: Hashes (of 8 bytes) in the sets and signatures of one side of a block; 1 MB, or one text.
BLOCK = 2**17
_SIGNATURE = BANDS * ROWS // 2
#: Shingles of the texts whose sets a verifying task keeps for its next pairs.
HELD = 200_000

_rng = np.random.Generator(np.random.PCG64(1234567))
_MULTIPLY = _rng.integers(0, 2**31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_XOR = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_STEP = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(h: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each document's word shingles, and their numbers; a shorter text has its whole sequence."""
    ends = np.cumsum(counts)
    starts = ends - counts
    n = len(h)
    mixed = np.zeros(n, np.uint64)
    for k in range(width):
        mixed[: n - k] += V.mix(h[k:] ^ _STEP[k]) * _STEP[k] if n > k else np.uint64(0)
    mixed = V.mix(mixed)
    left = np.repeat(ends, counts) - np.arange(n)  # words from here to the document's end
    keep = left >= width
    short = np.flatnonzero((counts > 0) & (counts < width))
    for d in short.tolist():
        s, e = int(starts[d]), int(ends[d])
        total = np.uint64(len(h[s:e]))
        with np.errstate(over="ignore"):
            for k in range(s, e):
                total = V.mix(np.array([total * _STEP[40] + h[k]]))[0]
        mixed[s], keep[s] = total, True
    owner = np.repeat(np.arange(len(counts)), counts)
    return mixed[keep], np.bincount(owner[keep], minlength=len(counts))


def signatures(x: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One row per document with at least one shingle."""
    small = (x >> np.uint64(32)).astype(np.uint32)
    starts = (np.cumsum(counts) - counts)[counts > 0]
    out = np.empty((len(starts), len(_MULTIPLY)), np.uint32)
    work = np.empty_like(small)
    for j in range(len(_MULTIPLY)):
        np.bitwise_xor(small, _XOR[j], out=work)
        np.multiply(work, _MULTIPLY[j], out=work)
        np.bitwise_xor(work, work >> np.uint32(15), out=work)
        np.multiply(work, np.uint32(0x846CA68B), out=work)
        out[:, j] = np.minimum.reduceat(work, starts)
    return out


def words_digest(text: bytes) -> str:
    """SHA-256 of the words, lower case and one space apart; long texts are taken in parts."""
    out, first = hashlib.sha256(), True
    for part in V.parts(text):
        w = b" ".join(part.lower().split())
        if w:
            out.update(w if first else b" " + w)
            first = False
    return out.hexdigest()


def signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, key (digest of the words; null without any) and signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for i, counts, (h,) in V.words(texts):
                own = batch.column(0).slice(i, len(counts))
                x, n = shingles(h, counts, width)
                at = np.concatenate([[0], np.cumsum(n)]).tolist()
                sizes = [len(np.unique(x[s:e])) for s, e in zip(at[:-1], at[1:], strict=True)]
                made = iter(signatures(x, n) if n.any() else ())
                key = [words_digest(texts[i + d]) if c else None for d, c in enumerate(counts.tolist())]
                signature = [next(made).tobytes() if k else None for k in n.tolist()]
                yield pa.RecordBatch.from_arrays([own, pa.array(sizes, pa.int64()), pa.array(key, pa.string()), pa.array(signature, pa.binary())], ["doc_id", "n_shingles", "key", "signature"])
        trim()

    return docs.mapInArrow(run, "doc_id long, n_shingles long, key string, signature binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(len(column), -1)


def banded(signed_rows: DataFrame) -> DataFrame:
    """(id, signature) to (band bucket, id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch.column(1).to_pylist()).astype(np.uint64)
            for band in range(BANDS):
                h = np.full(len(x), band + 1, np.uint64)
                for r in range(ROWS):
                    h = V.mix(h * _STEP[30] + x[:, band * ROWS + r])
                h = h << np.uint64(5) | np.uint64(band)  # the lowest bits tell the band
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(0)], ["bucket", "id"])

    return signed_rows.select("id", "signature").mapInArrow(run, "bucket long, id long")


def fewest(percent: int, miss: float = MISS) -> list[tuple[int, int]]:
    """(hashes compared, matches needed to go on): below that, P(similarity >= percent | matches) < miss.

    With a uniform prior the posterior after m matches in n is Beta(m + 1, n - m + 1), and P(s >= t) is the binomial
    tail P(X <= m) of n + 1 trials with success t.
    """
    t, out = percent / 100, []
    for n in range(BATCH, BANDS * ROWS + 1, BATCH):
        tail, need = 0.0, 0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= miss:
                need = m
                break
        out.append((n, need))
    return out


def similar(x: np.ndarray, y: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Matches of the pairs of rows that survive the sequential comparison, at least 1; 0 for the others."""
    alive, matches, done = np.arange(len(x)), np.zeros(len(x), np.int64), 0
    for n, need in steps:
        matches[alive] += (x[alive, done:n] == y[alive, done:n]).sum(axis=1)
        alive = alive[matches[alive] >= need]
        done = n
    out = np.zeros(len(x), np.int64)
    out[alive] = np.maximum(matches[alive], 1)
    return out


def _survivors(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures don't rule the threshold out. A much-met id is one that Spark's join splits."""
    steps = fewest(percent)
    left = signs.select(F.col("id").alias("a"), F.col("signature").alias("x"))
    right = signs.select(F.col("id").alias("b"), F.col("signature").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                ok = similar(_matrix(batch.column(2).to_pylist()), _matrix(batch.column(3).to_pylist()), steps)
                yield batch.select([0, 1]).filter(pa.array(ok > 0))

    return both.mapInArrow(run, "a long, b long")


def shingle_set(text: bytes, width: int) -> set:
    """The distinct word shingles themselves; bytes split at exactly the ASCII white space and lower-case A to Z only."""
    w = text.lower().split()
    if not w:
        return set()
    return {tuple(w)} if len(w) < width else set(zip(*(w[k:] for k in range(width)), strict=False))


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough. ``texts``: (id, text), a row for each text of an id."""
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], set] = {}
        size = 0
        for batch in batches:
            ok = []
            for row in zip(*(batch.column(k) for k in range(4)), strict=True):  # texts leave Arrow one pair at a time
                got = []
                for i, t in ((row[0].as_py(), row[2]), (row[1].as_py(), row[3])):
                    text = t.as_py().encode()
                    name = (i, hash(text))
                    if name not in held:
                        if size > HELD:
                            held.clear()
                            size = 0
                        held[name] = shingle_set(text, width)
                        size += len(held[name])
                    got.append(held[name])
                same = len(got[0] & got[1])
                ok.append(100 * same >= percent * (len(got[0]) + len(got[1]) - same))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))
        held.clear()
        trim()

    return both.mapInArrow(run, "a long, b long")


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(id, component) of all ids in ``links`` (a, b); the component is its smallest id.

    Alternating large-star and small-star contraction: every round is a few shuffles of the links, which shrink to
    one link per id; a round's result is checkpointed, and two counts alone reach the driver. ``rows``: about how many
    links there are, if known.
    """
    links = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), rows)
    while True:
        # Done when every id has one link, and none is linked to an id that has a link itself.
        many = links.agg(F.count("*").alias("n"), F.countDistinct("u").alias("k")).first()
        if many["n"] == many["k"] and links.select(F.col("v").alias("u")).join(links.select("u"), "u", "left_semi").isEmpty():
            return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        links = large.join(down, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("l")).select("l.u", "l.v")
        links = cut(links.where("u <> v").distinct(), 2 * many["n"])
        del both, least, large, down
        release(links.sparkSession)


def _mixed(named: DataFrame, rows: int) -> DataFrame:
    """Buckets with several components (more than one pair with the center), their largest, and numbers of blocks.

    ``named``: (bucket, id, component, weight). A side of a block has about BLOCK of weight; long texts make more blocks.
    """
    shares = named.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    mixed = shares.groupBy("bucket").agg(F.count("*").alias("kinds"), F.sum("n").alias("n"), F.sum("w").alias("w"), F.max_by(F.struct("component", "w"), F.struct("n", "component")).alias("main"))
    # Two ids, or components: the pair with the smallest id has been tested, and with three members others remain.
    blocks = [F.greatest(F.lit(1), F.ceil(w / BLOCK)).cast("int").alias(name) for name, w in (("rights", F.col("w")), ("lefts", F.col("w") - F.col("main.w")))]
    return cut(mixed.where("kinds > 1 and n > 2").select("bucket", F.col("main.component").alias("main"), *blocks), rows)


def _blocks(named: DataFrame, mixed: DataFrame) -> DataFrame:
    """Rows (bucket, l, r, side, ...): members outside the largest component (side 0) meet all members (side 1) once."""
    rows = named.join(mixed, "bucket").withColumn("stray", F.col("component") != F.col("main"))
    right = rows.withColumn("r", F.pmod(F.xxhash64("id"), F.col("rights")).cast("int")).withColumn("l", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1))).withColumn("side", F.lit(1))
    left = rows.where("stray").withColumn("l", F.pmod(F.xxhash64("id", F.lit(1)), F.col("lefts")).cast("int")).withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rights") - 1))).withColumn("side", F.lit(0))
    return left.unionByName(right)


_NO_PAIRS = pd.DataFrame({"a": [], "b": []}).astype("int64")


def _sides(group: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Both sides of a block, without the bucket's center, whose pairs have been tested before."""
    group = group[group["id"] != group["center"]]
    return group[group["side"] == 0], group[group["side"] == 1]


def _alike(s: np.ndarray, signs: np.ndarray, band: int, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``signs`` that survive the comparison with ``s`` and share no earlier band with it, most matches first."""
    like = similar(np.broadcast_to(s, signs.shape), signs, steps)
    there = np.flatnonzero(like)
    shared = (signs[there] == s).reshape(-1, BANDS, ROWS).all(axis=2)
    there = there[shared.argmax(axis=1) == band]
    there = there[np.argsort(-like[there], kind="stable")]
    return there, like[there]


def hashed_sets(texts: DataFrame, width: int) -> DataFrame:
    """(id, text) to (id, set): the sorted distinct 64-bit hashes of a text's shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, counts, (h,) in V.words([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]):
                x, n = shingles(h, counts, width)
                at = np.concatenate([[0], np.cumsum(n)]).tolist()
                sets = [np.unique(x[s:e]).tobytes() for s, e in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(counts)), pa.array(sets, pa.binary())], ["id", "set"])
        trim()

    return texts.select("id", "text").mapInArrow(run, "id long, set binary")


def linked(x: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of ``sets`` are similar enough to ``x``; all are sorted and without repeats, none is empty."""
    sizes = np.array([len(y) for y in sets])
    every = np.concatenate(sets)
    hit = x[np.minimum(np.searchsorted(x, every), len(x) - 1)] == every
    same = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * same >= percent * (len(x) + sizes - same)


def _joining(members: DataFrame, signs: DataFrame, found: DataFrame, texts: DataFrame, width: int, percent: int, rows: int) -> DataFrame:
    """Links that join components: every surviving pair of different components in one bucket is verified in its block.

    Blocks carry the hashed sets, so that pairs never become rows: a block gives one link at most for each component
    that it joins to another, and members whose components are joined meanwhile need no further test.
    """
    steps = fewest(percent)
    sizes = signs.select("id", (F.col("size") + _SIGNATURE).alias("weight"))
    named = members.join(found, "id", "left").withColumn("component", F.coalesce("component", "id")).join(sizes, "id")
    mixed = _mixed(named, rows)
    if mixed.isEmpty():
        return members.sparkSession.createDataFrame([], "a long, b long")
    named = cut(named.join(mixed.select("bucket"), "bucket", "left_semi").drop("weight"), BANDS * rows)
    ids = named.select("id").distinct()
    sets = hashed_sets(texts.join(ids, "id", "left_semi"), width).join(signs.select("id", "signature"), "id")
    every = _blocks(named, mixed).join(sets, "id").select("bucket", "l", "r", "side", "stray", "id", "component", "signature", "set", "center")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        x, y = _sides(group)
        if not len(x) or not len(y):
            return _NO_PAIRS
        # Components of this block by number; joined ones get one number.
        names, kinds = np.unique(np.concatenate([x["component"], y["component"]]), return_inverse=True)
        label, mine, kinds = np.arange(len(names)), kinds[: len(x)], kinds[len(x) :]
        ids, stray, theirs = y["id"].to_numpy(), y["stray"].to_numpy(), _matrix(list(y["signature"]))
        sets = [np.frombuffer(v, np.uint64) for v in y["set"]]
        sizes = np.array([len(v) for v in sets])
        band = int(x["bucket"].iloc[0]) & 31
        out = []
        for i, kind, s, own in zip(x["id"], mine, _matrix(list(x["signature"])), x["set"], strict=True):
            own = np.frombuffer(own, np.uint64)
            if not len(own):
                continue
            # Two strays meet on both sides: their pair is taken where the larger id is on the left.
            fits = 100 * np.minimum(sizes, len(own)) >= percent * np.maximum(sizes, len(own))
            other = np.flatnonzero((label[kinds] != label[kind]) & fits & ~(stray & (ids > i)))
            there, _ = _alike(s, theirs[other], band, steps)
            left = other[there]
            while len(left):
                some, left = left[:32], left[32:]
                for j in some[linked(own, [sets[k] for k in some], percent)].tolist():
                    if label[kinds[j]] != label[kind]:
                        label[label == label[kinds[j]]] = label[kind]
                        out.append((max(i, int(ids[j])), min(i, int(ids[j]))))
                left = left[label[kinds[left]] != label[kind]]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return every.groupBy("bucket", "l", "r").applyInPandas(run, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    A-Z are lower-cased; words are runs without ASCII white space; a document's set are its distinct shingles of
    ``width`` words, or its whole sequence if it has fewer. Documents with 100 * intersection >= percent * union are
    linked; component_id is the smallest id reachable, kept is doc_id = component_id. Texts that are null, empty or
    have no words have empty sets and are linked with nothing. A null id is linked with nothing either; its row has
    null component_id and kept false. Rows that repeat an id are one document, which is linked with whatever any of
    its texts is. Very long texts count whole. An empty table gives no rows; other columns of the input play no part.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = cut(signed(rows, width))
    told = table.where("key is not null and doc_id is not null").select("doc_id", "key")
    n = told.count()
    same = cut(settle(told, "key", "doc_id", largest=False).select("doc_id", "key", F.col("best").alias("id")), n)
    first = same.where("doc_id = id").select("doc_id", "key").distinct()
    signs = cut(table.join(first, ["doc_id", "key"]).dropDuplicates(["doc_id", "key"]).select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("size"), "signature"), n)
    same = same.select("doc_id", "id").distinct()
    # Ids of several texts link what their texts are copies of.
    several = same.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("x")).where("b <> x").select("doc_id", "b")
    copies = same.join(several, "doc_id").select(F.col("id").alias("a"), "b").where("a <> b").distinct()
    bands = banded(signs).distinct()
    shared = bands.groupBy("bucket").agg(F.min("id").alias("center"), F.count("*").alias("n")).where("n > 1")
    members = cut(bands.join(shared.select("bucket", "center"), "bucket"), BANDS * n)
    star = cut(members.where("id <> center").select(F.col("id").alias("a"), F.col("center").alias("b")).distinct(), n)
    # Whole texts move once, by id; only those of documents in shared buckets can be needed for verification.
    near = members.select(F.col("id").alias("doc_id")).distinct()
    texts = rows.where("text is not null").join(near, "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("h"))
    texts = cut(texts.dropDuplicates(["id", "h"]).drop("h"), n, 2_000)
    release(spark)

    def confirmed(pairs: DataFrame) -> DataFrame:
        # Dealt anew, as links are few where verification has many tasks.
        return _verified(_survivors(pairs, signs, percent), texts, width, percent).repartition(files(n))

    links = cut(confirmed(star.groupBy("a").agg(F.min("b").alias("b"))).unionByName(copies), n)
    del bands, shared, near, several, copies
    found = components(links, n)
    release(spark)
    # The other centers, where they are of another component.
    named = star.join(found.select(F.col("id").alias("a"), F.col("component").alias("_ca")), "a", "left")
    named = named.join(found.select(F.col("id").alias("b"), F.col("component").alias("_cb")), "b", "left")
    apart = named.where(F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).select("a", "b").join(star.groupBy("a").agg(F.min("b").alias("b")), ["a", "b"], "left_anti")
    new = cut(confirmed(apart))
    if not new.isEmpty():
        links = links.unionByName(new)
        found = components(links, n)
    del star, named, apart, new
    release(spark)
    more = cut(_joining(members, signs, found, texts, width, percent, n).distinct(), n)
    if not more.isEmpty():
        found = components(links.unionByName(cut(_verified(more, texts, width, percent).repartition(files(n)))), n)
    release(spark)
    named = same.join(found, "id", "left").select("doc_id", F.coalesce("component", "id").alias("component"))
    # An id with several texts has one component, which all of them share.
    named = named.groupBy("doc_id").agg(F.min("component").alias("component"))
    out = table.select("doc_id", "n_shingles").join(named, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
