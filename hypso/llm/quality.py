"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Every text becomes a TF-IDF vector over hashed features: its words, the shapes of its words (runs of upper case, lower
case and digits collapsed, other signs kept), neighbouring shapes and immediate repetitions. Document frequencies are
counted over all documents. A truncated SVD of a bounded, labelled sample gives the latent space. The sample's latent
vectors, unit length, are broadcast; each document's cosines with all of them are computed as exact matrix products in
blocks, and its nearest neighbours vote with their labels, weighted by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytesvec as V
from .shared import bounded_batches, cut, held_out, text_column, trim

#: Bounds: labelled documents that are learned from, features, dimensions of the latent space, voting neighbours.
SAMPLE, WORDS, SHAPES, PAIRS, DIMENSIONS, NEIGHBOURS = 3000, 2048, 1024, 1024, 48, 15
FEATURES = WORDS + SHAPES + PAIRS
#: Documents whose dense counts are held at once.
ROWS = 256

_KIND = np.arange(256, dtype=np.uint8)
_KIND[65:91] = 65
_KIND[97:123] = 97
_KIND[48:58] = 48
_KIND[128:] = 97


def _kinds(b: np.ndarray) -> np.ndarray:
    """Each byte's kind of sign; ``b`` ends with white space."""
    kind = _KIND[b]
    lead = np.flatnonzero(b == 0xC3)
    capital = lead[(b[lead + 1] >= 0x80) & (b[lead + 1] <= 0x9E)]
    kind[capital] = kind[capital + 1] = 65
    return kind


def _shapes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word's shape."""
    kind = _kinds(b)
    keep = np.append(True, kind[1:] != kind[:-1])
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return V.span_hashes(kind[keep], at[starts], at[ends], 1)[0]


def _long_shape(word: bytes) -> np.ndarray:
    """The shape's hash of a very long word, in pieces cut between characters."""

    def kinds() -> Iterator[np.ndarray]:
        start, last = 0, -1
        while start < len(word):
            end = min(start + V.BLOCK, len(word))
            while end < len(word) and end > start + V.BLOCK - 3 and word[end] & 0xC0 == 0x80:
                end -= 1
            kind = _kinds(np.frombuffer(word[start:end] + b"\n", np.uint8))[:-1]
            yield kind[np.append(kind[0] != last, kind[1:] != kind[:-1])]
            start, last = end, int(kind[-1])

    return V.long_hash(kinds(), 1)[0]


def _long(doc: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a very long text, and of their shapes."""
    found = []
    for p, lone in V.lone_words(doc):
        if lone:
            b = np.frombuffer(p, np.uint8)
            found.append((V.long_hash((V.LOWER[b[k : k + V.BLOCK]] for k in range(0, len(b), V.BLOCK)), 1)[0], _long_shape(p)))
        else:
            b, _ = V.joined([p])
            starts, ends = V.word_spans(b)
            found.append((V.span_hashes(V.LOWER[b], starts, ends, 1)[0], _shapes(b, starts, ends)))
    return np.concatenate([w for w, _ in found]), np.concatenate([s for _, s in found])


def features(docs: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """For each run of documents: the first one's index and their feature counts, one row each."""
    for i, j in V.blocks(docs, rows=ROWS):
        if j - i == 1 and len(docs[i]) > 2 * V.BLOCK:
            word, shape = _long(docs[i])
            owner = np.zeros(len(word), np.int64)
        else:
            b, offsets = V.joined(docs[i:j])
            starts, ends = V.word_spans(b)
            n = np.diff(np.searchsorted(starts, offsets))
            owner = np.repeat(np.arange(j - i), n)
            word, shape = V.span_hashes(V.LOWER[b], starts, ends, 1)[0], _shapes(b, starts, ends)
        first = np.append(True, owner[1:] != owner[:-1])[: len(owner)]
        again = np.append(False, word[1:] == word[:-1])[: len(word)] & ~first
        before = np.where(first, np.uint64(0), np.roll(shape, 1)) if len(shape) else shape
        pair = V.mix(shape * np.uint64(3) + before + again * np.uint64(0x1F123BB5159A55E5))
        counts = np.zeros((j - i) * FEATURES, np.int64)
        for f in (word % np.uint64(WORDS), WORDS + shape % np.uint64(SHAPES), WORDS + SHAPES + pair % np.uint64(PAIRS)):
            counts += np.bincount(owner * FEATURES + f.astype(np.int64), minlength=len(counts))
        yield i, counts.reshape(j - i, FEATURES)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (np.log1p(counts) * idf).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def frequencies(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, int]:
    """How many documents have each feature, and how many have any: all documents are counted, in one pass whose tasks
    give one row a feature; as many rows as there are features reach the driver."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(FEATURES + 1, np.int64), 0
        for batch in batches:
            for _, counts in features([t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()]):
                there = counts > 0
                total[:FEATURES] += there.sum(axis=0)
                total[FEATURES] += there.any(axis=1).sum()
                rows += 1
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(FEATURES + 1, dtype=np.int32)), pa.array(total)], ["f", "n"])
        trim()

    told = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "f int, n long")
    out = np.zeros(FEATURES + 1, np.int64)
    for r in told.groupBy("f").agg(F.sum("n").alias("n")).collect():
        out[r["f"]] = r["n"]
    return out[:FEATURES], int(out[FEATURES])


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> dict:
    """The model from at most ``sample`` labelled documents, chosen by a hash of their ids; those held out take no part.

    Labels of ids that ``docs`` lacks take no room. The ids chosen, bounded, are broadcast to the documents; executors
    count features, and only the sample's sparse counts reach the driver. Labels that are null are passed over. Of an
    id with several labels the smallest counts, of one with several texts the smallest.
    """
    bounded_batches(docs.sparkSession)
    told = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    told = told.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.min("label").alias("label"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    few = cut(told.join(rows.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    rows = rows.join(F.broadcast(few), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))  # at most ``sample`` rows are broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).cast(pa.binary()).to_pylist()]
            for i, counts in features(texts):
                at = [np.flatnonzero(c) for c in counts]
                own = batch.slice(i, len(counts))
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array([a.astype(np.int32) for a in at], pa.list_(pa.int32())), pa.array([c[a].astype(np.int32) for c, a in zip(counts, at, strict=True)], pa.list_(pa.int32()))], ["doc_id", "label", "f", "n"])
        trim()

    got = rows.mapInArrow(run, "doc_id long, label int, f array<int>, n array<int>").toArrow().sort_by("doc_id")
    y = np.clip(got.column("label").to_numpy().astype(np.float64), 0, 1)
    prior = float(y.mean()) if len(y) else 0.5
    there = np.array([len(f) > 0 for f in got.column("f")], bool)
    if not there.any():
        return {"idf": np.ones(FEATURES), "project": np.zeros((FEATURES, 1), np.float32), "vectors": np.zeros((0, 1)), "labels": y[there], "prior": prior}
    seen, every = frequencies(docs, text_col)
    idf = np.log((1 + every) / (1 + seen)) + 1.0
    x = np.zeros((int(there.sum()), FEATURES), np.float32)  # the one large array that the driver holds
    for row, k in enumerate(np.flatnonzero(there).tolist()):
        f = got.column("f")[k].values.to_numpy()
        x[row, f] = _weighted(got.column("n")[k].values.to_numpy()[None, :], idf[f])[0]
    del got
    # Truncated SVD by a randomised range finder with power steps.
    size = min(DIMENSIONS, *x.shape)
    q = np.random.Generator(np.random.PCG64(5)).standard_normal((x.shape[1], min(size + 10, *x.shape))).astype(np.float32)
    for _ in range(4):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    project = (q @ vt.T)[:, :size].astype(np.float32)
    vectors = np.concatenate([_latent(x[i : i + ROWS], project) for i in range(0, len(x), ROWS)])
    return {"idf": idf, "project": project, "vectors": vectors, "labels": y[there], "prior": prior}


def _latent(x: np.ndarray, project: np.ndarray) -> np.ndarray:
    return _unit(x.astype(np.float64) @ project.astype(np.float64))


def latent(counts: np.ndarray, model: dict) -> np.ndarray:
    """Unit vectors of the latent space, in double precision."""
    return _latent(_weighted(counts, model["idf"]), model["project"])


def chosen(near: np.ndarray, k: int) -> np.ndarray:
    """Which ``k`` neighbours (columns) vote, of each row's cosines: the largest, equal ones by the smaller id."""
    if k >= near.shape[1]:
        return np.ones(near.shape, bool)
    least = np.partition(near, -k, axis=1)[:, -k][:, None]
    above, equal = near > least, near == least
    room = k - above.sum(axis=1, keepdims=True)
    return above | (equal & (np.cumsum(equal, axis=1) <= room))


def vote(model: dict, docs: list[bytes], neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Each text's share of weight that votes for label 1. Cosines count to nine digits, so that the blocks in which
    the products are taken don't tell; of equal ones the neighbour with the smaller id comes first."""
    out = np.full(len(docs), model["prior"])
    known, labels = model["vectors"], model["labels"]
    if not len(known):
        return out
    for i, counts in features(docs):
        there = np.flatnonzero(counts.any(axis=1))
        if not len(there):
            continue
        near = np.round(latent(counts[there], model) @ known.T, 9)
        row, at = np.nonzero(chosen(near, min(neighbours, len(known))))
        weight = np.maximum(near[row, at], 1e-6) ** 4
        out[i + there] = np.bincount(row, weight * labels[at], len(there)) / np.bincount(row, weight, len(there))
    return out


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, score.

    Texts that are null or have no words get the sample's share of label 1 (0.5 without a sample). Whole texts count;
    repeated rows and null ids are scored like others. Neighbours tie by id, see ``vote``. An empty table gives no
    rows; other columns of the input, whatever their names, play no part.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), voted(model, F.col(text_col), docs).alias("score"))


def voted(model: dict, text: Column, docs: DataFrame) -> Column:
    """A text's score, as ``score`` has it."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE and FEATURES

    def judged(column: pa.Array) -> pa.Array:
        texts = [t or b"" for t in column.cast(pa.binary()).to_pylist()]
        return pa.array(np.clip(vote(shared.value, texts), 0.0, 1.0), pa.float64())

    return text_column(text, "double", judged, docs.sparkSession)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of all documents, learned from those that aren't held out."""
    told = score(docs, learn(docs, labels))
    return told.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
