"""Token counts through a digest cache.

A content's key is the SHA-256 of its text (the tokenizer's own normalisation is the identity, so equal texts and only
those share a key) together with the digest of the tokenizer's model. Stored counts are joined by key; of the keys
that are missing, one text each is encoded, and the new counts are appended to the cache.

Encoding exploits that the model has no piece with a non-space before its space mark: a text's pieces are those of its
segments, each a run of spaces and the word after it. The library counts each different segment once in a worker.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytesvec as V
from .shared import bounded_batches, cut, held, trim

_MARK = "▁"
CACHE = "key string, tokenizer string, n_tokens long"


class PieceCounter:
    def __init__(self, model: bytes, memo_bits: int = 20):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = (self.library.id_to_piece(i) for i in range(self.library.get_piece_size()))
        # Segments are independent only if no piece crosses from a word to the space after it, and if the model adds
        # its own space before a text and changes nothing else.
        crossing = any(_MARK in p.lstrip(_MARK) for p in pieces)
        plain = [self.library.encode(x, out_type=str) for x in ("a  b", " a", "A\né\t", "a ")]
        kept = ["".join(p).replace(_MARK, " ") for p in plain[:2]] == [" a  b", "  a"] and "".join(plain[3]) == _MARK + "a" + _MARK
        self.split = not crossing and kept
        self.memo = V.Memo(memo_bits)
        self.n = np.zeros(1 << 14, np.int32)

    def _segments(self, docs: list[bytes]) -> np.ndarray:
        offsets = np.zeros(len(docs) + 1, np.int64)
        np.cumsum([len(d) + 1 for d in docs], out=offsets[1:])
        raw = b" " + b" ".join(docs) + b"\0"  # the space before a text is the model's own
        b = np.frombuffer(raw, np.uint8)[: offsets[-1]]
        space = b == 0x20
        start = space & ~np.concatenate([[False], space[:-1]])
        start[offsets[:-1]] = True
        begins = np.flatnonzero(start)
        ends = np.append(begins[1:], len(b))
        h, check = V.span_hashes(b, begins, ends)
        # Slices that the table can hold whatever they are; one is enough but for texts of very many different words.
        most = int(len(self.memo.rows) * 0.6)
        counts = [self._looked_up(raw, begins[k : k + most], ends[k : k + most], h[k : k + most], check[k : k + most]) for k in range(0, len(h), most)]
        sums = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        edge = np.searchsorted(begins, offsets)
        return sums[edge[1:]] - sums[edge[:-1]]

    def _looked_up(self, raw: bytes, begins: np.ndarray, ends: np.ndarray, h: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Tokens of each segment; no more segments than the emptied table has room for."""
        rows = self.memo.find(h, check)
        new = np.flatnonzero(rows < 0)
        if len(new):
            _, first = np.unique(h[new], return_index=True)
            if not self.memo.room(len(first)):
                self.memo.clear()
                new = np.arange(len(h))
                _, first = np.unique(h, return_index=True)
            once = new[first]
            told = [raw[s + 1 : e].decode() for s, e in zip(begins[once].tolist(), ends[once].tolist(), strict=True)]
            # Runs of spaces alone must not be taken for an empty text, which has no pieces.
            counts = [len(x) if t else 1 for t, x in zip(told, self.library.encode(told, num_threads=1), strict=True)]
            at = self.memo.add(h[once], check[once])
            while self.memo.used > len(self.n):
                self.n = np.concatenate([self.n, np.zeros_like(self.n)])
            self.n[at] = counts
            rows[new] = self.memo.find(h[new], check[new])
        return self.n[rows].astype(np.int64)

    def _sliced(self, doc: bytes) -> int:
        """Tokens of a very long text, from slices cut before runs of spaces: their counts add up exactly."""
        total, start = 0, 0
        while start < len(doc):
            end = len(doc)
            if end - start > 2 * V.BLOCK:
                k = doc.find(b" ", start + V.BLOCK)
                # A cut inside a run of spaces would tear a segment.
                while k > 0 and doc[k - 1] == 0x20:
                    while k < len(doc) and doc[k] == 0x20:
                        k += 1
                    k = doc.find(b" ", k)
                end = k if k > 0 else end
            # The space at the cut is the one that is put before a slice.
            total += int(self._segments([doc[start:end]])[0])
            if end < len(doc) and end + 1 == len(doc):
                total += int(self._segments([b""])[0])  # a single space at the text's end
            start = end + 1
        return total

    def counts(self, docs: list[bytes]) -> np.ndarray:
        """Tokens of each text, as the library gives them for the whole text."""
        out = np.zeros(len(docs), np.int64)
        mark = _MARK.encode()
        whole = [i for i, d in enumerate(docs) if not self.split or mark in d or b"\0" in d]
        if whole:
            out[whole] = [len(x) for x in self.library.encode([docs[i].decode() for i in whole], num_threads=1)]
        there = [i for i in sorted(set(range(len(docs))) - set(whole)) if docs[i]]
        for i, j in V.blocks([docs[i] for i in there]):
            own = there[i:j]
            if j - i == 1 and len(docs[own[0]]) > 2 * V.BLOCK:
                out[own] = self._sliced(docs[own[0]])
                continue
            out[own] = self._segments([docs[k] for k in own])
        return out


def _counter(model: bytes) -> PieceCounter:
    return held(("pieces", hash(model)), lambda: PieceCounter(model))


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    """What the cache holds; nothing where it doesn't exist yet."""
    try:
        return spark.read.schema(CACHE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CACHE)


def count_tokens(docs: DataFrame, model: bytes, cache: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit. New counts are appended to ``cache``, a path of a
    Parquet table that driver and executors share.

    Null texts count as empty: no bytes, no tokens. Very long texts are counted in slices that add up exactly. Repeated
    rows and null ids get their counts like others; an empty table gives no rows; other columns play no part. Texts
    move at most once, by id, and only if some are missing from the cache; else only ids and digests do. A digest that
    many rows share is combined map-side before it is shuffled, and its join is one that Spark splits by size. Cached
    counts of other models are ignored. A key that the cache holds several times, as after two writers or a repeated
    append, counts once; were its counts to differ, the smallest is taken.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    version = hashlib.sha256(model).hexdigest()
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Keys are bytes while they are shuffled, half as long as the cache's hexadecimal ones.
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.sha2(text, 256)).alias("key"))
    keys = cut(texts.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes")))
    misses = cut(keys.groupBy("key").agg(F.min("doc_id").alias("first")).join(stored(spark, cache, version), "key", "left_anti"))
    if not misses.isEmpty():
        _encode(texts, misses, model, version, cache)
    # Cut, so that the join's sides are plain shuffles: a digest that many rows share is split by adaptive execution.
    out = keys.join(cut(stored(spark, cache, version)), "key")
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """key (bytes), n_tokens of one model version, each key once."""
    own = read_cache(spark, cache).where(F.col("tokenizer") == version).select(F.unhex("key").alias("key"), "n_tokens")
    return own.groupBy("key").agg(F.min("n_tokens").alias("n_tokens"))


def _encode(texts: DataFrame, misses: DataFrame, model: bytes, version: str, cache: str) -> None:
    """Appends the counts of ``misses`` (key, first: an id whose text it is) to the cache."""
    misses = misses.select(F.col("key").alias("miss"), "first")
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in batches:
            own = batch.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counter.counts(own))], ["key", "n_tokens"])
        trim()

    once = texts.join(misses.hint("shuffle_hash"), texts["doc_id"].eqNullSafe(misses["first"]) & (texts["key"] == misses["miss"]), "left_semi")
    # Rows that repeat a first id with its text are counted twice; a key is stored once.
    counted = once.select("key", "text").mapInArrow(run, "key binary, n_tokens long").dropDuplicates(["key"])
    rows = counted.select(F.lower(F.hex("key")).alias("key"), F.lit(version).alias("tokenizer"), "n_tokens")
    rows.write.mode("append").parquet(cache)
