"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash of the last bytes decides where a text is cut, so equal passages give equal chunks wherever they stand.
A worker encodes each different chunk once and keeps its ids in a bounded store. A cut may fall inside a word; the ids
at such a join are repaired: the word across it is re-encoded, and the repair stands only if the ids it replaces agree
exactly with those of the word's two fragments; else the window grows by a word on both sides, at last to the text. A
window reaches from white space to white space, beyond which no token of this kind of vocabulary can change.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytesvec as V
from . import wordbpe
from .shared import bounded_batches, held, trim

WINDOW, AVERAGE_BITS, LEAST, MOST = 16, 10, 64, 16384
STORE_BYTES = 48 << 20

_GEAR = np.random.Generator(np.random.PCG64(97)).integers(0, 2**32, 256, dtype=np.uint32)


def cuts(b: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """For each document in ``b``, positions of its chunk borders, both ends included.

    A position is a border if the hash of the WINDOW bytes before it ends in AVERAGE_BITS zeros and it doesn't fall
    inside a character; borders lie LEAST to MOST bytes apart, where characters allow.
    """
    g = _GEAR[b]
    h = np.zeros(len(b) + 1, np.uint32)
    for k in range(WINDOW if len(b) >= WINDOW else 0):
        h[WINDOW:] += g[WINDOW - 1 - k : len(b) - k] << np.uint32(k)
    start = np.append(b & 0xC0 != 0x80, True)
    good = np.flatnonzero(((h >> np.uint32(32 - AVERAGE_BITS)) == 0) & start)
    out = []
    for s, e in zip(offsets[:-1].tolist(), (offsets[1:] - 1).tolist(), strict=True):
        own, last = [s], s
        near = good[np.searchsorted(good, s + WINDOW) : np.searchsorted(good, e)].tolist()
        for p in [*near, e]:
            while p - last > MOST:
                q = last + MOST
                while not start[q]:
                    q -= 1
                own.append(q)
                last = q
            if p < e and p - last >= LEAST:
                own.append(p)
                last = p
        if e > s:
            own.append(e)
        out.append(own)
    return out


class ChunkEncoder:
    def __init__(self, spec: bytes, store_bytes: int = STORE_BYTES):
        self.words = wordbpe.WordBpe(spec)
        self.names = [str(i) for i in range(len(self.words.tokens))]
        self.store: dict[bytes, np.ndarray] = {}
        self.bytes, self.most = 0, store_bytes

    def _ids(self, pieces: list[bytes]) -> list[np.ndarray]:
        flat, counts = self.words.encode(pieces)
        return np.split(flat, np.cumsum(counts)[:-1]) if len(pieces) else []

    def _chunks(self, chunks: list[bytes]) -> dict[bytes, np.ndarray]:
        """Ids of all the chunks; those not in the store are encoded, once each."""
        wanted = dict.fromkeys(chunks)
        new = [c for c in wanted if c not in self.store]
        got = dict(zip(new, self._ids(new), strict=True))
        out = {c: self.store[c] if c in self.store else got[c] for c in wanted}
        size = sum(len(c) + 4 * len(x) + 200 for c, x in got.items())
        if self.bytes + size > self.most:
            self.store, self.bytes = {}, 0
        if size <= self.most:
            self.store.update((c, x.copy()) for c, x in got.items())
            self.bytes += size
        return out

    def encode(self, docs: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for i, j in V.blocks(docs):
            out += self._block(docs[i:j])
        return out

    def _block(self, docs: list[bytes]) -> list[np.ndarray]:
        raw = b"\n".join(docs) + b"\n"
        b = np.frombuffer(raw, np.uint8)
        offsets = np.zeros(len(docs) + 1, np.int64)
        np.cumsum([len(d) + 1 for d in docs], out=offsets[1:])
        borders = cuts(b, offsets)
        known = self._chunks([raw[s:e] for own in borders for s, e in zip(own[:-1], own[1:], strict=True)])
        space = np.flatnonzero(V.SPACE[b])
        # Words that borders cut: where each begins and ends, bounded by its document.
        torn: list[tuple[int, int, int]] = []  # document, begin, end
        for k, own in enumerate(borders):
            for p in own[1:-1]:
                if torn and torn[-1][0] == k and p < torn[-1][2]:
                    continue  # in the same word as the border before
                at = int(np.searchsorted(space, p))
                begin = int(space[at - 1]) + 1 if at else 0
                end = int(space[at])  # a line feed ends the last document
                if begin < p < end:
                    torn.append((k, max(begin, own[0]), min(end, own[-1])))
        fragments: list[bytes] = []
        for k, s, e in torn:
            inner = [p for p in borders[k][1:-1] if s < p < e]
            fragments += [raw[s:e], raw[s : inner[0]], raw[inner[-1] : e]]
        mended = self._ids(fragments)
        fixes: dict[int, list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]] = {}
        for n, (k, s, e) in enumerate(torn):
            fixes.setdefault(k, []).append((s, e, *mended[3 * n : 3 * n + 3]))
        out = []
        for k, own in enumerate(borders):
            ids = [known[raw[s:e]] for s, e in zip(own[:-1], own[1:], strict=True)]
            if k in fixes:
                ids = self._mended(raw, space, own, ids, fixes[k])
            out.append(np.concatenate(ids) if len(ids) else np.zeros(0, np.int32))
        return out

    def _mended(self, raw: bytes, space: np.ndarray, own: list[int], ids: list[np.ndarray], fixes: list) -> list[np.ndarray]:
        """A document's id arrays with its windows re-encoded, each grown by a word on both sides until it agrees."""
        while True:
            put, wrong = self._put(own, ids, fixes)
            if not wrong:
                return put
            windows: list[list[int]] = []
            for n, (s, e, *_) in enumerate(fixes):
                if n in wrong:
                    s, e = self._wider(space, own, s, e)
                if windows and s < windows[-1][1]:
                    windows[-1][1] = max(e, windows[-1][1])
                else:
                    windows.append([s, e])
            fragments = []
            for s, e in windows:
                inner = [p for p in own[1:-1] if s < p < e]
                fragments += [raw[s:e], raw[s : inner[0]], raw[inner[-1] : e]]
            got = self._ids(fragments)
            fixes = [(s, e, *got[3 * n : 3 * n + 3]) for n, (s, e) in enumerate(windows)]

    @staticmethod
    def _wider(space: np.ndarray, own: list[int], s: int, e: int) -> tuple[int, int]:
        """A window with the words before and after it, inside its document; at last the document itself."""
        before = space[: np.searchsorted(space, s)]
        gaps = np.flatnonzero(np.diff(before[::-1]) != -1) if len(before) else ()  # the end of the white space before
        left = int(before[::-1][gaps[0] + 1]) + 1 if len(gaps) else own[0]
        after = space[np.searchsorted(space, e) :]
        gaps = np.flatnonzero(np.diff(after) != 1)
        right = int(after[gaps[0] + 1]) if len(gaps) else own[-1]
        return max(left, own[0]), min(right, own[-1])

    @staticmethod
    def _put(own: list[int], ids: list[np.ndarray], fixes: list) -> tuple[list[np.ndarray], set[int]]:
        """The id arrays with the windows' ids in place, and the numbers of the windows whose fragments' ids aren't
        those that the chunks have there. A window that is the whole document agrees whatever it holds."""
        left, right = [0] * len(ids), [len(x) for x in ids]
        put: dict[int, np.ndarray] = {}
        wrong = set()
        for n, (s, e, word, head, tail) in enumerate(fixes):
            first = max(i for i in range(len(ids)) if own[i] <= s)
            last = next(i for i in range(len(ids)) if own[i + 1] >= e)
            a, z = ids[first], ids[last]
            if s == own[0] and e == own[-1]:
                head, tail = a, z
            elif not np.array_equal(a[len(a) - len(head) :], head) or not np.array_equal(z[: len(tail)], tail):
                wrong.add(n)
                continue
            right[first] = len(a) - len(head)
            left[last] = len(tail)
            for i in range(first + 1, last):
                left[i], right[i] = 0, 0
            put[first] = word
        out = []
        for i, x in enumerate(ids):
            out.append(x[left[i] : max(left[i], right[i])])
            if i in put:
                out.append(put[i])
        return out, wrong


def _encoder(spec: bytes) -> ChunkEncoder:
    return held(("chunks", hash(spec)), lambda: ChunkEncoder(spec))


def encode(docs: DataFrame, spec: bytes, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """One row per input row: doc_id, ids, decoded; with ``digests``: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A null text counts as empty: no ids, an empty decoded text. Ids are the library's for the whole text, without
    added special tokens, truncation or padding; strings of special tokens inside a text are encoded as the library
    does by default. Very long texts are encoded in parts cut at white space. Repeated rows and null ids are treated
    like others; an empty table gives no rows; other columns of the input, whatever their names, play no part.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for i in range(0, len(texts), 512):
                ids = encoder.encode(texts[i : i + 512])
                own = batch.column(0).slice(i, 512)
                if not digests:
                    yield pa.RecordBatch.from_arrays([own, pa.array(ids, pa.list_(pa.int32())), pa.array([encoder.words.decode(x) for x in ids], pa.string())], ["doc_id", "ids", "decoded"])
                    continue
                sha, back = [], []
                for x in ids:
                    told = x.tolist()
                    sha.append(hashlib.sha256(" ".join(map(encoder.names.__getitem__, told)).encode()).hexdigest())
                    back.append(hashlib.sha256(" ".join(map(encoder.words.tokens.__getitem__, told)).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([own, pa.array([len(x) for x in ids], pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        trim()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "doc_id long, ids array<int>, decoded string")
