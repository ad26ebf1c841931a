"""NumPy work on UTF-8 bytes: word spans, span hashes and a hash table, all without a Python step per word.

A span's hash is a polynomial over random 64-bit byte values, taken from prefix sums modulo 2**64: with
H[i] = sum of T[b[j]] * P**j for j < i, the span [s, e) hashes to (H[e] - H[s]) * P**-s. Two independent tables
give 128 bits, so equal hashes mean equal bytes for any realistic number of different words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes handled at once: bounds the temporary arrays (about ten times eight bytes for each).
BLOCK = 1 << 18
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240607))
_TABLES = [_rng.integers(1, 2**64, 256, dtype=np.uint64) for _ in range(2)]
_P = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """P**i and P**-i modulo 2**64 for i < n at least; kept up to a few blocks' length."""
    if len(_powers[0]) >= n:
        return _powers
    made = []
    for base in (_P, pow(_P, -1, 2**64)):
        a = np.full(n, base, np.uint64)
        a[0] = 1
        made.append(np.multiply.accumulate(a))
    if n <= 4 * BLOCK:
        _powers[:] = made
    return made


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, lanes: int = 2) -> list[np.ndarray]:
    pw, inverse = powers(len(b) + 1)
    out = []
    sums = np.zeros(len(b) + 1, np.uint64)
    back = inverse[starts]
    for values in _TABLES[:lanes]:
        np.cumsum(values[b] * pw[: len(b)], out=sums[1:])
        out.append(mix((sums[ends] - sums[starts]) * back))
    return out


def long_hash(pieces: Iterable[np.ndarray], lanes: int = 2) -> list[np.ndarray]:
    """The hash that ``span_hashes`` gives one span, of any length, from its bytes in bounded pieces."""
    totals, done = [0] * lanes, 0
    for b in pieces:
        pw, shift = powers(len(b) + 1)[0], pow(_P, done, 2**64)
        totals = [(t + shift * int((values[b] * pw[: len(b)]).sum())) % 2**64 for t, values in zip(totals, _TABLES, strict=False)]
        done += len(b)
    return [mix(np.array([t], np.uint64)) for t in totals]


def blocks(docs: list[bytes], limit: int | None = None, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``rows`` documents with at most ``limit`` (BLOCK) bytes, or with one document."""
    start, size = 0, 0
    limit = BLOCK if limit is None else limit
    for i, d in enumerate(docs):
        if i > start and (size + len(d) > limit or i - start == rows):
            yield start, i
            start, size = i, 0
        size += len(d) + 1
    if start < len(docs):
        yield start, len(docs)


def parts(doc: bytes, limit: int | None = None) -> list[bytes]:
    """A long text cut at ASCII white space into parts of about ``limit`` (BLOCK) bytes; a word is never cut."""
    limit = BLOCK if limit is None else limit
    if len(doc) <= 2 * limit:
        return [doc]
    out, start = [], 0
    space = np.flatnonzero(SPACE[np.frombuffer(doc, np.uint8)])
    while len(doc) - start > 2 * limit:
        k = np.searchsorted(space, start + limit)
        if k == len(space):
            break
        out.append(doc[start : space[k]])
        start = int(space[k])
    out.append(doc[start:])
    return out


def lone_words(doc: bytes) -> Iterator[tuple[bytes, bool]]:
    """A long text in bounded parts as ``parts`` cuts it; a word too long for one comes alone and is marked True."""
    for p in parts(doc):
        if len(p) <= 2 * BLOCK:
            yield p, False
            continue
        # Such a part has white space in its first ``BLOCK`` bytes alone.
        space = np.flatnonzero(SPACE[np.frombuffer(p, np.uint8)])
        word = int(space[-1]) + 1 if len(space) else 0
        if word:
            yield p[:word], False
        yield p[word:], True


def joined(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The documents' bytes with a line feed after each, and where each begins (one more: the end)."""
    offsets = np.zeros(len(docs) + 1, np.int64)
    np.cumsum([len(d) + 1 for d in docs], out=offsets[1:])
    return np.frombuffer(b"\n".join(docs) + b"\n\n\n", np.uint8), offsets


def word_spans(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without ASCII white space; ``b`` ends with white space."""
    inside = ~SPACE[b]
    edge = np.flatnonzero(np.diff(inside, prepend=False))
    return edge[::2], edge[1::2]


def words(docs: list[bytes], lanes: int = 1, fold: bool = True) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """For each run of documents: the first one's index, word counts by document, and the words' hashes.

    ``fold`` lower-cases A to Z. A document that is very long is hashed in parts, and a very long word in pieces.
    """

    def hashed(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        return span_hashes(LOWER[b] if fold else b, starts, ends, lanes)

    def long(p: bytes, lone: bool) -> list[np.ndarray]:
        if not lone:
            b, _ = joined([p])
            return hashed(b, *word_spans(b))
        b = np.frombuffer(p, np.uint8)
        return long_hash((LOWER[x] if fold else x for x in (b[k : k + BLOCK] for k in range(0, len(b), BLOCK))), lanes)

    for i, j in blocks(docs):
        if j - i == 1 and len(docs[i]) > 2 * BLOCK:
            got = [long(p, lone) for p, lone in lone_words(docs[i])]
            hashes = [np.concatenate([g[k] for g in got]) for k in range(lanes)]
            yield i, np.array([len(hashes[0])]), hashes
            continue
        b, offsets = joined(docs[i:j])
        starts, ends = word_spans(b)
        yield i, np.diff(np.searchsorted(starts, offsets)), hashed(b, starts, ends)


class Memo:
    """An open-addressing table from 128-bit hashes to row numbers 0, 1, 2, ...; bounded, emptied when full."""

    def __init__(self, bits: int = 21):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        n = 1 << self.bits
        self.keys, self.checks, self.rows = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.full(n, -1, np.int32)
        self.used, self.mask = 0, np.uint64(n - 1)

    def room(self, n: int) -> bool:
        return self.used + n <= len(self.rows) * 0.6

    def find(self, h: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Row numbers; -1 where the hash is new."""
        slot = (h & self.mask).astype(np.int64)
        out = self.rows[slot]
        wrong = (out >= 0) & ((self.keys[slot] != h) | (self.checks[slot] != check))
        left = np.flatnonzero(wrong)
        at = slot[left]
        while len(left):
            at = (at + 1) & int(self.mask)
            row = self.rows[at]
            out[left] = row
            again = (row >= 0) & ((self.keys[at] != h[left]) | (self.checks[at] != check[left]))
            left, at = left[again], at[again]
        return out

    def add(self, h: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Row numbers of new, pairwise different hashes, in their order."""
        rows = np.arange(self.used, self.used + len(h), dtype=np.int32)
        left, at = np.arange(len(h)), (h & self.mask).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.rows[at] < 0)
            _, first = np.unique(at[free], return_index=True)
            take = free[first]
            self.keys[at[take]], self.checks[at[take]], self.rows[at[take]] = h[left[take]], check[left[take]], rows[left[take]]
            keep = np.ones(len(left), bool)
            keep[take] = False
            left, at = left[keep], (at[keep] + 1) & int(self.mask)
        self.used += len(h)
        return rows


def ragged(offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices offsets[0], offsets[0] + 1, ... (counts[0] of them), then those of the next, in one array."""
    total = int(counts.sum())
    shift = np.repeat(offsets - (np.cumsum(counts) - counts), counts)
    return np.arange(total) + shift
