"""The word-level BPE tokenizer's ids for whole texts, at a fraction of the library's cost per text.

The vocabulary's pre-tokenizer never lets a token cross white space or the border of a run of letters, a digit or a
run of other signs, so a text's ids are the ids of its pre-tokens in order. Pre-tokens are found and hashed with
NumPy; the tokenizers library encodes each different pre-token once in a worker, and a bounded table keeps its ids.
That holds for texts of ASCII and Latin-1 letters. A text with any other character, a control character or a string
that may be a special token goes to the library whole, so the ids are always the library's.
"""

from __future__ import annotations

import json

import numpy as np
from tokenizers import Tokenizer

from . import bytesvec as V
from .shared import held

# Classes of bytes: 0 white space, 1 letter, 2 digit, 3 other sign, 9 for the library.
_CLASS = np.full(256, 9, np.uint8)
_CLASS[0x21:0x7F] = 3
_CLASS[0x30:0x3A] = 2
_CLASS[0x41:0x5B] = 1
_CLASS[0x61:0x7B] = 1
_CLASS[V.SPACE] = 0
_LEAD = 0xC3  # U+00C0 to U+00FF; of them U+00D7 and U+00F7 are no letters

# Fixed values of the byte-level alphabet: bytes that stand for themselves; the others follow from U+0100 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_ALPHABET = {b: b for b in _PRINTED} | {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in set(_PRINTED))}


class WordBpe:
    def __init__(self, spec: bytes, memo_bits: int = 20):
        self.whole = Tokenizer.from_str(spec.decode())
        self.whole.no_truncation()
        self.whole.no_padding()
        bare = json.loads(spec)
        bare |= {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "added_tokens": [], "truncation": None, "padding": None}
        self.bare = Tokenizer.from_str(json.dumps(bare))
        size = max(self.whole.get_vocab().values()) + 1
        self.ends = np.zeros(size, bool)
        self.ends[[i for t, i in bare["model"]["vocab"].items() if t.endswith(bare["model"]["end_of_word_suffix"])]] = True
        self.tokens = [self.whole.id_to_token(i) or "" for i in range(size)]
        self.memo = V.Memo(memo_bits)
        self._clear()

    def _clear(self) -> None:
        self.memo.clear()
        self.pool, self.filled = np.zeros(1 << 16, np.int32), 0
        self.at, self.n = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    def _learn(self, b: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray, check: np.ndarray) -> None:
        """Encodes new pre-tokens, given once each."""
        raw = b.tobytes()
        said = [raw[s:e].decode("latin-1").translate(_ALPHABET) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
        lines = [" ".join(said[i : i + 256]) for i in range(0, len(said), 256)]
        ids = np.concatenate([np.array(e.ids, np.int32) for e in self.bare.encode_batch_fast(lines, add_special_tokens=False)])
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(said):
            raise RuntimeError("the vocabulary's word ends don't mark pre-tokens")
        counts = np.diff(last, prepend=-1)
        rows = self.memo.add(h, check)
        while self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while self.memo.used > len(self.at):
            self.at, self.n = (np.concatenate([x, np.zeros_like(x)]) for x in (self.at, self.n))
        self.pool[self.filled : self.filled + len(ids)] = ids
        self.at[rows] = self.filled + last + 1 - counts
        self.n[rows] = counts
        self.filled += len(ids)

    def _block(self, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        b, offsets = V.joined(docs)
        kind = _CLASS[b]
        lead = np.flatnonzero(b == _LEAD)
        low = V.LOWER[b]
        if len(lead):
            after = b[lead + 1]
            letter = (after & 0xC0 == 0x80) & (after != 0x97) & (after != 0xB7)
            kind[lead[letter]] = 1
            kind[lead[letter] + 1] = 1
            upper = lead[letter & (after <= 0x9E)] + 1
            low[upper] += 0x20
        odd = np.flatnonzero(kind == 9)
        marks = np.flatnonzero((b == 0x3C) & (np.append(b[1:], 0) == 0x7C))  # "<|" may begin a special token
        slow = np.unique(np.searchsorted(offsets, np.concatenate([odd, marks]), "right") - 1)
        inside = kind != 0
        before = np.concatenate([[0], kind[:-1]])
        start = inside & ((kind != before) | (kind == 2))
        quote = np.flatnonzero(b == 0x27)
        quote = quote[before[quote] != 3]
        if len(quote):
            one, two = low[quote + 1], low[quote + 2]
            # Fixed values: 's 't 'm 'd, and 're 've 'll, are pre-tokens of their own.
            short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            pair = ((two == 0x65) & ((one == 0x72) | (one == 0x76))) | ((one == 0x6C) & (two == 0x6C))
            size = np.where(short, 1, np.where(pair, 2, 0))
            quote, size = quote[size > 0], size[size > 0]
            start[quote + 1] = False
            rest = quote + 1 + size
            start[rest[kind[rest] == 1]] = True
        following = np.append(inside[1:], False) & ~np.append(start[1:], False)
        begins, ends = np.flatnonzero(start), np.flatnonzero(inside & ~following) + 1
        h, check = V.span_hashes(low, begins, ends)
        rows = self.memo.find(h, check)
        new = np.flatnonzero(rows < 0)
        if len(new):
            _, first = np.unique(h[new], return_index=True)
            if not self.memo.room(len(first)):
                self._clear()
                new = np.arange(len(h))
                _, first = np.unique(h, return_index=True)
                if not self.memo.room(len(first)):
                    raise RuntimeError("the table is too small for one block")
            once = new[first]
            self._learn(low, begins[once], ends[once], h[once], check[once])
            rows[new] = self.memo.find(h[new], check[new])
        counts = self.n[rows].astype(np.int64)
        ids = self.pool[V.ragged(self.at[rows], counts)]
        border = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(begins, offsets)]
        if not len(slow):
            return ids, np.diff(border)
        pieces = [ids[border[k] : border[k + 1]] for k in range(len(docs))]
        for k in slow.tolist():
            pieces[k] = np.array(self.whole.encode(docs[k].decode(), add_special_tokens=False).ids, np.int32)
        return np.concatenate(pieces), np.array([len(x) for x in pieces])

    def encode(self, docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All documents' ids in one array, and how many each has."""
        ids, counts = [], []
        for i, j in V.blocks(docs):
            cutup = V.parts(docs[i]) if j - i == 1 else docs[i:j]
            if j - i == 1 and len(cutup) > 1:
                got = [self._block([p])[0] for p in cutup]
                ids += got
                counts.append(np.array([sum(map(len, got))]))
            else:
                x, n = self._block(cutup)
                ids.append(x)
                counts.append(n)
        if not ids:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        return np.concatenate(ids), np.concatenate(counts)

    def decode(self, ids: np.ndarray) -> str:
        """What the library's decode(ids, skip_special_tokens=False) gives: without a decoder, tokens joined by spaces."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


def of(spec: bytes) -> WordBpe:
    """One encoder in each worker process for a vocabulary; later tasks find its table filled."""
    return held(("wordbpe", hash(spec)), lambda: WordBpe(spec))
