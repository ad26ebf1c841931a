"""Lossless WebP (VP8L) by its public specification, RFC 9649, with NumPy and plain Python.

It stands in where Pillow isn't installed. Decoding knows all transforms, meta prefix codes, back references and the
color cache, at some seconds a 512 x 512 tile. Encoding predicts each pixel from its left and upper neighbours,
subtracts green, and writes literals under one set of prefix codes.
"""

from __future__ import annotations

import heapq
import struct

import numpy as np

# Fixed values of the specification: the order of code length codes, and the near places of small distance codes.
_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
_NEAR = (
    (0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2), (2, 1), (-2, 1), (2, 2), (-2, 2), (0, 3), (3, 0), (1, 3), (-1, 3), (3, 1), (-3, 1), (2, 3), (-2, 3),
    (3, 2), (-3, 2), (0, 4), (4, 0), (1, 4), (-1, 4), (4, 1), (-4, 1), (3, 3), (-3, 3), (2, 4), (-2, 4), (4, 2), (-4, 2), (0, 5), (3, 4), (-3, 4), (4, 3), (-4, 3), (5, 0),
    (1, 5), (-1, 5), (5, 1), (-5, 1), (2, 5), (-2, 5), (5, 2), (-5, 2), (4, 4), (-4, 4), (3, 5), (-3, 5), (5, 3), (-5, 3), (0, 6), (6, 0), (1, 6), (-1, 6), (6, 1), (-6, 1),
    (2, 6), (-2, 6), (6, 2), (-6, 2), (4, 5), (-4, 5), (5, 4), (-5, 4), (3, 6), (-3, 6), (6, 3), (-6, 3), (0, 7), (7, 0), (1, 7), (-1, 7), (5, 5), (-5, 5), (7, 1), (-7, 1),
    (4, 6), (-4, 6), (6, 4), (-6, 4), (2, 7), (-2, 7), (7, 2), (-7, 2), (3, 7), (-3, 7), (7, 3), (-7, 3), (5, 6), (-5, 6), (6, 5), (-6, 5), (8, 0), (4, 7), (-4, 7), (7, 4),
    (-7, 4), (8, 1), (8, 2), (6, 6), (-6, 6), (8, 3), (5, 7), (-5, 7), (7, 5), (-7, 5), (8, 4), (6, 7), (-6, 7), (7, 6), (-7, 6), (8, 5), (7, 7), (-7, 7), (8, 6), (8, 7),
)
PREDICTOR, CROSS, GREEN, INDEXED = range(4)
GREENS, LENGTHS, DISTANCES = 256, 24, 40


class _Bits:
    """A stream of bits, the lowest of each byte first."""

    def __init__(self, data: bytes):
        self.whole, self.at = int.from_bytes(data, "little"), 0
        self.data, self.held, self.have, self.next = data, 0, 0, 0

    def fill(self) -> None:
        part = self.data[self.next : self.next + 8]
        self.held |= int.from_bytes(part, "little") << self.have
        self.have += 64  # bits beyond the end are zeros
        self.next += 8

    def read(self, n: int) -> int:
        if self.have < n:
            self.fill()
        out = self.held & ((1 << n) - 1)
        self.held >>= n
        self.have -= n
        return out


class _Code:
    """A prefix code: a table by the next ``wide`` bits, of (symbol, length)."""

    def __init__(self, lengths: list[int]):
        there = [(n, s) for s, n in enumerate(lengths) if n]
        if len(there) == 1:
            self.wide, self.table = 0, [(there[0][1], 0)]
            return
        if not there:
            raise ValueError("a prefix code has no symbol")
        self.wide = max(n for n, _ in there)
        self.table = [None] * (1 << self.wide)
        code, last = 0, 0
        for n, s in sorted(there):
            code <<= n - last
            last = n
            turned = int(format(code, f"0{n}b")[::-1], 2)
            for k in range(turned, 1 << self.wide, 1 << n):
                self.table[k] = (s, n)
            code += 1

    def read(self, bits: _Bits) -> int:
        if bits.have < self.wide:
            bits.fill()
        told = self.table[bits.held & ((1 << self.wide) - 1)]
        if told is None:
            raise ValueError("a prefix code is broken")
        bits.held >>= told[1]
        bits.have -= told[1]
        return told[0]


def _code(bits: _Bits, size: int) -> _Code:
    lengths = [0] * size
    if bits.read(1):
        many, wide = bits.read(1) + 1, bits.read(1)
        first = bits.read(8 if wide else 1)
        lengths[first] = 1
        if many == 2:
            lengths[bits.read(8)] = 1
        return _Code(lengths)
    own = [0] * 19
    for k in range(4 + bits.read(4)):
        own[_ORDER[k]] = bits.read(3)
    code, left = _Code(own), size
    if bits.read(1):
        left = 2 + bits.read(2 + 2 * bits.read(3))
    at, before = 0, 8
    while at < size and left:
        left -= 1
        s = code.read(bits)
        if s < 16:
            lengths[at] = s
            before = s or before
            at += 1
            continue
        value, times = (before, 3 + bits.read(2)) if s == 16 else (0, 3 + bits.read(3)) if s == 17 else (0, 11 + bits.read(7))
        if at + times > size:
            raise ValueError("code lengths run over")
        lengths[at : at + times] = [value] * times
        at += times
    return _Code(lengths)


def _stretch(bits: _Bits, symbol: int) -> int:
    """The length or distance that a prefix symbol begins."""
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + bits.read(extra) + 1


def _pixels(bits: _Bits, width: int, height: int, main: bool) -> list[int]:
    """An entropy-coded image as ARGB numbers."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    groups, meta, meta_bits, across = 1, None, 0, 0
    if main and bits.read(1):
        meta_bits = bits.read(3) + 2
        across = -(-width >> meta_bits)
        meta = [p >> 8 & 0xFFFF for p in _pixels(bits, across, -(-height >> meta_bits), False)]
        groups = max(meta) + 1
    sizes = (GREENS + LENGTHS + ((1 << cache_bits) if cache_bits else 0), 256, 256, 256, DISTANCES)
    codes = [[_code(bits, n) for n in sizes] for _ in range(groups)]
    out: list[int] = []
    total, cache, cached = width * height, [0] * (1 << cache_bits), 0
    green, red, blue, alpha, far = codes[0]
    while len(out) < total:
        at = len(out)
        if meta is not None:
            green, red, blue, alpha, far = codes[meta[(at // width >> meta_bits) * across + (at % width >> meta_bits)]]
        s = green.read(bits)
        if s < GREENS:
            r, b = red.read(bits), blue.read(bits)
            out.append(alpha.read(bits) << 24 | r << 16 | s << 8 | b)
            continue
        if s < GREENS + LENGTHS:
            length = _stretch(bits, s - GREENS)
            back = _stretch(bits, far.read(bits))
            if back > len(_NEAR):
                back -= len(_NEAR)
            else:
                x, y = _NEAR[back - 1]
                back = max(1, x + y * width)
            if back > at or at + length > total:
                raise ValueError("a back reference leaves the image")
            if back >= length:
                out += out[at - back : at - back + length]
            else:
                for _ in range(length):
                    out.append(out[-back])
            continue
        while cached < at:  # pixels enter the cache when it is next asked
            p = out[cached]
            cache[(0x1E35A7BD * p & 0xFFFFFFFF) >> (32 - cache_bits)] = p
            cached += 1
        out.append(cache[s - GREENS - LENGTHS])
    return out


def _channels(pixels: list[int], width: int, height: int) -> np.ndarray:
    """(height, width, 4) as A, R, G, B."""
    return np.array(pixels, ">u4").view(np.uint8).reshape(height, width, 4)


def _average(a: list[int], b: list[int]) -> list[int]:
    return [(x + y) >> 1 for x, y in zip(a, b, strict=True)]


def _guess(mode: int, left: list[int], top: list[int], right: list[int], corner: list[int]) -> list[int]:
    """The pixel that one of fourteen predictors tells from the neighbours left, above, above right and above left."""
    if mode in (0, 1, 2, 3, 4):
        return ([255, 0, 0, 0], left, top, right, corner)[mode]
    if mode == 5:
        return _average(_average(left, right), top)
    if mode == 10:
        return _average(_average(left, corner), _average(top, right))
    if mode in (6, 7, 8, 9):
        return _average(*((left, corner), (left, top), (corner, top), (top, right))[mode - 6])
    if mode == 11:
        # Whichever of left and top is nearer to left + top - corner.
        to_left = sum(abs(t - c) for t, c in zip(top, corner, strict=True))
        to_top = sum(abs(v - c) for v, c in zip(left, corner, strict=True))
        return left if to_left < to_top else top
    if mode == 12:
        return [min(255, max(0, v + t - c)) for v, t, c in zip(left, top, corner, strict=True)]
    mean = _average(left, top)
    return [min(255, max(0, m + int((m - c) / 2))) for m, c in zip(mean, corner, strict=True)]


def _unpredicted(x: np.ndarray, modes: np.ndarray, bits: int) -> np.ndarray:
    height, width = x.shape[:2]
    rows = x.tolist()
    out: list[list[list[int]]] = []
    for y in range(height):
        own, line = rows[y], []
        above = out[-1] if y else None
        for i in range(width):
            if y == 0:
                told = line[i - 1] if i else [255, 0, 0, 0]
            elif i == 0:
                told = above[0]
            else:
                told = _guess(int(modes[y >> bits, i >> bits]), line[i - 1], above[i], above[i + 1] if i + 1 < width else line[0], above[i - 1])
            line.append([(a + b) & 255 for a, b in zip(own[i], told, strict=True)])
        out.append(line)
    return np.array(out, np.uint8)


def _uncrossed(x: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    height, width = x.shape[:2]
    every = np.repeat(np.repeat(table, 1 << bits, axis=0), 1 << bits, axis=1)[:height, :width].astype(np.int8).astype(np.int32)
    red_to_blue, green_to_blue, green_to_red = every[:, :, 1], every[:, :, 2], every[:, :, 3]
    signed = x.astype(np.int8).astype(np.int32)
    red = (x[:, :, 1] + (green_to_red * signed[:, :, 2] >> 5)) & 255
    blue = x[:, :, 3] + (green_to_blue * signed[:, :, 2] >> 5)
    out = x.copy()
    out[:, :, 1] = red
    out[:, :, 3] = (blue + (red_to_blue * red.astype(np.uint8).astype(np.int8).astype(np.int32) >> 5)) & 255
    return out


def decode(data: bytes) -> np.ndarray:
    """RGBA as (height, width, 4) of a lossless WebP file."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("no WebP")
    at, body = 12, None
    while at + 8 <= len(data) and body is None:
        size = struct.unpack_from("<I", data, at + 4)[0]
        if data[at : at + 4] == b"VP8L":
            body = data[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    if body is None or body[:1] != b"\x2f":
        raise ValueError("only lossless WebP is read without Pillow")
    bits = _Bits(body[1:])
    full, height = bits.read(14) + 1, bits.read(14) + 1
    bits.read(1)
    if bits.read(3):
        raise ValueError("this version of lossless WebP is not known")
    width, transforms = full, []
    while bits.read(1):
        kind = bits.read(2)
        if kind in (PREDICTOR, CROSS):
            block = bits.read(3) + 2
            across, down = -(-width >> block), -(-height >> block)
            transforms.append((kind, block, _channels(_pixels(bits, across, down, False), across, down), width))
        elif kind == INDEXED:
            n = bits.read(8) + 1
            table = np.cumsum(_channels(_pixels(bits, n, 1, False), n, 1)[0], axis=0, dtype=np.uint8)
            pack = 3 if n <= 2 else 2 if n <= 4 else 1 if n <= 16 else 0
            transforms.append((kind, pack, table, width))
            width = -(-width >> pack)
        else:
            transforms.append((kind, 0, None, width))
    x = _channels(_pixels(bits, width, height, True), width, height)
    for kind, n, table, wide in reversed(transforms):
        if kind == PREDICTOR:
            x = _unpredicted(x, table[:, :, 2] & 15, n)
        elif kind == CROSS:
            x = _uncrossed(x, table, n)
        elif kind == GREEN:
            x = x.copy()
            x[:, :, 1] += x[:, :, 2]
            x[:, :, 3] += x[:, :, 2]
        else:
            each = 8 >> n
            index = x[:, :, 2]
            if n:
                index = np.stack([index >> (each * k) & ((1 << each) - 1) for k in range(1 << n)], axis=-1).reshape(height, -1)[:, :wide]
            padded = np.zeros((256, 4), np.uint8)
            padded[: len(table)] = table
            x = padded[index]
    return np.ascontiguousarray(x[:, :, [1, 2, 3, 0]])


def _lengths(counts: np.ndarray, most: int = 15) -> np.ndarray:
    """Lengths of a prefix code for symbols that occur so often; rare ones are counted up until none is too long."""
    counts = counts.astype(np.int64)
    while True:
        heap = [(int(n), i, (i,)) for i, n in enumerate(counts.tolist()) if n]
        out = np.zeros(len(counts), np.int64)
        heapq.heapify(heap)
        if len(heap) == 1:
            out[heap[0][1]] = 1
            return out
        tie = len(counts)
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            out[list(a[2] + b[2])] += 1
            heapq.heappush(heap, (a[0] + b[0], tie, a[2] + b[2]))
            tie += 1
        if out.max() <= most:
            return out
        counts = np.where(counts > 0, np.maximum(counts, counts.sum() >> (most - 1)), 0)


def _canonical(lengths: np.ndarray) -> np.ndarray:
    """Each symbol's code, its bits in the order in which they are written; a lone symbol has none."""
    out, code, last = np.zeros(len(lengths), np.int64), 0, 0
    if (lengths > 0).sum() < 2:
        return out
    for n, s in sorted((n, s) for s, n in enumerate(lengths.tolist()) if n):
        code <<= n - last
        last = n
        out[s] = int(format(code, f"0{n}b")[::-1], 2)
        code += 1
    return out


class _Writer:
    def __init__(self):
        self.parts: list[np.ndarray] = []

    def put(self, value: int, n: int) -> None:
        self.parts.append(np.array([value >> k & 1 for k in range(n)], np.uint8))

    def put_all(self, values: np.ndarray, lengths: np.ndarray) -> None:
        """Many values of their own numbers of bits."""
        k = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.parts.append((np.repeat(values, lengths) >> k & 1).astype(np.uint8))

    def code(self, lengths: np.ndarray) -> None:
        """A prefix code by its lengths, each as it is."""
        there = np.flatnonzero(lengths)
        if len(there) <= 1:
            value = int(there[0]) if len(there) else 0
            if value < 256:
                self.put(1, 1)
                self.put(0, 1)
                self.put(1, 1)
                self.put(value, 8)
                return
        own = _lengths(np.bincount(lengths, minlength=19), 7)
        codes = _canonical(own)
        self.put(0, 1)
        last = max(k for k, s in enumerate(_ORDER) if own[s] or k < 4)
        self.put(last - 3, 4)
        for k in range(last + 1):
            self.put(int(own[_ORDER[k]]), 3)
        self.put(0, 1)
        bits = np.where((own > 0).sum() < 2, 0, own)
        self.put_all(codes[lengths], bits[lengths])

    def bytes(self) -> bytes:
        return np.packbits(np.concatenate(self.parts), bitorder="little").tobytes()


def encode(pixels: np.ndarray) -> bytes:
    """8-bit RGB or RGBA as a lossless WebP file."""
    height, width = pixels.shape[:2]
    if not 0 < width <= 1 << 14 or not 0 < height <= 1 << 14:
        raise ValueError("a WebP image has 1 to 16384 rows and columns")
    x = np.full((height, width, 4), 255, np.uint8)
    x[:, :, 1:] = pixels[:, :, :3]
    alpha = pixels.shape[2] == 4
    if alpha:
        x[:, :, 0] = pixels[:, :, 3]
    # Green is taken off first, so that it is added last; then the neighbours' guess, one predictor for all blocks.
    x[:, :, 1] -= x[:, :, 2]
    x[:, :, 3] -= x[:, :, 2]
    told = np.empty_like(x)
    told[0, 0] = (255, 0, 0, 0)
    told[0, 1:] = x[0, :-1]
    told[1:, 0] = x[:-1, 0]
    left, top, corner = (v.astype(np.int32) for v in (x[1:, :-1], x[:-1, 1:], x[:-1, :-1]))
    told[1:, 1:] = np.clip(left + top - corner, 0, 255)
    rest = x - told
    out = _Writer()
    out.put(0x2F, 8)
    out.put(width - 1, 14)
    out.put(height - 1, 14)
    out.put(int(alpha), 1)
    out.put(0, 3)
    out.put(1, 1)
    out.put(GREEN, 2)
    out.put(1, 1)
    out.put(PREDICTOR, 2)
    out.put(7, 3)  # blocks of 512 x 512
    out.put(0, 1)  # the block image: no color cache, and each code a lone symbol, so its pixels take no bits
    for value in (12, 0, 0, 255, 0):
        lone = np.zeros(256, np.int64)
        lone[value] = 1
        out.code(lone)
    out.put(0, 1)  # no more transforms
    out.put(0, 1)  # no color cache
    out.put(0, 1)  # one set of codes
    lengths = []
    for channel, size in ((2, GREENS + LENGTHS), (1, 256), (3, 256), (0, 256)):
        lengths.append(_lengths(np.bincount(rest[:, :, channel].ravel(), minlength=size)))
        out.code(lengths[-1])
    out.code(np.eye(1, DISTANCES, dtype=np.int64)[0])
    order = np.stack([rest[:, :, c].ravel() for c in (2, 1, 3, 0)], axis=1)
    codes = np.stack([_canonical(n)[order[:, k]] for k, n in enumerate(lengths)], axis=1)
    bits = np.stack([np.where((n > 0).sum() < 2, 0, n)[order[:, k]] for k, n in enumerate(lengths)], axis=1)
    out.put_all(codes.ravel(), bits.ravel())
    body = out.bytes()
    body += b"\0" * (len(body) & 1)
    chunk = b"VP8L" + struct.pack("<I", len(body)) + body
    return b"RIFF" + struct.pack("<I", 4 + len(chunk)) + b"WEBP" + chunk
