"""RGB grids to image bytes and back, without loss: WebP where Pillow is there; else PNG, written and read with zlib alone.

An archive's pixels don't depend on the codec, and ``decode`` tells them apart by their first bytes. Without Pillow,
lossless WebP is still read, and written if asked for by name, by ``webp``; PNG is smaller and faster there.
"""

from __future__ import annotations

import io
import os
import struct
import zlib

import numpy as np

from . import webp

try:
    from PIL import Image
except ImportError:
    Image = None

_PNG = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png_encode(pixels: np.ndarray, level: int = 6) -> bytes:
    """8-bit RGB or RGBA, each row with the Up filter, which suits smooth elevations."""
    h, w, bands = pixels.shape
    x = np.ascontiguousarray(pixels, np.uint8).reshape(h, w * bands)
    up = x.copy()
    up[1:] -= x[:-1]
    body = np.concatenate([np.full((h, 1), 2, np.uint8), up], axis=1).tobytes()
    head = struct.pack(">IIBBBBB", w, h, 8, {3: 2, 4: 6}[bands], 0, 0, 0)
    return _PNG + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(body, level)) + _chunk(b"IEND", b"")


def _unfilter(kind: int, row: np.ndarray, above: np.ndarray, bands: int) -> np.ndarray:
    if kind == 0:
        return row
    if kind == 2:
        return row + above
    out = row.reshape(-1, bands).astype(np.int32)
    b = above.reshape(-1, bands).astype(np.int32)
    if kind == 1:
        return (np.cumsum(out, axis=0) & 255).astype(np.uint8).ravel()
    left, corner = np.zeros(bands, np.int32), np.zeros(bands, np.int32)
    for i in range(len(out)):
        if kind == 3:
            guess = (left + b[i]) >> 1
        else:
            p = left + b[i] - corner
            da, db, dc = abs(p - left), abs(p - b[i]), abs(p - corner)
            guess = np.where((da <= db) & (da <= dc), left, np.where(db <= dc, b[i], corner))
        out[i] = (out[i] + guess) & 255
        left, corner = out[i], b[i]
    return out.astype(np.uint8).ravel()


def png_decode(data: bytes) -> np.ndarray:
    """Not interlaced 8-bit grey, RGB or RGBA PNGs, as (height, width, bands)."""
    if data[:8] != _PNG:
        raise ValueError("no PNG")
    at, body, head = 8, [], None
    while at < len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
        at += size + 12
    if head is None or head[2] != 8 or head[3] not in (0, 2, 6) or head[6]:
        raise ValueError("this kind of PNG is not supported")
    w, h, bands = head[0], head[1], {0: 1, 2: 3, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(h, 1 + w * bands)
    out = np.zeros((h, w * bands), np.uint8)
    above = np.zeros(w * bands, np.uint8)
    for i in range(h):
        above = out[i] = _unfilter(int(raw[i, 0]), raw[i, 1:], above, bands)
    return out.reshape(h, w, bands)


def effort(method: int | None = None) -> int:
    """WebP effort 0 to 6: the argument, else HYPSO_WEBP_METHOD, else 6; anything unreadable is 6."""
    try:
        return min(6, max(0, int(method if method is not None else os.environ.get("HYPSO_WEBP_METHOD", 6))))
    except ValueError:
        return 6


def encode(pixels: np.ndarray, method: int | None = None, image: str | None = None) -> bytes:
    if (image or image_format()) == "webp":
        if not Image:
            return webp.encode(np.ascontiguousarray(pixels, np.uint8))
        out = io.BytesIO()
        Image.fromarray(np.ascontiguousarray(pixels, np.uint8)).save(out, "WEBP", lossless=True, method=effort(method), exact=True)
        return out.getvalue()
    return png_encode(pixels)


def decode(data: bytes) -> np.ndarray:
    """RGBA, as (height, width, 4)."""
    if data[:8] == _PNG:
        x = png_decode(data)
    elif Image:
        x = np.array(Image.open(io.BytesIO(data)).convert("RGBA"))
    else:
        x = webp.decode(data)
    if x.shape[2] == 1:
        x = np.repeat(x, 3, axis=2)
    return x if x.shape[2] == 4 else np.concatenate([x, np.full((*x.shape[:2], 1), 255, np.uint8)], axis=2)


def image_format() -> str:
    return "webp" if Image else "png"
