"""Lossless WebP without Pillow: round trips, and each of the format's features in a stream made by hand."""

import struct

import numpy as np
import pytest

from hypso.sources import codec, webp


@pytest.mark.parametrize("shape", [(1, 1, 3), (1, 9, 3), (7, 1, 4), (37, 21, 3), (64, 48, 4)])
def test_round_trip(shape):
    x = np.random.default_rng(sum(shape)).integers(0, 256, shape, dtype=np.uint8)
    got = webp.decode(webp.encode(x))
    assert (got[:, :, : shape[2]] == x).all() and (shape[2] == 4 or (got[:, :, 3] == 255).all())
    smooth = (np.add.outer(np.arange(30), np.arange(40))[:, :, None] * [1, 2, 3]).astype(np.uint8)
    assert (codec.decode(codec.encode(smooth, image="webp"))[:, :, :3] == smooth).all()


def stream(width, height, write):
    out = webp._Writer()
    out.put(0x2F, 8)
    out.put(width - 1, 14)
    out.put(height - 1, 14)
    out.put(1, 1)
    out.put(0, 3)
    write(out)
    body = out.bytes()
    body += b"\0" * (len(body) & 1)
    return b"RIFF" + struct.pack("<I", 12 + len(body)) + b"WEBPVP8L" + struct.pack("<I", len(body)) + body


def lengths(size, *there):
    """A code of equally long words for two or four symbols, or a lone symbol."""
    out = np.zeros(size, np.int64)
    out[list(there)] = {1: 1, 2: 1, 4: 2}[len(there)]
    return out


def symbol(out, code, s):
    n = int(code[s]) if (code > 0).sum() > 1 else 0
    out.put(int(webp._canonical(code)[s]), n)


def image(out, codes, pixels, cache=0, main=True):
    """Literals (a, r, g, b), copies ("copy", symbol, extra bits, their number, distance symbol) and ("cache", index)."""
    out.put(1 if cache else 0, 1)
    if cache:
        out.put(cache, 4)
    if main:
        out.put(0, 1)
    for c in codes:
        out.code(c)
    green, red, blue, alpha, far = codes
    for p in pixels:
        if p[0] == "copy":
            symbol(out, green, 256 + p[1])
            out.put(p[2], p[3])
            symbol(out, far, p[4])
        elif p[0] == "cache":
            symbol(out, green, 280 + p[1])
        else:
            for code, value in ((green, p[2]), (red, p[1]), (blue, p[3]), (alpha, p[0])):
                symbol(out, code, value)


def test_back_references_and_cache():
    def write(out):
        out.put(0, 1)
        codes = [lengths(280, 5, 9, 256 + 5, 256 + 1), lengths(256, 7), lengths(256, 8), lengths(256, 255), lengths(40, 0, 1)]
        # A literal, seven more of it from one to the left, another literal, and two from the row above.
        image(out, codes, [(255, 7, 5, 8), ("copy", 5, 0, 1, 1), (255, 7, 9, 8), ("copy", 1, 0, 0, 0), (255, 7, 9, 8)])

    got = webp.decode(stream(4, 3, write))
    assert got[:, :, 1].tolist() == [[5, 5, 5, 5], [5, 5, 5, 5], [9, 5, 5, 9]] and (got[:, :, [0, 2, 3]] == [7, 8, 255]).all()

    def cached(out):
        out.put(0, 1)
        first, second = (0xFF000000 | g << 8 for g in (5, 9))
        at = [(0x1E35A7BD * p & 0xFFFFFFFF) >> 30 for p in (first, second)]
        assert at[0] != at[1]
        size = 256 + 24 + 4
        codes = [lengths(size, 5, 9, 280 + at[0], 280 + at[1]), lengths(256, 0), lengths(256, 0), lengths(256, 255), lengths(40, 0)]
        image(out, codes, [(255, 0, 5, 0), (255, 0, 9, 0), ("cache", at[0]), ("cache", at[1])], cache=2)

    assert webp.decode(stream(4, 1, cached))[0, :, 1].tolist() == [5, 9, 5, 9]
    with pytest.raises(ValueError):
        webp.decode(stream(4, 1, lambda out: (out.put(0, 1), image(out, [lengths(280, 5, 256), lengths(256, 7), lengths(256, 8), lengths(256, 255), lengths(40, 0)], [("copy", 0, 0, 0, 0)]))))


def test_color_indexing():
    """Two colors: eight pixels in one byte of the index image."""

    def write(out):
        out.put(1, 1)
        out.put(webp.INDEXED, 2)
        out.put(1, 8)
        codes = [lengths(280, 10, 30), lengths(256, 1, 2), lengths(256, 3), lengths(256, 0, 255), lengths(40, 0)]
        image(out, codes, [(255, 1, 10, 3), (0, 2, 30, 3)], main=False)  # the second is told by its difference
        out.put(0, 1)
        image(out, [lengths(280, 0b10110010, 0b01), lengths(256, 0), lengths(256, 0), lengths(256, 255), lengths(40, 0)], [(255, 0, 0b10110010, 0), (255, 0, 0b01, 0)])

    got = webp.decode(stream(10, 1, write))
    assert got[0, :, 0].tolist() == [1, 3, 1, 1, 3, 3, 1, 3, 3, 1] and got[0, :, 1].tolist() == [10, 40, 10, 10, 40, 40, 10, 40, 40, 10]


def test_meta_codes_choose_by_block():
    """Blocks of four columns with codes of their own."""

    def write(out):
        out.put(0, 1)
        out.put(0, 1)
        out.put(1, 1)
        out.put(0, 3)
        image(out, [lengths(280, 0, 1), lengths(256, 0), lengths(256, 0), lengths(256, 255), lengths(40, 0)], [(255, 0, 0, 0), (255, 0, 1, 0)], main=False)
        for g in (5, 9):
            for c in (lengths(280, g), lengths(256, 1), lengths(256, 2), lengths(256, 255), lengths(40, 0)):
                out.code(c)

    assert webp.decode(stream(8, 2, write))[:, :, 1].tolist() == [[5] * 4 + [9] * 4] * 2


def test_cross_color_and_predictors():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 256, (9, 11, 4), dtype=np.uint8)
    table = rng.integers(0, 256, (3, 3, 4), dtype=np.uint8)
    forward = x.copy()
    for r in range(9):
        for c in range(11):
            red_blue, green_blue, green_red = (int(v) - 256 * (v > 127) for v in table[r >> 2, c >> 2, 1:].astype(int))
            a, red, green, blue = x[r, c].astype(int)
            s = lambda v: v - 256 * (v > 127)
            forward[r, c] = (a, red - (green_red * s(green) >> 5) & 255, green, blue - (green_blue * s(green) >> 5) - (red_blue * s(red) >> 5) & 255)
    assert (webp._uncrossed(forward, table, 2) == x).all()
    left, top, right, corner = ([10, 200, 3, 90], [20, 100, 250, 80], [30, 50, 7, 70], [15, 150, 9, 60])
    assert [webp._guess(m, left, top, right, corner)[0] for m in range(14)] == [255, 10, 20, 30, 15, 20, 12, 15, 17, 25, 18, 20, 15, 15]
    for mode in range(14):
        told = np.zeros_like(x, dtype=int)
        for r in range(9):
            for c in range(11):
                if r == 0:
                    told[r, c] = x[0, c - 1] if c else (255, 0, 0, 0)
                elif c == 0:
                    told[r, c] = x[r - 1, 0]
                else:
                    after = x[r - 1, c + 1] if c < 10 else x[r, 0]
                    told[r, c] = webp._guess(mode, *(v.astype(int).tolist() for v in (x[r, c - 1], x[r - 1, c], after, x[r - 1, c - 1])))
        assert (webp._unpredicted((x - told).astype(np.uint8), np.full((3, 3), mode), 2) == x).all()


def test_other_files_are_refused():
    for data in (b"", b"GIF89a", b"RIFF\0\0\0\0WEBPVP8 \0\0\0\0"):
        with pytest.raises(ValueError):
            webp.decode(data)
    with pytest.raises(ValueError):
        webp.encode(np.zeros((0, 4, 3), np.uint8))
