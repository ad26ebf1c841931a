"""GeoTIFF elevation rasters, read with NumPy and zlib by the public TIFF 6, BigTIFF and GeoTIFF specifications.

Only what is asked for is read: the directories for a header, and of the pixels the strips or tiles that a window
touches, by ranges of the file. Supported: classic and BigTIFF of either byte order, strips or tiles, 8 to 64-bit
integers and 32 or 64-bit floats, the first of several bands, no compression, Deflate, LZW or PackBits, horizontal and
floating-point predictors, internal masks. CRS: 3857, degrees (4326 and frames that agree with it to well below a pixel)
and transverse Mercator by code (UTM zones, Japan's plane-rectangular zones); others raise ValueError.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections import OrderedDict
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

from ..functions.tilemath import HALF

# TIFF field types' sizes and codes, and tags.
_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q", 18: "Q", 5: "II", 10: "ii"}
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, SAMPLES, ROWS, COUNTS, PREDICTOR = 256, 257, 258, 259, 273, 277, 278, 279, 317
TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, FORMAT = 322, 323, 324, 325, 339
SCALE, TIEPOINT, TRANSFORM, GEO_KEYS, NODATA = 33550, 33922, 34264, 34735, 42113
_CRS_KEYS = (3072, 2048)
_DEGREES = (4326, 6668, 4612)


KIND, PLANES = 254, 284

Read = Callable[[int, int], bytes]
#: Bytes read at a file's beginning, where most headers lie whole.
HEAD = 1 << 16


def bytes_reader(data: bytes) -> Read:
    return lambda at, size: bytes(data[at : at + size])


def ranges(path: str) -> tuple[Read, Callable[[], None]]:
    """A reader of ranges of a file on any file system that Arrow knows (local, hdfs, s3, gs, ...), and its close."""
    local = path.removeprefix("file://").removeprefix("file:") if path.startswith("file:") else path
    if "://" in local:
        from pyarrow.fs import FileSystem

        system, inside = FileSystem.from_uri(local)
        f = system.open_input_file(inside)
    else:
        f = open(local, "rb")  # noqa: SIM115

    def read(at: int, size: int) -> bytes:
        f.seek(at)
        return f.read(size)

    return read, f.close


@dataclass(frozen=True)
class TransverseMercator:
    """An ellipsoid's transverse Mercator: central meridian and origin's latitude in degrees, scale, false east and north."""

    meridian: float
    origin: float
    scale: float
    east: float
    north: float
    axis: float = 6378137.0
    flattening: float = 1 / 298.257222101

    def _series(self) -> tuple[float, np.ndarray, np.ndarray]:
        # Krueger's series to the fourth order of the third flattening.
        n = self.flattening / (2 - self.flattening)
        radius = self.axis / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
        alpha = np.array([n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280])
        beta = np.array([n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440, 17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280])
        return radius, alpha, beta

    def _conformal(self, lat: np.ndarray) -> np.ndarray:
        """Tangent of the conformal latitude."""
        e = math.sqrt(self.flattening * (2 - self.flattening))
        s = np.sin(lat)
        return np.sinh(np.arctanh(s) - e * np.arctanh(e * s))

    def forward(self, lon: np.ndarray, lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Degrees to metres."""
        radius, alpha, _ = self._series()
        t, turn = self._conformal(np.radians(lat)), np.radians(np.asarray(lon) - self.meridian)
        xi, eta = np.arctan2(t, np.cos(turn)), np.arcsinh(np.sin(turn) / np.hypot(t, np.cos(turn)))
        j = 2.0 * np.arange(1, 5).reshape(-1, *[1] * np.ndim(xi))
        a = alpha.reshape(j.shape)
        x = self.east + self.scale * radius * (eta + (a * np.cos(j * xi) * np.sinh(j * eta)).sum(axis=0))
        y = radius * (xi + (a * np.sin(j * xi) * np.cosh(j * eta)).sum(axis=0))
        return x, self.north + self.scale * (y - self._from_equator())

    def _from_equator(self) -> float:
        radius, alpha, _ = self._series()
        xi = math.atan(float(self._conformal(np.radians(self.origin))))
        return radius * (xi + sum(float(a) * math.sin(2 * (k + 1) * xi) for k, a in enumerate(alpha)))

    def inverse(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Metres to degrees."""
        radius, _, beta = self._series()
        xi0 = ((np.asarray(y, float) - self.north) / self.scale + self._from_equator()) / radius
        eta0 = (np.asarray(x, float) - self.east) / self.scale / radius
        j = 2.0 * np.arange(1, 5).reshape(-1, *[1] * np.ndim(xi0))
        b = beta.reshape(j.shape)
        xi = xi0 - (b * np.sin(j * xi0) * np.cosh(j * eta0)).sum(axis=0)
        eta = eta0 - (b * np.cos(j * xi0) * np.sinh(j * eta0)).sum(axis=0)
        t = np.sin(xi) / np.hypot(np.sinh(eta), np.cos(xi))
        lat = np.arctan(t)
        for _ in range(6):  # the latitude whose conformal tangent is t
            f = self._conformal(lat)
            e2 = self.flattening * (2 - self.flattening)
            lat = lat + (t - f) * np.cos(lat) * (1 - e2 * np.sin(lat) ** 2) / (1 - e2) / np.sqrt(1 + f * f)
        return self.meridian + np.degrees(np.arctan2(np.sinh(eta), np.cos(xi))), np.degrees(lat)


# Latitude and longitude (degrees and minutes) of the origins of Japan's zones I to XIX.
_JAPAN = (
    (33, 129, 30), (33, 131, 0), (36, 132, 10), (33, 133, 30), (36, 134, 20), (36, 136, 0), (36, 137, 10), (36, 138, 30), (36, 139, 50), (40, 140, 50),
    (44, 140, 15), (44, 142, 15), (44, 144, 15), (26, 142, 0), (26, 127, 30), (26, 124, 0), (26, 131, 0), (20, 136, 0), (26, 154, 0),
)


def projection(crs: int) -> TransverseMercator | None:
    """The transverse Mercator projection of a code, if it is one that is known."""
    for first in (6669, 2443):
        if first <= crs < first + len(_JAPAN):
            lat, degrees, minutes = _JAPAN[crs - first]
            return TransverseMercator(degrees + minutes / 60, lat, 0.9999, 0.0, 0.0)
    for first, last, north in ((32601, 32660, 0.0), (32701, 32760, 10_000_000.0)):
        if first <= crs <= last:
            return TransverseMercator(6 * (crs - first) - 177, 0.0, 0.9996, 500_000.0, north, flattening=1 / 298.257223563)
    if 6688 <= crs <= 6692:  # UTM zones 51 to 55 of Japan's frame
        return TransverseMercator(6 * (crs - 6688 + 50) - 177, 0.0, 0.9996, 500_000.0, 0.0)
    return None


def to_degrees(my: np.ndarray) -> np.ndarray:
    return np.degrees(np.arctan(np.sinh(np.asarray(my) / HALF * np.pi)))


def to_metres(lat: np.ndarray) -> np.ndarray:
    return np.arcsinh(np.tan(np.radians(lat))) / np.pi * HALF


@dataclass
class Header:
    width: int
    height: int
    crs: int | None
    left: float
    top: float
    step_x: float
    step_y: float
    nodata: float | None
    tags: dict
    order: str
    mask: dict | None = None

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        return self.left, self.top - self.step_y * self.height, self.left + self.step_x * self.width, self.top

    def mercator_bounds(self) -> tuple[float, float, float, float]:
        """(left, bottom, right, top) in Mercator metres. A projected raster's edges are followed in 21 places each."""
        if self.crs is None:
            raise ValueError("the raster has no CRS")
        w, s, e, n = self.bounds
        if self.crs == 3857:
            return w, s, e, n
        if self.crs in _DEGREES:
            return w / 180 * HALF, float(to_metres(s)), e / 180 * HALF, float(to_metres(n))
        flat = projection(self.crs)
        if flat is None:
            raise ValueError(f"CRS {self.crs} is not supported")
        xs, ys = np.linspace(w, e, 21), np.linspace(s, n, 21)
        lon, lat = flat.inverse(np.concatenate([xs, xs, np.full(21, w), np.full(21, e)]), np.concatenate([np.full(21, s), np.full(21, n), ys, ys]))
        return float(lon.min() / 180 * HALF), float(to_metres(lat.min())), float(lon.max() / 180 * HALF), float(to_metres(lat.max()))

    def place(self, mx: np.ndarray, my: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fractional rows and columns (0 is the first pixel's centre) of Mercator places: of a column of eastings and
        one of northings where the axes stay apart, of whole grids of both where the CRS turns them."""
        if self.crs == 3857:
            x, y = mx, my
        elif self.crs in _DEGREES:
            x, y = mx / HALF * 180, to_degrees(my)
        else:
            x, y = projection(self.crs).forward(*np.broadcast_arrays(mx[None, :] / HALF * 180, to_degrees(my)[:, None]))
        return (self.top - y) / self.step_y - 0.5, (x - self.left) / self.step_x - 0.5


def _directory(read: Read, at: int, order: str, big: bool) -> tuple[dict[int, tuple], int]:
    """A directory's tags, and where the next one lies (0: nowhere)."""
    many, slot, code, most = ("Q", 20, "HHQ", 8) if big else ("H", 12, "HHI", 4)
    start = struct.calcsize(order + many)
    n = struct.unpack(order + many, read(at, start))[0]
    body = read(at + start, n * slot + most)
    tags: dict[int, tuple] = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(order + code, body, slot * k)
        if kind not in _TYPES:
            continue
        form = f"{order}{count}s" if _TYPES[kind] == "s" else f"{order}{count * len(_TYPES[kind])}{_TYPES[kind][0]}"
        size = struct.calcsize(form)
        inline = body[slot * k + slot - most : slot * k + slot]
        tags[tag] = struct.unpack(form, inline[:size] if size <= most else read(struct.unpack(order + ("Q" if big else "I"), inline)[0], size))
    return tags, struct.unpack_from(order + ("Q" if big else "I"), body, n * slot)[0]


def header(source: bytes | Read) -> Header:
    read = source if callable(source) else bytes_reader(source)
    head = read(0, HEAD)

    def near(at: int, size: int) -> bytes:
        return head[at : at + size] if at + size <= len(head) else read(at, size)

    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack_from(order + "H", head, 2)[0] if order else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF")
    big = version == 43
    at = struct.unpack_from(order + "Q", head, 8)[0] if big else struct.unpack_from(order + "I", head, 4)[0]
    tags, after = _directory(near, at, order, big)
    mask, seen = None, {at}
    while after and after not in seen and len(seen) < 64 and mask is None:
        seen.add(after)
        other, following = _directory(near, after, order, big)
        if other.get(KIND, (0,))[0] & 4 and other[WIDTH][0] == tags[WIDTH][0] and other[HEIGHT][0] == tags[HEIGHT][0]:
            mask = other
        after = following
    if SCALE in tags and TIEPOINT in tags:
        col, row, _, x, y, _ = tags[TIEPOINT][:6]
        sx, sy = tags[SCALE][:2]
        left, top = x - col * sx, y + row * sy
    elif TRANSFORM in tags:
        m = tags[TRANSFORM]
        left, top, sx, sy = m[3], m[7], m[0], -m[5]
    else:
        left, top, sx, sy = 0.0, float(tags[HEIGHT][0]), 1.0, 1.0
    keys = tags.get(GEO_KEYS, ())
    geo = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    crs = next((geo[k] for k in _CRS_KEYS if geo.get(k, 32767) != 32767), None)
    text = tags.get(NODATA, (b"",))[0].split(b"\0")[0].strip()
    return Header(tags[WIDTH][0], tags[HEIGHT][0], crs, left, top, sx, sy, float(text) if text else None, tags, order, mask)


def _packbits(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2
    return bytes(out)


def _lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, the highest bit first, 256 to clear and 257 to end."""
    table = [bytes([i]) for i in range(256)] + [b"", b""]
    out, held, have, width, last = [], 0, 0, 9, b""
    for byte in data:
        held, have = held << 8 | byte, have + 8
        while have >= width:
            have -= width
            code, held = held >> have, held & (1 << have) - 1
            if code == 257:
                return b"".join(out)
            if code == 256:
                del table[258:]
                width, last = 9, b""
                continue
            if not last:
                entry = table[code]
            else:
                entry = table[code] if code < len(table) else last + last[:1]
                table.append(last + entry[:1])
            out.append(entry)
            last = entry
            width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def _unpacked(raw: bytes, compression: int) -> bytes:
    if compression in (8, 32946):
        return zlib.decompress(raw)
    if compression == 5:
        return _lzw(raw)
    if compression == 32773:
        return _packbits(raw)
    if compression != 1:
        raise ValueError(f"compression {compression} is not supported")
    return raw


@dataclass
class Raster:
    """A raster's first band, read by windows. The segments (strips or tiles) of the last windows are kept."""

    read: Read
    h: Header
    most: int = 64 << 20  # bytes of segments kept
    decoded: int = 0  # segments decoded so far
    _kept: OrderedDict = field(default_factory=OrderedDict)
    _size: int = 0

    def _layout(self, t: dict) -> tuple[int, int, tuple, tuple, int]:
        tiled = TILE_OFFSETS in t
        wide, high = (t[TILE_WIDTH][0], t[TILE_HEIGHT][0]) if tiled else (self.h.width, min(t.get(ROWS, (self.h.height,))[0], self.h.height))
        offsets, counts = (t[TILE_OFFSETS], t[TILE_COUNTS]) if tiled else (t[OFFSETS], t[COUNTS])
        return wide, high, offsets, counts, -(-self.h.width // wide)

    def _segment(self, t: dict, k: int) -> np.ndarray:
        """One strip's or tile's values."""
        name = (id(t), k)
        if name in self._kept:
            self._kept.move_to_end(name)
            return self._kept[name]
        wide, high, offsets, counts, across = self._layout(t)
        bits, kind = t.get(BITS, (1,))[0], {1: "u", 2: "i", 3: "f"}.get(t.get(FORMAT, (1,))[0])
        bands = t.get(SAMPLES, (1,))[0] if t.get(PLANES, (1,))[0] == 1 else 1
        if kind is None or bits not in (1, 8, 16, 32, 64):
            raise ValueError("only rasters of bits or whole bytes are supported")
        rows = high if TILE_OFFSETS in t else min(high, self.h.height - k // across * high)
        raw = _unpacked(self.read(offsets[k], counts[k]), t.get(COMPRESSION, (1,))[0])
        predictor = t.get(PREDICTOR, (1,))[0]
        if bits == 1:
            x = np.unpackbits(np.frombuffer(raw, np.uint8)[: rows * -(-wide // 8)].reshape(rows, -1), axis=1)[:, :wide]
        else:
            form = np.dtype(f"{self.h.order}{kind}{bits // 8}")
            if predictor == 3:
                planes = np.frombuffer(raw, np.uint8)[: rows * wide * bands * form.itemsize].reshape(rows, -1, bands)
                planes = np.cumsum(planes, axis=1, dtype=np.uint8).reshape(rows, form.itemsize, wide * bands)
                x = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(f">f{form.itemsize}")[:, :, 0].reshape(rows, wide, bands)
            else:
                x = np.frombuffer(raw, form)[: rows * wide * bands].reshape(rows, wide, bands)
                if predictor == 2:
                    x = np.cumsum(x, axis=1, dtype=x.dtype.newbyteorder("="))
            x = x[:, :, 0]
        self.decoded += 1
        self._kept[name] = x
        self._size += x.nbytes
        while self._size > self.most and len(self._kept) > 1:
            self._size -= self._kept.popitem(last=False)[1].nbytes
        return x

    def _pixels(self, t: dict, row0: int, row1: int, col0: int, col1: int) -> np.ndarray:
        wide, high, *_, across = self._layout(t)
        out = np.zeros((row1 - row0, col1 - col0))
        for i in range(row0 // high, -(-row1 // high)):
            for j in range(col0 // wide, -(-col1 // wide)):
                x = self._segment(t, i * across + j)
                top, left = i * high, j * wide
                r0, r1, c0, c1 = max(row0, top), min(row1, top + x.shape[0]), max(col0, left), min(col1, left + x.shape[1])
                out[r0 - row0 : r1 - row0, c0 - col0 : c1 - col0] = x[r0 - top : r1 - top, c0 - left : c1 - left]
        return out

    def window(self, row0: int, row1: int, col0: int, col1: int) -> np.ndarray:
        """Rows and columns of the band as float64, no data as NaN: by the no-data value, else by the internal mask."""
        out = self._pixels(self.h.tags, row0, row1, col0, col1)
        if self.h.nodata is not None:
            out[np.isnan(out) if np.isnan(self.h.nodata) else out == self.h.nodata] = np.nan
        elif self.h.mask is not None:
            out[self._pixels(self.h.mask, row0, row1, col0, col1) == 0] = np.nan
        return out


def band(data: bytes, h: Header | None = None) -> np.ndarray:
    """The whole first band."""
    h = h or header(data)
    return Raster(bytes_reader(data), h).window(0, h.height, 0, h.width)


def write(path: str, grid: np.ndarray, left: float, top: float, step: float, crs: int = 3857, nodata: float | None = None, compress: bool = True) -> None:
    """A float32 strip GeoTIFF, as tests and small exports need it."""
    raw = np.ascontiguousarray(grid, "<f4").tobytes()
    raw = zlib.compress(raw) if compress else raw
    geo = (1, 1, 0, 2, 1024, 0, 1, 1 if crs == 3857 else 2, 3072 if crs == 3857 else 2048, 0, 1, crs)
    tags = [
        (WIDTH, "I", (grid.shape[1],)), (HEIGHT, "I", (grid.shape[0],)), (BITS, "H", (32,)), (COMPRESSION, "H", (8 if compress else 1,)), (262, "H", (1,)),
        (OFFSETS, "I", (8,)), (SAMPLES, "H", (1,)), (ROWS, "I", (grid.shape[0],)), (COUNTS, "I", (len(raw),)), (FORMAT, "H", (3,)),
        (SCALE, "d", (step, step, 0.0)), (TIEPOINT, "d", (0.0, 0.0, 0.0, left, top, 0.0)), (GEO_KEYS, "H", geo),
    ]
    codes = {"H": 3, "I": 4, "d": 12}
    if nodata is not None:
        tags.append((NODATA, "s", (f"{nodata:g}\0".encode(),)))
    body, entries, at = b"", b"", 8 + len(raw)
    for tag, code, values in sorted(tags):
        packed = values[0] if code == "s" else struct.pack("<" + code * len(values), *values)
        count = len(packed) if code == "s" else len(values)
        if len(packed) > 4:
            value = struct.pack("<I", at + len(body))
            body += packed
        else:
            value = packed.ljust(4, b"\0")
        entries += struct.pack("<HHI", tag, codes.get(code, 2), count) + value
    with open(path, "wb") as f:
        f.write(struct.pack("<2sHI", b"II", 42, at + len(body)) + raw + body + struct.pack("<H", len(tags)) + entries + struct.pack("<I", 0))
