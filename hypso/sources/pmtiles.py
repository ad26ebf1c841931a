"""The PMTiles format, version 3, by its public specification, as a Spark data source.

Reading: option ``table`` is tiles (default), header or metadata; partitions are the leaf directories' places (or runs
of the root's entries), so no list of tiles is made on the driver. Writing: every task spools the payloads of one
range of Hilbert tile ids, in order, to a file beside the archive, and their directory entries to another; the commit
puts the ranges in order, streams entries into leaf directories and payloads behind them, and renames the file. Equal
neighbouring payloads share one entry by its run length. The path must lie in a folder that driver and executors share.
"""

from __future__ import annotations

import gzip
import json
import os
import shutil
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .mbtiles import plain_path

_HEADER = struct.Struct("<7sBQQQQQQQQQQQBBBBBBiiiiBii")
_NAMES = (
    "magic", "version", "root_offset", "root_length", "metadata_offset", "metadata_length", "leaf_offset", "leaf_length", "data_offset", "data_length",
    "addressed", "entries", "contents", "clustered", "internal_compression", "tile_compression", "tile_type", "min_zoom", "max_zoom",
    "min_lon_e7", "min_lat_e7", "max_lon_e7", "max_lat_e7", "center_zoom", "center_lon_e7", "center_lat_e7",
)
# Fixed values of the specification.
HEADER_BYTES, ROOT_LIMIT = 127, 16384 - 127
TILE_TYPES = {"unknown": 0, "mvt": 1, "png": 2, "jpeg": 3, "webp": 4, "avif": 5}
GZIP, NONE = 2, 1
_SCHEMAS = {"tiles": "z int, x int, y int, tile_data binary", "header": ", ".join(f"{n} bigint" for n in _NAMES[1:]), "metadata": "name string, value string"}


def tile_id(z: int, x: int, y: int) -> int:
    """Hilbert position of a tile after all lower zooms."""
    d = ((1 << 2 * z) - 1) // 3
    for a in reversed(range(z)):
        side = 1 << a
        rx, ry = x >> a & 1, y >> a & 1
        d += (3 * rx ^ ry) << 2 * a
        x, y = x & side - 1, y & side - 1
        if not ry:
            if rx:
                x, y = side - 1 - x, side - 1 - y
            x, y = y, x
    return d


def tile_of(number: int) -> tuple[int, int, int]:
    """The inverse of ``tile_id``."""
    z, before = 0, 0
    while number >= before + (1 << 2 * z):
        before += 1 << 2 * z
        z += 1
    d, x, y = number - before, 0, 0
    for a in range(z):
        side = 1 << a
        rx, ry = d >> 1 & 1, (d ^ d >> 1) & 1
        if not ry:
            if rx:
                x, y = side - 1 - x, side - 1 - y
            x, y = y, x
        x, y = x + side * rx, y + side * ry
        d >>= 2
    return z, x, y


def _varints(values: list[int]) -> bytes:
    out = bytearray()
    for v in values:
        while v > 127:
            out.append(v & 127 | 128)
            v >>= 7
        out.append(v)
    return bytes(out)


def pack_directory(entries: list[tuple[int, int, int, int]]) -> bytes:
    """(id, run, length, offset) entries; an offset that follows its predecessor's data is stored as 0."""
    ids = [e[0] - (entries[i - 1][0] if i else 0) for i, e in enumerate(entries)]
    offsets = [0 if i and e[3] == entries[i - 1][3] + entries[i - 1][2] else e[3] + 1 for i, e in enumerate(entries)]
    return gzip.compress(_varints([len(entries), *ids, *(e[1] for e in entries), *(e[2] for e in entries), *offsets]), mtime=0)


def unpack_directory(data: bytes) -> list[tuple[int, int, int, int]]:
    values, v, shift = [], 0, 0
    for b in gzip.decompress(data):
        v |= (b & 127) << shift
        shift += 7
        if b < 128:
            values.append(v)
            v, shift = 0, 0
    n = values[0]
    ids, runs, lengths, offsets = (values[1 + n * k : 1 + n * (k + 1)] for k in range(4))
    out, at = [], 0
    for i in range(n):
        at += ids[i]
        out.append((at, runs[i], lengths[i], offsets[i] - 1 if offsets[i] else out[-1][3] + out[-1][2]))
    return out


def read_header(f) -> dict[str, int]:
    f.seek(0)
    values = dict(zip(_NAMES, _HEADER.unpack(f.read(HEADER_BYTES)), strict=True))
    if values.pop("magic") != b"PMTiles" or values["version"] != 3:
        raise ValueError("not a PMTiles file of version 3")
    return values


def read_entries(f, header: dict[str, int]) -> Iterator[tuple[int, int, int, int]]:
    """All data entries in order, through leaf directories."""

    def part(offset: int, length: int) -> Iterator[tuple[int, int, int, int]]:
        f.seek(offset)
        for e in unpack_directory(f.read(length)):
            if e[1]:
                yield e
            else:
                yield from part(header["leaf_offset"] + e[3], e[2])

    yield from part(header["root_offset"], header["root_length"])


@dataclass
class Place(InputPartition):
    """A directory in the file, and which of its entries (all below it) are meant."""

    offset: int
    length: int
    first: int = 0
    last: int = 1 << 62


def _directories(f, header: dict[str, int], each: int) -> Iterator[Place]:
    """The places of all data entries: leaf directories are named by their own place, not opened."""
    offset, length = header["root_offset"], header["root_length"]
    f.seek(offset)
    entries = unpack_directory(f.read(length))
    leaves = [e for e in entries if not e[1]]
    if leaves:
        yield from (Place(header["leaf_offset"] + e[3], e[2]) for e in leaves)
    if len(leaves) < len(entries):  # data entries in the root itself
        yield from (Place(offset, length, i, i + each) for i in range(0, len(entries), each))


class PMTilesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.table = plain_path(options["path"]), options.get("table", "tiles")
        self.each = int(options.get("entriesperpartition", "4096"))

    def partitions(self) -> list[InputPartition]:
        if self.table != "tiles":
            return [Place(0, 0)]
        with open(self.path, "rb") as f:
            return list(_directories(f, read_header(f), self.each))

    def read(self, partition: Place | None) -> Iterator[tuple]:
        if partition is None:  # Spark's stand-in where there are no partitions
            return
        with open(self.path, "rb") as f:
            header = read_header(f)
            if self.table == "header":
                yield tuple(header.values())
            elif self.table == "metadata":
                f.seek(header["metadata_offset"])
                raw = f.read(header["metadata_length"])
                told = json.loads(gzip.decompress(raw) if header["internal_compression"] == GZIP else raw or b"{}")
                yield from ((k, v if isinstance(v, str) else json.dumps(v)) for k, v in told.items())
            else:
                for number, run, length, offset in self._entries(f, header, partition):
                    f.seek(header["data_offset"] + offset)
                    data = f.read(length)
                    for k in range(run):
                        yield *tile_of(number + k), data

    def _entries(self, f, header: dict[str, int], place: Place) -> Iterator[tuple[int, int, int, int]]:
        f.seek(place.offset)
        in_root = place.offset == header["root_offset"]
        for e in unpack_directory(f.read(place.length))[place.first : place.last]:
            if e[1]:
                yield e
            elif not in_root:  # a leaf's own leaves; the root's have partitions of their own
                yield from self._entries(f, header, Place(header["leaf_offset"] + e[3], e[2]))


_ENTRY = struct.Struct("<QIIQ")


@dataclass
class Spooled(WriterCommitMessage):
    """What a task wrote: its files, its first and last tile id, entries, tiles and lowest and highest zoom."""

    spool: str | None
    first: int = 0
    last: int = -1
    entries: int = 0
    addressed: int = 0
    zooms: tuple[int, int] = (0, 0)


def _stored(path: str) -> Iterator[tuple[int, int, int, int]]:
    with open(path, "rb") as f:
        while part := f.read(_ENTRY.size * 4096):
            yield from _ENTRY.iter_unpack(part)


class PMTilesWriter(DataSourceArrowWriter):
    """Options: ``metadata`` (JSON), ``tiletype``, ``bounds`` (west,south,east,north) and ``centerzoom``."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.options = plain_path(options["path"]), options

    def write(self, batches: Iterator[pa.RecordBatch]) -> Spooled:
        from pyspark import TaskContext

        spool = f"{self.path}.spool-{TaskContext.get().partitionId()}-{TaskContext.get().attemptNumber()}"
        out, before, data, at, run = Spooled(spool, zooms=(99, -1)), -1, None, 0, None
        with open(spool, "wb") as f, open(f"{spool}.entries", "wb") as listed:
            for batch in batches:
                for z, x, y, payload in zip(*(batch.column(c).to_pylist() for c in ("z", "x", "y", "tile_data")), strict=True):
                    number = tile_id(z, x, y)
                    if number <= before:
                        raise ValueError("tiles must come in order of tile id, each once")
                    if run is not None and data == payload and number == before + 1:
                        run[1] += 1
                    else:
                        if run is not None:
                            listed.write(_ENTRY.pack(*run))
                        data = bytes(payload)
                        run = [number, 1, len(data), at]
                        f.write(data)
                        at += len(data)
                        out.entries += 1
                    if not out.addressed:
                        out.first = number
                    before, out.addressed, out.zooms = number, out.addressed + 1, (min(out.zooms[0], z), max(out.zooms[1], z))
            if run is not None:
                listed.write(_ENTRY.pack(*run))
        out.last = before
        if not out.addressed:
            self._drop(out)
            return Spooled(None)
        return out

    @staticmethod
    def _drop(m: Spooled) -> None:
        for p in (m.spool, f"{m.spool}.entries"):
            if os.path.exists(p):
                os.remove(p)

    @staticmethod
    def _joined(parts: list[Spooled]) -> Iterator[tuple[int, int, int, int]]:
        """All entries in order, offsets counted over the spools laid end to end. Where a range ends in the payload
        that the next begins with, one entry stands for both."""
        base, held, payload = 0, None, None
        for m in parts:
            with open(m.spool, "rb") as f:
                for k, (number, run, length, offset) in enumerate(_stored(f"{m.spool}.entries")):
                    if held is not None:
                        if k == 0 and held[0] + held[1] == number and held[2] == length and payload == f.read(length):
                            held = (held[0], held[1] + run, length, held[3])
                            continue
                        yield held
                    held = (number, run, length, base + offset)
                if held is not None and held[3] >= base:
                    f.seek(held[3] - base)
                    payload = f.read(held[2])
            base += os.path.getsize(m.spool)
        if held is not None:
            yield held

    def commit(self, messages: list[Spooled | None]) -> None:
        """Only a directory's entries, and one part's last payload, are in memory at a time."""
        full = sorted((m for m in messages if m and m.spool), key=lambda m: m.first)
        if any(a.last >= b.first for a, b in zip(full[:-1], full[1:], strict=True)):
            raise ValueError("tasks must hold disjoint ranges of tile ids")
        low, high = (min(m.zooms[0] for m in full), max(m.zooms[1] for m in full)) if full else (0, 0)
        west, south, east, north = (float(v) for v in self.options.get("bounds", "-180,-85.0511287,180,85.0511287").split(","))
        whole, leaves = f"{self.path}.whole", f"{self.path}.leaves"
        each, count = 4096, 0
        total = sum(m.entries for m in full)
        while total // each > 1500:  # so that the root stays within its limit
            each *= 2
        entries, parts, at = [], [], 0
        with open(leaves, "wb") as f:
            for e in self._joined(full):
                entries.append(e)
                count += 1
                if len(entries) == each:
                    at = self._leaf(f, entries, parts, at)
                    entries = []
            root = pack_directory(entries) if not parts else b""
            if parts or len(root) > ROOT_LIMIT:
                step = each if parts else each // 8
                for i in range(0, len(entries), step):
                    at = self._leaf(f, entries[i : i + step], parts, at)
                root = pack_directory(parts)
        if len(root) > ROOT_LIMIT:
            raise ValueError("the root directory is too large")
        leaf_size, size = os.path.getsize(leaves), sum(os.path.getsize(m.spool) for m in full)
        told = gzip.compress(json.dumps(json.loads(self.options.get("metadata", "{}")), ensure_ascii=False).encode(), mtime=0)
        e7 = lambda v: int(v * 1e7)
        at = HEADER_BYTES + len(root)
        head = _HEADER.pack(
            b"PMTiles", 3, HEADER_BYTES, len(root), at, len(told), at + len(told), leaf_size, at + len(told) + leaf_size, size,
            sum(m.addressed for m in full), count, count, 1, GZIP, NONE, TILE_TYPES.get(self.options.get("tiletype", "webp"), 0), low, high,
            e7(west), e7(south), e7(east), e7(north), int(self.options.get("centerzoom", low)), int(0.5 * (e7(west) + e7(east))), int(0.5 * (e7(south) + e7(north))),
        )
        with open(whole, "wb") as f:
            f.write(head + root + told)
            for p in (leaves, *(m.spool for m in full)):
                with open(p, "rb") as part:
                    shutil.copyfileobj(part, f, 1 << 20)
        os.replace(whole, self.path)
        os.remove(leaves)
        for m in full:
            self._drop(m)

    @staticmethod
    def _leaf(f, entries: list, parts: list, at: int) -> int:
        leaf = pack_directory(entries)
        f.write(leaf)
        parts.append((entries[0][0], 0, len(leaf), at))
        return at + len(leaf)

    def abort(self, messages: list[Spooled | None]) -> None:
        for m in messages:
            if m and m.spool:
                self._drop(m)


class PMTilesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pmtiles"

    def schema(self) -> str:
        return _SCHEMAS[self.options.get("table", "tiles")]

    def reader(self, schema) -> DataSourceReader:
        return PMTilesReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return PMTilesWriter(dict(self.options), overwrite)
