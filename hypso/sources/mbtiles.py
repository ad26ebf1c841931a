"""The MBTiles format (SQLite) as a Spark data source: ``spark.read.format("mbtiles").load(path)``.

Reading: a partition for each zoom and range of columns (option ``tilesperpartition``); filters on z, x, y reach SQLite
as conditions on its key; option ``table`` is tiles (default), keys (without payloads) or metadata. Rows count from the
north, as x, y of the usual scheme. Writing: every task writes a part of its own beside the archive, so all work on
tiles is distributed; the commit, SQLite's one writer, copies the parts together, renames the file into place and logs
what it did beside it (option ``eventlog``). The path must lie in a folder that driver and executors share.
"""

from __future__ import annotations

import json
import os
import sqlite3
from collections.abc import Iterator
from contextlib import closing, suppress
from dataclasses import dataclass
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

_DDL = (
    "CREATE TABLE IF NOT EXISTS tiles (zoom_level INTEGER NOT NULL, tile_column INTEGER NOT NULL, tile_row INTEGER NOT NULL, tile_data BLOB, UNIQUE (zoom_level, tile_column, tile_row))",
    "CREATE TABLE IF NOT EXISTS metadata (name TEXT PRIMARY KEY, value TEXT)",
)
_SCHEMAS = {"tiles": "z int, x int, y int, tile_data binary", "keys": "z int, x int, y int", "metadata": "name string, value string"}
_COLUMNS = {"z": "zoom_level", "x": "tile_column", "y": "((1 << zoom_level) - 1 - tile_row)"}
_COMPARE = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
_MIRRORED = {"=": "=", ">": "<", ">=": "<=", "<": ">", "<=": ">="}


def plain_path(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def connect(path: str, write: bool = False) -> sqlite3.Connection:
    return sqlite3.connect(path) if write else sqlite3.connect(f"file:{path}?mode=ro", uri=True)


@dataclass
class Columns(InputPartition):
    """A zoom's tiles in a range of columns; all of a table without zoom."""

    zoom: int | None
    first: int = 0
    last: int = 0


class MBTilesReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = plain_path(options["path"])
        self.table = options.get("table", "tiles")
        self.each = int(options.get("tilesperpartition", "20000"))
        self.where: list[tuple[str, str, tuple]] = []  # column, comparison (or IN), values

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = f.attribute[0] if self.table != "metadata" and len(getattr(f, "attribute", ())) == 1 else None
            if column in _COLUMNS and type(f) in _COMPARE:
                self.where.append((column, _COMPARE[type(f)], (f.value,)))
            elif column in _COLUMNS and isinstance(f, In) and f.value:
                self.where.append((column, "IN", tuple(f.value)))
            else:
                yield f

    def clause(self, part: Columns | None = None) -> tuple[str, tuple]:
        """Conditions on the key's columns. Rows are stored from the south, so inside a zoom bounds of y become bounds
        of the stored row, which the key's index serves; with no zoom yet they wait."""
        parts, values = [], []
        for column, how, told in self.where:
            if column == "y":
                if part is None:
                    continue
                edge = (1 << part.zoom) - 1
                name, how, told = "tile_row", _MIRRORED.get(how, how), tuple(edge - v for v in told)
            else:
                name = _COLUMNS[column]
            parts.append(f"{name} {how} " + (f"({', '.join('?' * len(told))})" if how == "IN" else "?"))
            values += told
        if part is not None:
            parts.append("zoom_level = ? AND tile_column BETWEEN ? AND ?")
            values += [part.zoom, part.first, part.last]
        return " WHERE " + " AND ".join(parts) if parts else "", tuple(values)

    def partitions(self) -> list[InputPartition]:
        if self.table == "metadata":
            return [Columns(None)]
        clause, values = self.clause()
        out: list[InputPartition] = []
        with closing(connect(self.path)) as db:
            for z, low, high, n in db.execute(f"SELECT zoom_level, MIN(tile_column), MAX(tile_column), COUNT(*) FROM tiles{clause} GROUP BY 1 ORDER BY 1", values):
                step = max(1, -(-(high - low + 1) // max(1, -(-n // self.each))))
                out += [Columns(z, x, min(x + step - 1, high)) for x in range(low, high + 1, step)]
        return out

    def read(self, partition: Columns | None) -> Iterator[tuple]:
        if partition is None:  # Spark's stand-in where there are no partitions
            return
        with closing(connect(self.path)) as db:
            if self.table == "metadata":
                yield from db.execute("SELECT name, value FROM metadata ORDER BY name")
                return
            clause, values = self.clause(partition)
            payload = ", tile_data" if self.table == "tiles" else ""
            yield from db.execute(f"SELECT {', '.join(_COLUMNS.values())}{payload} FROM tiles{clause}", values)


@dataclass
class Written(WriterCommitMessage):
    part: str | None
    rows: int = 0


class MBTilesWriter(DataSourceArrowWriter):
    """Upserts by key into a copy of the archive (``mode`` append) or a new one, then renames it into place.

    Options of the copy that becomes the archive: ``journal_mode``, ``synchronous``; ``onconflict`` replace or ignore.
    """

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path = plain_path(options["path"])
        self.table = options.get("table", "tiles")
        self.batch = int(options.get("batchsize", "250"))
        self.ignore = options.get("onconflict", "replace") == "ignore"
        self.pragmas = {k: options.get(k, v) for k, v in (("journal_mode", "OFF"), ("synchronous", "OFF"))}
        if any(not v.isalnum() for v in self.pragmas.values()):
            raise ValueError("journal_mode and synchronous take a word or a number")
        self.log = options.get("eventlog", "true") == "true" and self.table == "tiles"
        self.overwrite = overwrite

    def event(self, kind: str, **told: int) -> None:
        """A line in the writer's log. Its failure is no failure of the write."""
        if not self.log:
            return
        with suppress(OSError):
            size = os.path.getsize(f"{self.path}.whole") if os.path.exists(f"{self.path}.whole") else os.path.getsize(self.path)
            line = {"event": kind, "timestamp": datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ"), "wal_bytes": size, **told}
            with open(f"{self.path}.writer.log", "a") as f:
                f.write(json.dumps(line) + "\n")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        work = f"{self.path}.part-{TaskContext.get().partitionId()}-{TaskContext.get().attemptNumber()}"
        for stale in (work, f"{work}-journal"):
            if os.path.exists(stale):
                os.remove(stale)
        verb = "INSERT OR IGNORE" if self.ignore else "INSERT OR REPLACE"
        rows = 0
        with closing(connect(work, True)) as db:
            db.execute("PRAGMA synchronous = OFF")
            for ddl in _DDL:
                db.execute(ddl)
            for batch in batches:
                for start in range(0, len(batch), self.batch):
                    part = batch.slice(start, self.batch).to_pylist()
                    if self.table == "metadata":
                        db.executemany(f"{verb} INTO metadata VALUES (?, ?)", [(r["name"], None if r["value"] is None else str(r["value"])) for r in part])
                    else:
                        db.executemany(f"{verb} INTO tiles VALUES (?, ?, ?, ?)", [(r["z"], r["x"], (1 << r["z"]) - 1 - r["y"], r["tile_data"]) for r in part])
                    rows += len(part)
                    db.commit()
        if not rows:
            os.remove(work)
            return Written(None)
        return Written(work, rows)

    def commit(self, messages: list[Written | None]) -> None:
        """Gathers the tasks' files; the archive is replaced at the end, in one step."""
        whole = f"{self.path}.whole"
        if os.path.exists(whole):
            os.remove(whole)
        if not self.overwrite and os.path.exists(self.path):
            with closing(connect(self.path)) as old, closing(connect(whole, True)) as new:
                old.backup(new)
        verb, total = "INSERT OR IGNORE" if self.ignore else "INSERT OR REPLACE", 0
        with closing(connect(whole, True)) as db:
            for k, v in self.pragmas.items():
                db.execute(f"PRAGMA {k} = {v}")
            for ddl in _DDL:
                db.execute(ddl)
            for m in messages:
                if m and m.part:
                    db.execute("ATTACH ? AS part", (m.part,))
                    for t in ("tiles", "metadata"):
                        db.execute(f"{verb} INTO {t} SELECT * FROM part.{t}")
                    db.commit()
                    db.execute("DETACH part")
                    total += m.rows
                    self.event("commit", batch_committed=m.rows, insert_count=total)
            if self.pragmas["journal_mode"].upper() == "WAL":
                db.execute("PRAGMA wal_checkpoint(TRUNCATE)")
                db.execute("PRAGMA journal_mode = DELETE")
                self.event("checkpoint", insert_count=total)
        os.replace(whole, self.path)
        self.event("finalize", insert_count=total)
        for m in messages:
            if m and m.part:
                os.remove(m.part)

    def abort(self, messages: list[Written | None]) -> None:
        for m in messages:
            if m and m.part and os.path.exists(m.part):
                os.remove(m.part)


class MBTilesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mbtiles"

    def schema(self) -> str:
        return _SCHEMAS[self.options.get("table", "tiles")]

    def reader(self, schema) -> DataSourceReader:
        return MBTilesReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return MBTilesWriter(dict(self.options), overwrite)
