"""Shapefiles, unpacked or in zip archives, as a Spark data source.

    spark.dataSource.register(ShapefileSource)
    spark.read.format("perimeter_shapefile").options(
        path=raw_dir, pattern="Some_Dataset_*", columns="name,year",
        aliases='{"name": ["incidentname", "incident"], "year": ["fire_year"]}',
    ).load()

The path's direct sub-folders and ``*.zip`` files whose name (without ``.zip``) matches ``pattern``
are read; an archive is skipped if it already lies unpacked beside itself. Each requested column is
resolved file by file to the first alias the file has, and only those attributes are decoded. All
attributes come as text. An unpacked file is split by record ranges through its ``.shx``. An archive
that ``archives.stage`` has staged (option ``staged``) is split in the same way; any other is streamed by one
task, member by member, without unpacking it to disk. Where there are more pieces and archives than ``tasks``, neighbours
share a task, one after the other.

An unreadable file gives one row with its ``error`` (or raises with ``mode=FAILFAST``).
"""

from __future__ import annotations

import fnmatch
import io
import json
import struct
import zipfile
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from perimetry.operators.fields import AliasIndex
from perimetry.schema import GEOM, ID_COLUMNS
from perimetry.sources.files import children, open_fs, packed

# Fixed values of the file format.
MAIN_HEADER = 100
_FILE_CODE = 9994
_POLYGONS = (5, 15, 25)
_NO_SHAPE = 0

# places of a record in ``row_id``
_MOST_FILES, _MOST_RECORDS = 1 << 24, 1 << 32

_BATCH_RECORDS = 1024
_BATCH_BYTES = 32 << 20
_READ_BYTES = 1 << 20  # of an archive's member at a time
SPLIT_BYTES = 128 << 20
UNREADABLE = "_unreadable"  # holds the reason in the folder of a staged archive

_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])


@dataclass
class _Range(InputPartition):
    """Records ``start`` to ``stop`` of an unpacked file, or a whole archive (``stop`` = -1).

    ``staged`` is the staged copy that is read in place of an archive's member; ``first`` is the number of records
    in the members before it, as an archive counts its records through. ``size`` is about its bytes.
    """

    path: str
    file_no: int
    start: int
    stop: int
    staged: str | None = None
    first: int = 0
    size: int = 0


@dataclass
class _Ranges(InputPartition):
    """What one task reads, range by range."""

    ranges: list[_Range]


def _newer(archive, folder) -> bool:
    return archive.mtime_ns is not None and folder.mtime_ns is not None and archive.mtime_ns > folder.mtime_ns


class UnsupportedFile(ValueError):
    """A file that cannot be read; its text is the reject reason."""


def srid_of(prj: str | None, nad83_as_wgs84: bool) -> int | None:
    """The reference system a ``.prj`` declares; None if it declares none."""
    text = (prj or "").upper().replace(" ", "_")
    if not text.strip("_"):
        return None
    if text.startswith("PROJ"):
        if "WEB_MERCATOR" in text or "PSEUDO-MERCATOR" in text:
            return 3857
    elif "WGS_1984" in text or "WGS_84" in text or "WGS84" in text:
        return 4326
    elif nad83_as_wgs84 and ("NORTH_AMERICAN_1983" in text or "NAD83" in text):
        return 4326
    raise UnsupportedFile(f"unsupported coordinate system: {(prj or '')[:80]}")


class _Attributes:
    """The attribute table: fixed-width text records after a header."""

    def __init__(self, stream, encoding: str) -> None:
        self.stream, self.encoding = stream, encoding
        head = stream.read(32)
        if len(head) < 32:
            raise UnsupportedFile("attribute table without header")
        self.records, self.begin, self.width = struct.unpack("<IHH", head[4:12])
        rest = stream.read(self.begin - 32)
        self.fields: dict[str, tuple[int, int, str, int]] = {}
        at = 1  # after the deletion mark
        for i in range(0, len(rest) - 31, 32):
            if rest[i] == 0x0D:
                break
            name = rest[i : i + 11].split(b"\0")[0].decode(encoding, "replace")
            length, decimals = rest[i + 16], rest[i + 17]
            self.fields[name] = (at, length, chr(rest[i + 11]), decimals)
            at += length

    def read(self, number: int) -> np.ndarray:
        data = self.stream.read(number * self.width)
        if len(data) < number * self.width:
            raise UnsupportedFile("attribute table is cut off")
        return np.frombuffer(data, np.uint8).reshape(number, self.width)

    def texts(self, rows: np.ndarray, name: str, zero_is_null: bool) -> list[str | None] | pa.Array:
        at, length, kind, decimals = self.fields[name]
        if kind == "C" and rows.size and length and ((plain := rows[:, at : at + length]) >= 0x20).all() and (plain <= 0x7E).all():
            return _plain_texts(plain)
        cells = np.ascontiguousarray(rows[:, at : at + length]).view(f"S{length}").ravel()
        decoded = (c.decode(self.encoding, "replace").strip() for c in cells.tolist())
        if kind == "C":
            return [c or None for c in decoded]
        if kind in "NF":
            return [_number(c, kind == "N" and decimals == 0, zero_is_null) for c in decoded]
        if kind == "D":
            return [f"{c[:4]}-{c[4:6]}-{c[6:8]}" if c.strip("0") else None for c in decoded]
        if kind == "L":
            return [None if c in ("", "?") else str(c in "TtYy") for c in decoded]
        return [c or None for c in decoded]


def _plain_texts(cells: np.ndarray) -> pa.Array:
    """As ``_Attributes.texts`` of printable ASCII, taken together."""
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(cells.shape[1]), len(cells), [None, pa.py_buffer(cells.tobytes())])
    texts = pc.ascii_trim(fixed.cast(pa.binary()).cast(pa.string()), " ")
    return pc.if_else(pc.equal(texts, ""), None, texts)


def _number(text: str, whole: bool, zero_is_null: bool) -> str | None:
    try:
        value = int(text) if whole else float(text)
    except ValueError:
        return None
    return None if zero_is_null and value == 0 else str(value)


def _ring_area(points: np.ndarray) -> float:
    p = points - points[0]
    return float((p[:-1, 0] * p[1:, 1] - p[1:, 0] * p[:-1, 1]).sum())


def _surrounds(ring: np.ndarray, point: np.ndarray) -> bool:
    (ax, ay), (bx, by) = ring[:-1].T, ring[1:].T
    spans = (ay > point[1]) != (by > point[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        return bool((spans & (point[0] < (bx - ax) * (point[1] - ay) / (by - ay) + ax)).sum() % 2)


def polygons_of(content: bytes) -> list[list[np.ndarray]] | None:
    """Polygons (shell first) of one record; None for no shape. Shells turn clockwise in the file,
    holes the other way; a hole belongs to the smallest shell around it, or stands alone."""
    kind = struct.unpack_from("<i", content)[0]
    if kind == _NO_SHAPE:
        return None
    if kind not in _POLYGONS:
        raise UnsupportedFile(f"shape type {kind} is no polygon")
    parts, number = struct.unpack_from("<ii", content, 36)
    starts = [*np.frombuffer(content, "<i4", parts, 44).tolist(), number]
    points = np.frombuffer(content, "<f8", 2 * number, 44 + 4 * parts).reshape(number, 2)
    rings = [points[a:b] for a, b in zip(starts, starts[1:]) if b > a]
    if len(rings) < 2:
        return [rings] if rings else []
    areas = [_ring_area(r) for r in rings]
    shells = [i for i, a in enumerate(areas) if a <= 0] or list(range(len(rings)))
    owned: dict[int, list[np.ndarray]] = {i: [rings[i]] for i in shells}
    for i in range(len(rings)):
        if i not in owned:
            around = [s for s in shells if len(shells) == 1 or _surrounds(rings[s], rings[i][0])]
            if around:
                owned[min(around, key=lambda s: abs(areas[s]))].append(rings[i])
            else:
                owned[i] = [rings[i]]
    return list(owned.values())


def geometry_array(shapes: list[list[list[np.ndarray]] | None]) -> pa.Array:
    """Nested Arrow array (see ``schema.GEOM``) of shapes given as polygons of rings of points."""
    polygons = [p for s in shapes if s for p in s]
    rings = [r for p in polygons for r in p]
    points = np.concatenate([np.zeros((0, 2)), *rings])
    return _nested(points, [len(r) for r in rings], [len(p) for p in polygons], [len(s or ()) for s in shapes], [s is None for s in shapes])


def _nested(points: np.ndarray, rings, polygons, shapes, missing) -> pa.Array:
    """Points in rings, polygons and shapes of the given sizes."""

    def offsets(sizes) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)

    flat = pa.StructArray.from_arrays([pa.array(points[:, 0]), pa.array(points[:, 1])], fields=list(_POINT))
    ring_array = pa.ListArray.from_arrays(pa.array(offsets(rings)), flat)
    polygon_array = pa.ListArray.from_arrays(pa.array(offsets(polygons)), ring_array)
    return pa.ListArray.from_arrays(pa.array(offsets(shapes)), polygon_array, mask=pa.array(missing, pa.bool_()))


def geometries(contents: list[bytes]) -> pa.Array:
    """Nested Arrow array of the shapes of records. Records without shape or of one ring at most are taken together;
    a batch with any other is read record by record."""
    head = np.frombuffer(b"".join(c[:48].ljust(48, b"\0") for c in contents), "<i4").reshape(-1, 12).astype(np.int64)
    kind, parts, number, first = head[:, 0], head[:, 9], head[:, 10], head[:, 11]
    size = np.array([len(c) for c in contents], np.int64)
    missing = (kind == _NO_SHAPE) & (size >= 4)
    whole = np.isin(kind, _POLYGONS) & (number >= 0) & (size >= 44 + 4 * parts + 16 * number)
    empty = whole & ((parts == 0) | ((parts == 1) & (first == 0) & (number == 0)))
    ring = whole & (parts == 1) & (first == 0) & (number > 0)
    if not (missing | empty | ring).all():
        return geometry_array([polygons_of(c) for c in contents])
    data = b"".join(c[48 : 48 + 16 * n] for c, n in zip(contents, np.where(ring, number, 0).tolist()))
    points = np.frombuffer(data, "<f8").reshape(-1, 2)
    return _nested(points, number[ring], np.ones(int(ring.sum()), np.int64), ring.astype(np.int64), missing)


def selected(entries: list, pattern: str) -> list[tuple]:
    """(entry, whether it is an archive) of the folders and archives to read, in reading order."""
    folders = {e.base_name: e for e in entries if not e.is_file}
    archives = {e.base_name.removesuffix(".zip"): e for e in entries if e.is_file and e.base_name.endswith(".zip")}
    found = []
    for entry in entries:
        stem = entry.base_name.removesuffix(".zip")
        archive = entry is archives.get(stem)
        if not (archive or not entry.is_file) or not fnmatch.fnmatchcase(stem, pattern):
            continue
        # an archive replaces a folder of its name that is older, as unpacking it would
        if stem in archives and stem in folders and archive != _newer(archives[stem], folders[stem]):
            continue
        found.append((entry, archive))
    return found


class _Files:
    """The files of the shapefile that a task reads from, open while its pieces follow each other. ``base`` names
    them when they were found to be sound, so a fault is found again, and reported, for each piece."""

    def __init__(self) -> None:
        self.base, self.found, self.held = None, (), ExitStack()

    def opened(self, system, base: str) -> list:
        self.held.close()
        self.base = None
        return [self.held.enter_context(system.open_input_file(base + suffix)) for suffix in (".shp", ".shx", ".dbf")]

    def __enter__(self) -> _Files:
        return self

    def __exit__(self, kind, error, trace) -> None:
        self.held.close()


class ShapefileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "perimeter_shapefile"

    def schema(self) -> str:
        columns = [f"`{c}` string" for c in self.options["columns"].split(",")]
        meta = ["file string", "file_no int", "record_no bigint", "srid int", "error string"]
        return ", ".join([*columns, f"geom {GEOM}", *meta])

    def reader(self, schema) -> DataSourceReader:
        return ShapefileReader(dict(self.options))


class ShapefileReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        options = {k.lower(): v for k, v in options.items()}
        self.root, self.pattern = options["path"], options.get("pattern", "*")
        self.columns = options["columns"].split(",")
        self.aliases = json.loads(options.get("aliases", "{}"))
        wanted = {c: self.aliases.get(c, [c]) for c in self.columns}
        self.names = AliasIndex(wanted, exact=options.get("match", "normalized") == "exact")
        self.fail_fast = options.get("mode", "PERMISSIVE").upper() == "FAILFAST"
        self.nad83 = options.get("nad83_as_wgs84", "true").lower() == "true"
        self.split_bytes = max(1, int(options.get("split_bytes", SPLIT_BYTES)))
        self.staged = options.get("staged") or None
        self.tasks = int(options["tasks"]) if options.get("tasks") else None

    # On the driver: only listings are looked at, never file contents.
    def partitions(self) -> list[_Range] | list[_Ranges]:
        ranges = self._all_ranges()
        if self.tasks is None:
            return ranges
        return [_Ranges(some) for some in packed(ranges, [r.size for r in ranges], self.tasks)]

    def _all_ranges(self) -> list[_Range]:
        system, root = open_fs(self.root)
        ranges: list[_Range] = []
        file_no = 0
        for entry, archive in selected(children(system, root), self.pattern):
            if archive:
                ranges += self._staged_ranges(entry, file_no) or [_Range(entry.path, file_no, 0, -1, size=entry.size or 0)]
                file_no += 1
                continue
            for path, size, records in _shapes_in(children(system, entry.path)):
                ranges += [
                    _Range(path, file_no, a, b, size=size * (b - a) // max(1, records)) for a, b in self._pieces(size, records)]
                file_no += 1
        if file_no > _MOST_FILES or any(r.stop > _MOST_RECORDS for r in ranges):
            raise ValueError(f"{self.root}: record numbers hold {_MOST_FILES} files of {_MOST_RECORDS} records")
        return ranges or [_Range("", 0, 0, 0)]

    def _pieces(self, size: int, records: int) -> list[tuple[int, int]]:
        pieces = max(1, -(-size // self.split_bytes))
        step = max(1, -(-records // pieces))
        return [(a, min(a + step, records)) for a in range(0, max(records, 1), step)]

    def _staged_ranges(self, archive, file_no: int) -> list[_Range]:
        """Ranges of an archive's staged members; none if it was not staged."""
        if not self.staged:
            return []
        system, root = open_fs(self.staged)
        inside = children(system, f"{root}/{archive.base_name}")
        failed = [e.path for e in inside if e.base_name == UNREADABLE]
        if failed:
            return [_Range(archive.path, file_no, 0, 0, failed[0])]
        ranges, first = [], 0
        for path, size, records in _shapes_in(inside):
            ranges += [
                _Range(archive.path, file_no, a, b, path, first, size * (b - a) // max(1, records))
                for a, b in self._pieces(size, records)]
            first += records
        return ranges

    # In a task.
    def read(self, partition: _Range | _Ranges) -> Iterator[pa.RecordBatch]:
        with _Files() as files:
            for one in partition.ranges if isinstance(partition, _Ranges) else [partition]:
                yield from self._read_one(one, files)

    def _read_one(self, partition: _Range, files: _Files) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        try:
            if partition.stop < 0:
                yield from self._read_archive(partition)
            else:
                yield from self._read_range(partition, files)
        except Exception as error:
            if self.fail_fast:
                raise
            yield self._error(partition, f"{type(error).__name__}: {error}")

    def _error(self, partition: _Range, text: str) -> pa.RecordBatch:
        nothing = {c: [None] for c in self.columns}
        return self._batch(nothing, geometry_array([None]), partition, np.array([partition.first + partition.start]), None, text)

    def _batch(self, texts, shapes, partition, record_no, srid, error=None) -> pa.RecordBatch:
        n = len(shapes)
        arrays = [t if isinstance(t := texts[c], pa.Array) else pa.array(t, pa.string()) for c in self.columns]
        arrays += [
            shapes,
            pa.array([partition.path] * n, pa.string()),
            pa.array([partition.file_no] * n, pa.int32()),
            pa.array(record_no, pa.int64()),
            pa.array([srid] * n, pa.int32()),
            pa.array([error] * n, pa.string()),
        ]
        names = [*self.columns, "geom", "file", "file_no", "record_no", "srid", "error"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def _resolve(self, table: _Attributes) -> dict[str, str | None]:
        return self.names.resolve(list(table.fields))

    def _decode(self, table, fields, rows, contents, partition, first, srid) -> pa.RecordBatch:
        alive = np.flatnonzero(rows[:, 0] != ord("*"))
        rows = rows[alive]
        texts = {
            c: [None] * len(rows) if f is None else table.texts(rows, f, c in ID_COLUMNS)
            for c, f in fields.items()
        }
        shapes = geometries([contents[i] for i in alive.tolist()])
        return self._batch(texts, shapes, partition, first + alive, srid)

    def _read_range(self, partition: _Range, files: _Files) -> Iterator[pa.RecordBatch]:
        system, _ = open_fs(self.staged if partition.staged else self.root)
        if partition.staged and partition.staged.endswith(f"/{UNREADABLE}"):
            raise UnsupportedFile(system.open_input_file(partition.staged).read().decode("utf-8", "replace"))
        base = (partition.staged or partition.path)[:-4]

        def text(suffix: str) -> str | None:
            if not system.get_file_info(base + suffix).is_file:
                return None
            return system.open_input_file(base + suffix).read().decode("utf-8", "replace")

        if files.base != base:  # the pieces of a file that share a task lie next to each other
            shp, shx, dbf = files.opened(system, base)
            check_main_header(shp.read(MAIN_HEADER), shp.size())
            table = _Attributes(dbf, _encoding(text(".cpg")))
            total = (shx.size() - MAIN_HEADER) // 8
            if table.records != total or dbf.size() < table.begin + total * table.width:
                raise UnsupportedFile("attribute table and shapes differ in length")
            files.found = (shp, shx, dbf, table, srid_of(text(".prj"), self.nad83), self._resolve(table))
            files.base = base
        shp, shx, dbf, table, srid, fields = files.found
        shx.seek(MAIN_HEADER + 8 * partition.start)
        index = np.frombuffer(shx.read(8 * (partition.stop - partition.start)), ">i4")
        offset, size = index.reshape(-1, 2).astype(np.int64).T * 2
        dbf.seek(table.begin + partition.start * table.width)
        for a, b in _batches(size):
            contents = _contents(shp, offset[a:b], size[a:b])
            rows = table.read(b - a)
            yield self._decode(table, fields, rows, contents, partition, partition.first + partition.start + a, srid)

    def _read_archive(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        system, _ = open_fs(self.root)
        with system.open_input_file(partition.path) as file, zipfile.ZipFile(file) as archive:
            # an archive is expanded into one folder; only that folder's own shapefiles count
            names = {n for n in archive.namelist() if "/" not in n}
            first = 0
            for shape_name in sorted(n for n in names if n.endswith(".shp")):
                base = shape_name[:-4]

                def text(suffix: str) -> str | None:
                    name = base + suffix
                    return archive.read(name).decode("utf-8", "replace") if name in names else None

                srid = srid_of(text(".prj"), self.nad83)
                with archive.open(shape_name) as shp, archive.open(base + ".dbf") as dbf:
                    header = shp.read(MAIN_HEADER)
                    check_main_header(header, archive.getinfo(shape_name).file_size)
                    table = _Attributes(dbf, _encoding(text(".cpg")))
                    fields = self._resolve(table)
                    for contents in _records_of(shp, table.records):
                        rows = table.read(len(contents))
                        yield self._decode(table, fields, rows, contents, partition, first, srid)
                        first += len(contents)


def _shapes_in(inside: list) -> list[tuple[str, int, int]]:
    """(path, bytes, records by the index) of the shapefiles in a folder's listing."""
    sizes = {e.path: e.size for e in inside if e.is_file}
    return [
        (path, size, max(0, (sizes.get(path[:-4] + ".shx", 0) - MAIN_HEADER) // 8))
        for path, size in sizes.items() if path.endswith(".shp")
    ]


def _contents(shp, offset: np.ndarray, size: np.ndarray) -> list[bytes]:
    """The records of a batch. They lie next to each other, so one read gets all of them; only a file that
    scatters them is read record by record."""
    low, high = int(offset.min()), int((offset + 8 + size).max())
    if high - low > 2 * int((size + 8).sum()):
        return [shp.read_at(int(n), int(o) + 8) for o, n in zip(offset, size)]
    span = shp.read_at(high - low, low)
    return [span[o + 8 - low : o + 8 - low + n] for o, n in zip(offset.tolist(), size.tolist())]


def _encoding(cpg: str | None) -> str:
    name = (cpg or "").strip().lower()
    return "utf-8" if name in ("utf-8", "utf8", "65001") else "latin-1"


def check_main_header(header: bytes, size: int) -> None:
    if len(header) < MAIN_HEADER or struct.unpack_from(">i", header)[0] != _FILE_CODE:
        raise UnsupportedFile("not a shapefile")
    if struct.unpack_from(">i", header, 24)[0] * 2 > size:
        raise UnsupportedFile("shapefile is cut off")


def _batches(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of records bounded in number and in bytes."""
    a, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > a and (i - a >= _BATCH_RECORDS or total + size > _BATCH_BYTES):
            yield a, i
            a, total = i, 0
        total += size
    if len(sizes) > a:
        yield a, len(sizes)


def _records_of(member: io.BufferedIOBase, number: int) -> Iterator[list[bytes]]:
    shp = io.BufferedReader(member, _READ_BYTES)  # a member's own reads are slow
    held: list[bytes] = []
    total = 0
    for _ in range(number):
        head = shp.read(8)
        if len(head) < 8:
            raise UnsupportedFile("attribute table and shapes differ in length")
        size = struct.unpack_from(">i", head, 4)[0] * 2
        content = shp.read(size)
        if len(content) < size:
            raise UnsupportedFile("shapefile is cut off")
        if held and (len(held) >= _BATCH_RECORDS or total + size > _BATCH_BYTES):
            yield held
            held, total = [], 0
        held.append(content)
        total += size
    if held:
        yield held
