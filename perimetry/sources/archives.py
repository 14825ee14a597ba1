"""Staging of large shapefile archives, so that many tasks can read one.

A compressed member can only be inflated from its start, but records of an inflated one can be read from any
place. So a first job copies the members of each large archive to the shared scratch folder, one task per
member (small neighbours share one) and in pieces of bounded size; a second one, the shapefile reader, splits the copies by record ranges.

A copied ``.shp`` gets an index made from its own record headers on the way, so archives need none. Copies are
renamed into place when they are whole: a task that runs again writes the same files. What is wrong with an
archive is noted in its folder, and the reader reports it as that file's error.
"""

from __future__ import annotations

import json
import lzma
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from contextlib import ExitStack
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from perimetry.plans.storage import scratch_path
from perimetry.sources.files import children, open_fs, packed, wanted_tasks
from perimetry.sources.shapefile import MAIN_HEADER, UNREADABLE, UnsupportedFile, check_main_header, selected

_COPY_BYTES = 8 << 20
# What an archive itself can be at fault for: cut off, damaged, encrypted, packed in an unknown way.
_BROKEN = (UnsupportedFile, zipfile.BadZipFile, NotImplementedError, EOFError, RuntimeError, zlib.error, lzma.LZMAError)
_MEMBERS = (".shp", ".dbf", ".prj", ".cpg")  # an own index replaces the archive's


@dataclass
class _Member(InputPartition):
    """A member to copy; or, without one, an archive that cannot be listed."""

    archive: str
    folder: str
    member: str | None
    error: str | None = None
    size: int = 0


@dataclass
class _Members(InputPartition):
    """What one task copies, member by member."""

    members: list[_Member]


def large_archives(root: str, patterns: Sequence[str], larger_than: int) -> list[fs.FileInfo]:
    """The archives that the reader would read for any of the patterns and that are larger."""
    system, folder = open_fs(root)
    entries = children(system, folder)
    found = {e.path: e for p in patterns for e, archive in selected(entries, p) if archive and e.size > larger_than}
    return list(found.values())


def stage(spark: SparkSession, raw_dir: str, patterns: Sequence[str], larger_than: int) -> str | None:
    """Copy the members of the archives above ``larger_than`` bytes to a scratch folder, the reader's option
    ``staged``. None if there are no such archives. ``plans.storage.discard`` deletes it after reading."""
    if not large_archives(raw_dir, patterns, larger_than):
        return None
    target = scratch_path(spark, "archives")
    spark.dataSource.register(ArchiveMembers)
    members = spark.read.format(ArchiveMembers.name()).options(
        path=raw_dir, patterns=json.dumps(list(patterns)), larger_than=str(larger_than), target=target,
        tasks=str(wanted_tasks(spark)),
    )
    members.load().write.format("noop").mode("overwrite").save()
    return target


class ArchiveMembers(DataSource):
    """Reading it copies the members; it gives one row for each."""

    @classmethod
    def name(cls) -> str:
        return "perimeter_archive_members"

    def schema(self) -> str:
        return "archive string, member string, bytes bigint, error string"

    def reader(self, schema) -> DataSourceReader:
        return MembersReader(dict(self.options))


class MembersReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        options = {k.lower(): v for k, v in options.items()}
        self.root, self.target = options["path"], options["target"]
        self.patterns, self.larger_than = json.loads(options["patterns"]), int(options["larger_than"])
        self.tasks = int(options["tasks"])

    # On the driver: of each large archive only the directory at its end is read.
    def partitions(self) -> list[_Members]:
        system, _ = open_fs(self.root)
        found: list[_Member] = []
        for entry in large_archives(self.root, self.patterns, self.larger_than):
            try:
                with system.open_input_file(entry.path) as file, zipfile.ZipFile(file) as archive:
                    # an archive is expanded into one folder; only that folder's own shapefiles count
                    sizes = {i.filename: i.file_size for i in archive.infolist() if "/" not in i.filename and i.filename.endswith(_MEMBERS)}
                found += [_Member(entry.path, entry.base_name, n, size=sizes[n]) for n in sorted(sizes)]
            except Exception as error:
                found.append(_Member(entry.path, entry.base_name, None, f"{type(error).__name__}: {error}"))
        groups = packed(found, [m.size for m in found], self.tasks)
        return [_Members(some) for some in groups] or [_Members([])]

    # In a task.
    def read(self, partition: _Members) -> Iterator[pa.RecordBatch]:
        for member in partition.members:
            yield self._staged(member)

    def _staged(self, partition: _Member) -> pa.RecordBatch:
        system, root = open_fs(self.target)
        folder = f"{root}/{partition.folder}"
        system.create_dir(folder, recursive=True)
        size, error = 0, partition.error
        if error is None:
            try:
                size = self._copy(partition, system, folder)
            except _BROKEN as wrong:  # those of the storage fail the task
                error = f"{type(wrong).__name__}: {wrong}"
        if error is not None:
            with _placed(system, f"{folder}/{UNREADABLE}") as out:
                out.write(error.encode())
        row = ([partition.archive], [partition.member], [size], [error])
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(row, kinds)], names=["archive", "member", "bytes", "error"])

    def _copy(self, partition: _Member, target: fs.FileSystem, folder: str) -> int:
        system, _ = open_fs(self.root)
        with ExitStack() as held:
            file = held.enter_context(system.open_input_file(partition.archive))
            archive = held.enter_context(zipfile.ZipFile(file))
            info = archive.getinfo(partition.member)
            member = held.enter_context(archive.open(info))
            out = held.enter_context(_placed(target, f"{folder}/{partition.member}"))
            if partition.member.endswith(".shp"):
                index = held.enter_context(_placed(target, f"{folder}/{partition.member[:-4]}.shx"))
                copy_shapes(member, out, index, info.file_size)
            else:
                _copy_bytes(member, out, info.file_size)
            return info.file_size


class _placed:
    """An output stream whose file appears under its name only when it is whole."""

    def __init__(self, system: fs.FileSystem, path: str) -> None:
        self.system, self.path = system, path
        self.part = f"{path}.{uuid.uuid4().hex}.part"

    def __enter__(self):
        self.stream = self.system.open_output_stream(self.part, buffer_size=1 << 20)
        return self.stream

    def __exit__(self, kind, error, trace) -> None:
        self.stream.close()
        if kind is None:
            self.system.move(self.part, self.path)
        else:
            self.system.delete_file(self.part)


def _copy_bytes(source, out, number: int) -> None:
    while number > 0:
        piece = source.read(min(number, _COPY_BYTES))
        if not piece:
            raise UnsupportedFile("archive is cut off")
        out.write(piece)
        number -= len(piece)


def copy_shapes(source, out, index, size: int) -> None:
    """Copy a ``.shp`` of ``size`` bytes record by record and write (offset, length) of each, in words of two
    bytes, behind a copy of its header. Bytes behind the length that the header declares are left out."""
    header = source.read(MAIN_HEADER)
    check_main_header(header, size)
    out.write(header)
    index.write(header)
    end = 2 * struct.unpack_from(">i", header, 24)[0]
    at = MAIN_HEADER
    while at < end:
        head = source.read(8)
        if len(head) < 8:
            raise UnsupportedFile("shapefile is cut off")
        words = struct.unpack_from(">i", head, 4)[0]
        if words < 2 or at + 8 + 2 * words > end:
            raise UnsupportedFile("record is longer than its file")
        out.write(head)
        _copy_bytes(source, out, 2 * words)
        index.write(struct.pack(">ii", at // 2, words))
        at += 8 + 2 * words
