"""ZIP archives of any size: the central directory is read first, and runs of members are dealt to tasks.

A first job opens each archive at its end, reads the directory alone, and cuts it into runs of about ``RUN`` bytes, which take
their own entries of the directory with them; a second one seeks to the members of each run. So the members of one large
archive are read by many tasks, a directory is read once however many runs it has, and no task holds more than a run's entries,
a member and a batch of rows. Archives are reached through Arrow's file systems, by the paths that Spark's ``binaryFile``
listing gives.
"""

from __future__ import annotations

import io
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

RUN = 64 << 20
BATCH = 8 << 20
ENTRY = "name string, at long, packed long, size long, method int, crc long, flags int"
RUNS = f"path string, first int, last int, bytes long, entries array<struct<{', '.join(f.replace(' ', ':') for f in ENTRY.split(', '))}>>"
#: the fixed part of a member's own header, of which the lengths of its name and of its extra field are read
HEADER = struct.Struct("<4s22xHH")
MEMBERS = "path string, member string, size long, content binary"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI; ``file:/a`` is read as ``file:///a``."""
    return fs.FileSystem.from_uri(re.sub(r"^(\w+):/(?!/)", r"\1:///", path))


class Seekable(io.RawIOBase):
    """An Arrow file as Python's own kind of raw file: a place before its start is an OSError, which ``zipfile`` expects."""

    def __init__(self, source: pa.NativeFile):
        super().__init__()
        self.source, self.length, self.place = source, source.size(), 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.place

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        place = offset + (0, self.place, self.length)[whence]
        if place < 0:
            raise OSError("a place before the file's start")
        self.place = place
        return place

    def readinto(self, buffer) -> int:
        n = max(0, min(len(buffer), self.length - self.place))
        buffer[:n] = self.source.read_at(n, self.place)
        self.place += n
        return n


@contextmanager
def archive_at(path: str) -> Iterator[zipfile.ZipFile]:
    """An archive for reading; only what is asked of it is read."""
    system, name = opened(path)
    with system.open_input_file(name) as source, zipfile.ZipFile(io.BufferedReader(Seekable(source), 1 << 16)) as archive:
        yield archive


def member_name(info: zipfile.ZipInfo) -> str:
    """A member's name; names without the UTF-8 flag are cp949, else UTF-8, else kept."""
    if info.flag_bits & 0x800:
        return info.filename
    raw = info.filename.encode("cp437", "replace")
    for encoding in ("cp949", "utf-8"):
        try:
            return raw.decode(encoding)
        except UnicodeDecodeError:
            continue
    return info.filename


def runs_of(sizes: list[int], run: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, bytes) of consecutive members, each run ending once it holds ``run`` bytes."""
    first = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= run or i == len(sizes) - 1:
            yield first, i + 1, total
            first, total = i + 1, 0


def entry_of(info: zipfile.ZipInfo) -> dict:
    """What reading a member takes of its entry in the directory."""
    return {"name": member_name(info), "at": info.header_offset, "packed": info.compress_size, "size": info.file_size,
            "method": info.compress_type, "crc": info.CRC, "flags": info.flag_bits}


def archive_runs(files: DataFrame, run: int = RUN) -> DataFrame:
    """(path, first, last, bytes, entries): runs of members of the archives that ``files`` (path) lists, with their entries of
    the directory; directories are no members."""
    schema = T._parse_datatype_string(RUNS)

    def read(batches):
        kinds = to_arrow_schema(schema)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with archive_at(path) as archive:
                    infos = archive.infolist()
                for first, last, total in runs_of([0 if i.is_dir() else i.file_size for i in infos], run):
                    row = [path, first, last, total, [entry_of(i) for i in infos[first:last] if not i.is_dir()]]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(row, kinds, strict=True)], schema.names)

    return files.select("path").mapInArrow(read, schema)


def content_of(source: pa.NativeFile, path: str, entry: dict) -> bytes:
    """A member's bytes by its entry. Encrypted ones and rare methods are left to ``zipfile``, by the archive's directory."""
    if entry["flags"] & 1 or entry["method"] not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        with archive_at(path) as archive:
            return archive.read(next(i for i in archive.infolist() if i.header_offset == entry["at"]))
    mark, name, extra = HEADER.unpack(source.read_at(HEADER.size, entry["at"]))
    if mark != b"PK\3\4":
        raise zipfile.BadZipFile(f"{path}: no member at {entry['at']}")
    data = source.read_at(entry["packed"], entry["at"] + HEADER.size + name + extra)
    if entry["method"] == zipfile.ZIP_DEFLATED:
        data = zlib.decompress(data, -zlib.MAX_WBITS)
    if len(data) != entry["size"] or zlib.crc32(data) != entry["crc"]:
        raise zipfile.BadZipFile(f"{path}: {entry['name']} is damaged")
    return data


def split_members(files: DataFrame, run: int = RUN, tasks: int | None = None) -> DataFrame:
    """(path, member, size, content) of all members of the archives that ``files`` (path) lists.

    Runs are dealt to ``tasks`` tasks (the session's shuffle partitions by default): a shuffle of their entries alone.
    """
    spark = files.sparkSession
    spread = archive_runs(files, run).repartition(tasks or int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "first")

    def read(batches):
        for batch in batches:
            for path, entries in zip(batch.column("path").to_pylist(), batch.column("entries"), strict=True):
                rows, held = [], 0
                system, name = opened(path)
                with system.open_input_file(name) as source:
                    for entry in entries.as_py():
                        rows.append((path, entry["name"], entry["size"], content_of(source, path, entry)))
                        held += entry["size"]
                        if held >= BATCH:
                            yield members(rows)
                            rows, held = [], 0
                if rows:
                    yield members(rows)

    return spread.mapInArrow(read, MEMBERS)


def members(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["path", "member", "size", "content"])


def listed(spark: SparkSession, folder: str, pattern: str = "*.zip") -> DataFrame:
    """(path, length) of the archives below a folder; their contents aren't read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return found.select("path", "length")


def write_archives(rows: DataFrame, folder: str, name: str = "name", content: str = "content") -> DataFrame:
    """Write rows as members of ZIP archives, one archive a partition; returns (path, n_members) of the archives.

    An attempt that is lost leaves an archive that the result doesn't name.
    """
    schema = T._parse_datatype_string("path string, n_members long")

    def write(batches):
        buffer, n = io.BytesIO(), 0
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            for batch in batches:
                for member, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    archive.writestr(member, data or b"")
                    n += 1
        if n:
            system, base = opened(folder)
            path = f"{base.rstrip('/')}/{uuid.uuid4().hex}.zip"
            system.create_dir(base, recursive=True)
            with system.open_output_stream(path, compression=None) as out:
                out.write(buffer.getbuffer())
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder.rstrip('/')}/{path.rpartition('/')[2]}"]), pa.array([n])], schema.names)

    return rows.select(F.col(name).cast("string"), F.col(content).cast("binary")).mapInArrow(write, schema)
