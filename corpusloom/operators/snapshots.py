"""Tables as snapshots: immutable data folders, and one manifest that names those of all tables.

A writer puts new data into folders of its own and then renames one small manifest into place, for all the tables that it
changes. Until then readers see the state before, and a writer that is killed leaves folders that no manifest names. A
manifest's name is its version and the rename fails where that version is there already, so of two writers one has to start
again from the other's state. Versions stay until ``retain`` drops them.

A table may be partitioned by a column: the manifest says which folder holds which value, so values are never made into
paths, null is a value like others, and a replacement rewrites just the partitions that hold one of its keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_PARTITIONS = 10_000
DIGITS = 20


class Conflict(RuntimeError):
    """Another writer has made the version that this one wanted to make."""


@dataclass(frozen=True)
class Part:
    """A folder of rows; ``value`` of the partition column if the table has one."""

    folder: str
    value: object = None


@dataclass(frozen=True)
class Table:
    """A table's state: schema as JSON, partition column, parts."""

    schema: str
    partition: str | None = None
    parts: tuple[Part, ...] = ()

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class State:
    """All tables at a version; ``marks`` are values that writers keep with it, such as the last batch of a stream."""

    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    marks: dict[str, object] = field(default_factory=dict)

    def json(self) -> str:
        tables = {
            name: {"schema": t.schema, "partition": t.partition, "parts": [[p.folder, p.value] for p in t.parts]}
            for name, t in self.tables.items()
        }
        return json.dumps({"tables": tables, "marks": self.marks})

    @staticmethod
    def of(version: int, text: str) -> State:
        got = json.loads(text)
        tables = {n: Table(t["schema"], t["partition"], tuple(Part(*p) for p in t["parts"])) for n, t in got["tables"].items()}
        return State(version, tables, got["marks"])


class Store:
    """Snapshot tables below one root, in any file system that Hadoop reaches."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._system = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def versions(self) -> list[int]:
        """The versions that are there, ascending."""
        folder = self._path("manifests")
        if not self._system.exists(folder):
            return []
        names = (f.getPath().getName() for f in self._system.listStatus(folder))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def state(self, version: int | None = None) -> State:
        """A version's state, the latest by default; no tables before the first."""
        if version is None:
            there = self.versions()
            if not there:
                return State()
            version = there[-1]
        stream = self._system.open(self._path(f"manifests/{version:0{DIGITS}d}.json"))
        try:
            return State.of(version, self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def rows(self, table: Table, parts: tuple[Part, ...] | None = None) -> DataFrame:
        """The rows of a table, or of some of its parts."""
        folders = [f"{self.root}/{p.folder}" for p in (table.parts if parts is None else parts)]
        if not folders:
            return self.spark.createDataFrame([], table.struct)
        return self.spark.read.schema(table.struct).parquet(*folders)

    def read(self, name: str, version: int | None = None, values: list | None = None) -> DataFrame:
        """A table at a version; with ``values`` only the partitions of those values are looked at."""
        table = self.state(version).tables[name]
        return self.rows(table, None if values is None else tuple(p for p in table.parts if p.value in values))

    def write(self, rows: DataFrame, partition: str | None = None) -> Table:
        """Put rows into new folders; no reader sees them before ``commit``."""
        schema, folder = rows.schema.json(), f"data/{uuid.uuid4().hex}"
        if partition is None:
            rows.write.parquet(f"{self.root}/{folder}")
            return Table(schema, None, (Part(folder),))
        # folders are named by the values' numbers; the column itself stays in the files
        values = [r[0] for r in rows.select(partition).distinct().orderBy(partition).limit(MOST_PARTITIONS + 1).collect()]
        if len(values) > MOST_PARTITIONS:
            raise ValueError(f"{partition} has more than {MOST_PARTITIONS} values")
        if not values:
            return Table(schema, partition)
        numbers = self.spark.createDataFrame(
            list(enumerate(values)), T.StructType([T.StructField("_number", T.IntegerType()), T.StructField("_value", rows.schema[partition].dataType)])
        )
        placed = rows.join(F.broadcast(numbers), F.col(partition).eqNullSafe(F.col("_value"))).select(*rows.columns, "_number")
        placed.write.partitionBy("_number").parquet(f"{self.root}/{folder}")
        return Table(schema, partition, tuple(Part(f"{folder}/_number={k}", v) for k, v in enumerate(values)))

    def commit(self, base: State, tables: dict[str, Table], marks: dict[str, object] | None = None) -> State:
        """Make ``base`` with the given tables and marks the next version; raises Conflict if another writer was first."""
        state = State(base.version + 1, {**base.tables, **tables}, {**base.marks, **(marks or {})})
        fs = self._jvm.org.apache.hadoop.fs
        aside, target = self._path(f"manifests/.{uuid.uuid4().hex}"), self._path(f"manifests/{state.version:0{DIGITS}d}.json")
        if base.version != (self.versions() or [0])[-1]:
            raise Conflict(f"version {base.version} of {self.root} isn't the latest")
        out = self._system.create(aside, False)
        out.write(bytearray(state.json().encode()))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(fs.Options.Rename, 0)
        try:
            fs.FileContext.getFileContext(self._system.getUri(), self._conf).rename(aside, target, none)
        except Exception as error:
            self._system.delete(aside, False)
            if self._system.exists(target):
                raise Conflict(f"version {state.version} of {self.root} is there already") from error
            raise
        return state

    def overwrite(self, tables: dict[str, DataFrame], partition: dict[str, str] | None = None) -> State:
        """Write tables anew, all of them visible at once."""
        base = self.state()
        return self.commit(base, {n: self.write(rows, (partition or {}).get(n)) for n, rows in tables.items()})

    def replaced(self, table: Table, delta: DataFrame, key: str, gone: DataFrame | None = None) -> Table:
        """``table`` with the rows of the delta's keys (and of those in ``gone``) taken out wherever they stand, and the delta put in.

        Partitions without such a key and without a row of the delta keep their folders. The delta should be a stored table.
        """
        keys = delta.select(key) if gone is None else delta.select(key).unionByName(gone.select(key))
        keys = keys.distinct()
        delta = delta.select(*table.struct.names)
        # keys may be null: null-safe on either side
        met = lambda rows: rows.join(keys.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key")), "left_semi")
        rest = lambda rows: rows.join(keys.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key")), "left_anti")
        if table.partition is None:
            return self.write(rest(self.rows(table)).unionByName(delta))
        touched = {r[0] for frame in (met(self.rows(table)), delta) for r in frame.select(table.partition).distinct().collect()}
        old = tuple(p for p in table.parts if p.value in touched)
        new = self.write(rest(self.rows(table, old)).unionByName(delta), table.partition)
        return Table(table.schema, table.partition, tuple(p for p in table.parts if p.value not in touched) + new.parts)

    def appended(self, table: Table | None, rows: DataFrame) -> Table:
        """``table`` and more rows in a folder of their own."""
        new = self.write(rows, table.partition if table else None)
        return Table(new.schema, new.partition, (table.parts if table else ()) + new.parts)

    def again(self, change: Callable[[State], tuple[dict[str, Table], dict[str, object]]], tries: int = 5) -> State:
        """Commit what ``change`` makes of the latest state; once more from the new state where another writer was first."""
        for left in reversed(range(tries)):
            base = self.state()
            try:
                return self.commit(base, *change(base))
            except Conflict:
                if not left:
                    raise
        raise AssertionError("unreachable")

    def discard(self, table: Table) -> None:
        """Drop the folders of a table that was written and not committed."""
        for part in table.parts:
            self._system.delete(self._path(part.folder), True)

    def retain(self, versions: int) -> None:
        """Drop all but the last versions, and every data folder that none of those names. No writer may be at work."""
        there = self.versions()
        kept = [self.state(v) for v in there[-versions:]]
        named = {p.folder.split("/")[1] for s in kept for t in s.tables.values() for p in t.parts}
        for version in there[:-versions]:
            self._system.delete(self._path(f"manifests/{version:0{DIGITS}d}.json"), False)
        if self._system.exists(self._path("data")):
            for folder in self._system.listStatus(self._path("data")):
                if folder.getPath().getName() not in named:
                    self._system.delete(folder.getPath(), True)
