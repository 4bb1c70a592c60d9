"""Vector codes: product quantisation in whole numbers.

Components are scaled by ``SCALE`` and rounded down, vectors are cut into equal parts, and each part position has a codebook
of a few entries. Rounds of Lloyd's algorithm move every codebook at once: tasks hold columnar blocks (a row of numbers for
each dimension), squared distances are summed up dimension by dimension, ``np.add.at`` sums the parts of each entry, and the
sums and counts, a few kilobytes a task, meet in a reduction tree (``RDD.treeAggregate``). All of it is 64-bit integer work,
so a result does not depend on how rows are dealt out or in which order they meet. Only codebooks reach the driver.

Vectors are staged once as blocks in the shared folder; each round reads them, so a lost executor costs its tasks alone.

Edge cases: rows whose vector is null or holds a null or a non-finite component are dropped. Repeated rows and ids each count.
The codebooks start from the rows with the smallest ids (rows of equal ids in the order of their vectors, null ids last); with
fewer rows than entries there are as many entries as rows. An entry that no part is nearest to stays. A row whose vector has
another length than the first row's has a null code and null error, and so have all rows if that length can't be cut into the
parts. Blocks with a component of ``SAFE`` or more, scaled, are worked out in Python's unbounded integers; an error beyond 64
bits is null. Ids and labels must be integers.
An empty table gives an empty result and the digest of no numbers. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.shared import hot_keys, modest_batches, spread_join, staged

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Integers below this in absolute value have squares and sums of them in 64 bits, for vectors of up to 2^15 components
SAFE = 1 << 23
DEPTH = 3
BROADCAST_LABELS = 100_000


@dataclass(frozen=True)
class Codebooks:
    """entries[part, entry, dimension of the part]; integers."""

    entries: np.ndarray

    @property
    def digest(self) -> str:
        """SHA-256 of all entries' decimal components, by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x); Python integers where 64 bits don't hold all of its squares' sums."""
    x = x.astype(np.float64)
    if not x.size or np.abs(x).max() < SAFE / SCALE:
        return np.floor(x * SCALE).astype(np.int64)
    exact = [math.floor(v * SCALE) if abs(v) < 2.0**1000 else int(v) * SCALE for v in x.reshape(-1).tolist()]
    return np.array(exact, object).reshape(x.shape)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    limit = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))


BLOCKS = "dims int, n_rows int, ids array<long>, labels array<long>, vectors binary"


def blocks(rows: DataFrame) -> DataFrame:
    """Rows (id, label, vector) in columnar blocks: of vectors of one length, the numbers of each dimension after the other."""
    short = isinstance(rows.schema["vector"].dataType.elementType, T.FloatType)

    def run(batches):
        for batch in batches:
            column = batch.column(2).cast(pa.list_(pa.float32() if short else pa.float64()))
            offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            sizes = np.diff(offsets)
            for dims in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dims)
                table = flat[offsets[own][:, None] + np.arange(dims)]
                columns = [
                    pa.array([dims], pa.int32()), pa.array([len(own)], pa.int32()),
                    *(pa.array([batch.column(k).take(pa.array(own)).to_pylist()], pa.list_(pa.int64())) for k in (0, 1)),
                    pa.array([np.ascontiguousarray(table.T).tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["dims", "n_rows", "ids", "labels", "vectors"])

    return rows.mapInArrow(run, BLOCKS)


def columns_of(dims: int, n_rows: int, vectors: bytes) -> np.ndarray:
    """integers[dimension, row] of a block."""
    kind = np.float32 if len(vectors) == 4 * dims * n_rows else np.float64
    return whole(np.frombuffer(vectors, kind).reshape(dims, n_rows))


def nearest(columns: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) for the columns[dimension, row] of one part."""
    kind = np.int64 if columns.dtype == entries.dtype == np.int64 else object
    distance = np.zeros((columns.shape[1], len(entries)), kind)
    for own, theirs in zip(columns, entries.T, strict=True):
        gap = own[:, None] - theirs[None, :]
        distance += gap * gap
    best = distance.argmin(1)  # the first of equal ones
    return best, distance[np.arange(len(best)), best]


def add_block(total: tuple[np.ndarray, np.ndarray] | None, block: tuple[int, int, bytes], books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums[part, entry, dimension] and counts[part, entry] with those of a block."""
    parts, entries, width = books.shape
    columns = columns_of(*block)
    sums, counts = total or (np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64))
    if columns.dtype != sums.dtype:
        sums = sums.astype(object)
    for p in range(parts):
        own = columns[p * width : (p + 1) * width]
        best, _ = nearest(own, books[p])
        np.add.at(sums[p], best, own.T)
        np.add.at(counts[p], best, 1)
    return sums, counts


def moved(books: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each entry at floor(sum / count) of its parts; unused ones stay."""
    used = counts > 0
    out = books.astype(object) if sums.dtype == object else books.copy()
    out[used] = sums[used] // counts[used][:, None]
    return out


def first_codebooks(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """books[part, entry, dimension] from the rows (id, label, vector) with the smallest ids; None if there is nothing to code."""
    order = [F.col("id").asc_nulls_last(), F.col("vector")]
    smallest = rows.select("id", "vector").orderBy(*order)
    got = smallest.limit(entries).collect()
    dims = len(got[0]["vector"]) if got else 0
    if not dims or dims % parts:
        return None
    if any(len(r["vector"]) != dims for r in got):
        got = smallest.filter(F.size("vector") == dims).limit(entries).collect()
    return whole(np.array([r["vector"] for r in got], np.float64)).reshape(len(got), parts, dims // parts).swapaxes(0, 1)


def train(staged_blocks: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """The codebooks after so many rounds over all blocks."""
    spark, dims = staged_blocks.sparkSession, books.shape[0] * books.shape[2]
    held = staged_blocks.filter(F.col("dims") == dims).select("dims", "n_rows", "vectors").rdd.map(lambda r: (r[0], r[1], bytes(r[2])))

    def merge(a, b):
        if a is None or b is None:
            return a if b is None else b
        return a[0] + b[0], a[1] + b[1]

    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        found = held.treeAggregate(None, lambda total, block, at=shared: add_block(total, block, at.value), merge, DEPTH)
        books = moved(books, *found) if found else books
        shared.unpersist()
    return books


CODES = "id long, label long, code string, error long"


def assign(staged_blocks: DataFrame, books: np.ndarray | None) -> DataFrame:
    """(id, label, code, error) of every row."""
    dims = 0 if books is None else books.shape[0] * books.shape[2]
    hexes = np.array([f"{i:02x}" for i in range(max(256, 0 if books is None else books.shape[1]))])

    def run(batches):
        for batch in batches:
            for size, n_rows, ids, labels, vectors in zip(*batch.columns, strict=True):
                n = n_rows.as_py()
                code, error = [None] * n, [None] * n
                if books is not None and size.as_py() == dims:
                    columns, width = columns_of(dims, n, vectors.as_py()), books.shape[2]
                    got = [nearest(columns[p * width : (p + 1) * width], books[p]) for p in range(len(books))]
                    code = ["".join(c) for c in zip(*(hexes[best].tolist() for best, _ in got), strict=True)]
                    error = [e if e < 1 << 63 else None for e in sum(d for _, d in got).tolist()]
                arrays = [ids.values, labels.values, pa.array(code, pa.string()), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "label", "code", "error"])

    return staged_blocks.mapInArrow(run, CODES)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Each row with the errors of all rows of its label summed; rows without a label are one group."""
    key = F.struct(F.coalesce("label", F.lit(0)).alias("value"), F.col("label").isNull().alias("none"))
    rows = staged(coded.withColumn("key", key), "codes")
    # try_sum: a sum beyond 64 bits is null
    sums = rows.groupBy("key").agg(F.try_sum("error").alias("label_error"))
    if sums.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        return rows.join(F.broadcast(sums), "key").drop("key")
    return spread_join(rows, sums, ["key"], F.col("id"), hot_keys(rows, ["key"])).drop("key")


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS,
    entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """((id, label, code, error, label_error) of every usable row, the codebooks)."""
    modest_batches(vectors.sparkSession)
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    for name in (id_col, label_col):
        if not isinstance(vectors.schema[name].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            raise ValueError(f"{name} must be an integer column")
    chosen = [F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("vector")]
    rows = vectors.select(*chosen).filter(usable(F.col("vector")))
    books = first_codebooks(rows, parts, entries)
    held = staged(blocks(rows), "vector-blocks")
    if books is not None:
        books = train(held, books, rounds)
    coded = with_label_errors(assign(held, books))
    return coded, Codebooks(books if books is not None else np.zeros(0, np.int64))


def decode(codes: DataFrame, books: Codebooks, code_col: str = "code", vector_col: str = "vector") -> DataFrame:
    """``codes`` with the vector that each code stands for, in the input's scale; built-in functions over a literal table."""
    parts, _, width = books.entries.shape
    table = F.array(*(F.array(*(F.array(*(F.lit(float(x) / SCALE) for x in entry)) for entry in part)) for part in books.entries.tolist()))
    entry = lambda p: F.conv(F.substring(F.col(code_col), 2 * p + 1, 2), 16, 10).cast("int")
    return codes.withColumn(vector_col, F.concat(*(F.get(F.get(table, F.lit(p)), entry(p)) for p in range(parts))))
