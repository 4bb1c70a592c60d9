"""A vector index in cells: k-means cells are partitions of a stored table, and a search reads just the cells nearest to it.

The centres are fitted to a sample of ``SAMPLE`` vectors (chosen by a hash, so the bound holds in expectation for any input);
every vector is then put into the cell of its nearest centre. A search ranks the centres, reads the nearest ``probes``
cells and ranks their vectors exactly. Where filters leave fewer rows than asked for, it goes on to twice as many cells,
up to all of them; ``exact`` reads all of them at once. Cells of any size are read by as many tasks as their files fill.

Null vectors and those without length have no neighbours and stand in no cell.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.similarity import cosine, dot
from corpusloom.operators.snapshots import Part, State, Store, Table

SAMPLE = 20_000
PROBES = 8
#: queries of a block, and how many of them meet how many rows in one product
ASKED_A_BLOCK, ASKED_AT_ONCE, ROWS_AT_ONCE = 4096, 512, 4096
#: more than a cosine by a product of matrices and one summed from left to right can differ
CLOSE = 1e-9


def _usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector has a length, with it scaled to one as ``_unit``."""
    sized = vectors.withColumn("_size", F.sqrt(dot(F.col(column), F.col(column)))).filter("_size > 0 and _size < double('infinity')")
    unit = F.transform(column, lambda x: x.cast("double") / F.col("_size"))
    return sized.withColumn("_unit", array_to_vector(unit)).drop("_size")


def cells_for(rows: int) -> int:
    """How many cells: the square root of the rows, 4096 at most."""
    return max(1, min(4096, round(rows**0.5)))


def in_cells(vectors: DataFrame, key: str, column: str = "embedding", cells: int | None = None, sample: int = SAMPLE, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """(rows with their ``cell``, centres (cell, centre)); centres of equal vectors fall together, so there may be fewer cells."""
    usable = _usable(vectors, column)
    n = usable.count()
    share = min(1.0, sample / max(1, n))
    chosen = usable.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    if not n or chosen.limit(1).count() == 0:
        raise ValueError("there are no vectors to fit cells to")
    fitted = KMeans(k=max(2, cells or cells_for(n)), featuresCol="_unit", predictionCol="cell", distanceMeasure="cosine", seed=seed, maxIter=10).fit(chosen)
    spark = vectors.sparkSession
    centres = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(fitted.clusterCenters())], "cell int, centre array<double>")
    return fitted.transform(usable).drop("_unit"), centres


def built(store: Store, name: str, vectors: DataFrame, key: str, column: str = "embedding", cells: int | None = None) -> dict[str, Table]:
    """The index's tables, to be committed: vectors by cell, and centres."""
    placed, centres = in_cells(vectors, key, column, cells)
    return {f"{name}_cells": store.write(placed, "cell"), f"{name}_centres": store.write(centres)}


def nearest_cells(centres: DataFrame, query: list[float]) -> list[int]:
    """All cells, the nearest to the query first; centres are as many as cells, 4096 at most by default."""
    vector = F.array(*(F.lit(float(x)) for x in query))
    return [r["cell"] for r in centres.select("cell", cosine(F.col("centre"), vector).alias("c")).orderBy(F.desc("c"), "cell").collect()]


def search(
    store: Store, name: str, query: list[float], limit: int, key: str, column: str = "embedding", probes: int | None = None, exact: bool = False,
    allowed: DataFrame | None = None, state: State | None = None,
) -> DataFrame:
    """(key, cosine) of the ``limit`` nearest rows in the probed cells; ``allowed`` holds the keys that pass the filters.

    Cells are added until ``limit`` rows are found, so a filter that few rows pass ends with an exact search.
    """
    state = state or store.state()
    table = state.tables[f"{name}_cells"]
    order = nearest_cells(store.rows(state.tables[f"{name}_centres"]), query)
    vector = F.array(*(F.lit(float(x)) for x in query))
    by_cell: dict[object, list[Part]] = {}
    for part in table.parts:
        by_cell.setdefault(part.value, []).append(part)
    held = [c for c in order if c in by_cell]
    at = len(held) if exact else max(1, probes or state.marks.get(f"{name}:probes", PROBES))
    while True:
        rows = store.rows(table, tuple(p for c in held[:at] for p in by_cell[c]))
        rows = rows if allowed is None else rows.join(allowed.select(key).distinct(), key, "left_semi")
        found = rows.select(key, cosine(F.col(column), vector).alias("cosine")).orderBy(F.desc("cosine"), key).limit(limit)
        if at >= len(held) or found.count() >= limit:
            return found
        at *= 2


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of doubles; NaN where one is null or of another length."""
    rows = [v if v is not None and len(v) == width else [None] * width for v in vectors.to_pylist()]
    return np.array(rows, np.float64).reshape(len(rows), width)


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products summed along the last axis from left to right, as ``dot`` does; the other axes are broadcast."""
    out = 0.0 + a[..., 0] * b[..., 0] if a.shape[-1] else np.zeros(np.broadcast_shapes(a.shape[:-1], b.shape[:-1]))
    for k in range(1, a.shape[-1]):
        out = out + a[..., k] * b[..., k]
    return out


class _Asked:
    """A block of queries, and of each the scores of the best rows met so far."""

    def __init__(self, keys: pa.Array, vectors: pa.Array, limit: int, width: int):
        self.keys, self.limit, self.vectors = keys, limit, _matrix(vectors, width)
        self.sizes = np.sqrt(_dots(self.vectors, self.vectors))
        # a query without a length is as near to one row as to another
        odd = ~((self.sizes > 0) & np.isfinite(self.sizes))
        self.vectors[odd], self.sizes[odd] = 0.0, 1.0
        self.units = self.vectors / self.sizes[:, None]
        self.best = np.full((len(keys), limit), -np.inf)

    def met(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, cosine) of the rows, in the order of their keys, that may be among a query's nearest.

        A product of matrices says which come near a query's best; their cosines are then summed as the exact search does.
        """
        sizes = np.sqrt(_dots(rows, rows))
        found = []
        for lo in range(0, len(self.keys), ASKED_AT_ONCE):
            hi = min(lo + ASKED_AT_ONCE, len(self.keys))
            near = self.units[lo:hi] @ (rows / sizes[:, None]).T
            least = self.best[lo:hi, 0]
            if near.shape[1] > self.limit:
                least = np.maximum(least, np.partition(near, -self.limit, axis=1)[:, -self.limit])
            query, row = np.nonzero(near >= (least - CLOSE)[:, None])
            query += lo
            cosine_ = np.zeros(len(query))
            for k in range(rows.shape[1]):
                cosine_ += self.vectors[query, k] * rows[row, k]
            cosine_ /= sizes[row] * self.sizes[query]
            order = np.lexsort((row, -cosine_, query))
            query, row, cosine_ = query[order], row[order], cosine_[order]
            first = np.searchsorted(query, np.arange(lo, hi))
            place = np.arange(len(query)) - first[query - lo]
            kept = (place < self.limit) & (cosine_ >= self.best[query, 0])
            query, row, cosine_, place = query[kept], row[kept], cosine_[kept], place[kept]
            mine = np.full((hi - lo, self.limit), -np.inf)
            mine[query - lo, place] = cosine_
            self.best[lo:hi] = np.sort(np.concatenate((self.best[lo:hi], mine), axis=1), axis=1)[:, self.limit :]
            found.append((query, row, cosine_))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _same(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows that agree in their first three columns."""
    marks = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:3]])
    cuts = np.flatnonzero(np.any(marks[:, 1:] != marks[:, :-1], axis=0)) + 1
    for lo, hi in pairwise([0, *cuts.tolist(), batch.num_rows]):
        yield batch.slice(lo, hi - lo)


def near_rows(rows: DataFrame, asked: DataFrame, key: str, limit: int, column: str) -> DataFrame:
    """(asked, key, cell, cosine) of rows among which are all of a query's ``limit`` nearest.

    Queries are dealt into blocks, rows into parts, and each task takes a block and a part: it holds the block's queries, and
    the rows go by, of which each query gives on those that are no farther than the nearest that the task has met.
    """
    spark = rows.sparkSession
    blocks = max(1, -(-asked.count() // ASKED_A_BLOCK))
    parts = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // blocks))
    number = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    hashed = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    mine = asked.select(hashed("asked", blocks).alias("block"), number(parts).alias("part"), F.lit(0).alias("side"),
                        F.col("asked").alias("key"), F.lit(None).cast("int").alias("cell"), F.col("_query").alias("vector"))
    theirs = rows.select(number(blocks).alias("block"), hashed(key, parts).alias("part"), F.lit(1).alias("side"),
                         F.col(key).alias("key"), F.col("cell").cast("int"), F.col(column).alias("vector"))
    dealt = mine.unionByName(theirs).repartition(blocks * parts, "block", "part").sortWithinPartitions("block", "part", "side")

    def run(batches):
        held, block, waiting = None, None, []
        for batch in batches:
            for same in _same(batch):
                at = tuple(c[0].as_py() for c in same.columns[:3])
                if at[:2] != block:
                    held, block, waiting = None, at[:2], []
                if not at[2]:
                    waiting.append(same)
                    continue
                if not waiting:
                    continue  # a block without queries
                for lo in range(0, same.num_rows, ROWS_AT_ONCE):
                    some = same.slice(lo, ROWS_AT_ONCE)
                    some = some.take(pc.sort_indices(some.column(3)))
                    width = len(some.column(5)[0])
                    if held is None:
                        whole = pa.Table.from_batches(waiting).combine_chunks()
                        held = _Asked(whole["key"].combine_chunks(), whole["vector"].combine_chunks(), limit, width)
                    query, row, near = held.met(_matrix(some.column(5), width))
                    columns = [held.keys.take(pa.array(query)), some.column(3).take(pa.array(row)), some.column(4).take(pa.array(row)), pa.array(near)]
                    yield pa.RecordBatch.from_arrays(columns, ["asked", "key", "cell", "cosine"])

    kind = rows.schema[key].dataType.simpleString()
    return dealt.mapInArrow(run, f"asked {asked.schema['asked'].dataType.simpleString()}, key {kind}, cell int, cosine double")


def _places(cosines: np.ndarray, at: int) -> int:
    """The place, from 1, of a cell in the order of falling cosines, then of cells."""
    return 1 + int(np.count_nonzero(cosines > cosines[at])) + int(np.count_nonzero(cosines[:at] == cosines[at]))


def cell_ranks(store: Store, state: State, name: str, queries: DataFrame, key: str, limit: int, column: str = "embedding") -> DataFrame:
    """(asked, rank): for each of a query's exact neighbours, which place its cell has among the cells nearest to the query.

    A stated set of queries against all rows, by blocks of either (``near_rows``); the centres, 4096 at most by default, go
    to all tasks.
    """
    asked = queries.select(F.col(key).alias("asked"), F.col(column).alias("_query")).filter("_query is not null")
    near = near_rows(store.rows(state.tables[f"{name}_cells"]), asked, key, limit, column)
    best = Window.partitionBy("asked").orderBy(F.desc("cosine"), "key")
    top = near.withColumn("_place", F.row_number().over(best)).filter(F.col("_place") <= limit)
    cells = top.groupBy("asked").agg(F.collect_list("cell").alias("cells"))
    centres = sorted((r["cell"], r["centre"]) for r in store.rows(state.tables[f"{name}_centres"]).collect())
    numbers = {cell: i for i, (cell, _) in enumerate(centres)}
    table = np.array([c for _, c in centres], np.float64)

    def run(batches):
        sizes = np.sqrt(_dots(table, table))
        for batch in batches:
            at, ranks = [], []
            vectors = _matrix(batch.column(1), table.shape[1])
            for i, (vector, own) in enumerate(zip(vectors, batch.column(2).to_pylist(), strict=True)):
                size = sizes * np.sqrt(_dots(vector, vector))
                with np.errstate(invalid="ignore", divide="ignore"):
                    near = np.where(size > 0, _dots(table, vector[None, :]) / size, -np.inf)
                near = np.where(np.isnan(near), np.inf, near)
                at += [i] * len(own)
                ranks += [_places(near, numbers[cell]) for cell in own]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(ranks, pa.int32())], ["asked", "rank"])

    return asked.join(cells, "asked").mapInArrow(run, f"asked {asked.schema['asked'].dataType.simpleString()}, rank int")


def probes_for(ranks: DataFrame, target: float) -> int:
    """The fewest probes with which ``target`` of the neighbours are found (a histogram of as many rows as cells is collected)."""
    counts = sorted((r["rank"], r["count"]) for r in ranks.groupBy("rank").count().collect())
    total, found = sum(n for _, n in counts), 0
    for rank, n in counts:
        found += n
        if found >= target * total:
            return rank
    return PROBES


def tuned(store: Store, name: str, queries: DataFrame, key: str, limit: int = 10, target: float = 0.95, column: str = "embedding") -> State:
    """Measure how many cells a search must probe to find ``target`` of the exact neighbours of some queries, and keep that
    number with the index: searches that name no number of probes take it."""
    state = store.state()
    probes = probes_for(cell_ranks(store, state, name, queries, key, limit, column), target)
    return store.commit(state, {}, {f"{name}:probes": probes})
