"""A stored trigram index over titles, kept up to date by generations.

Postings (gram, n, id, generation) say which rows' texts hold a trigram, and how many distinct ones each text has. They are
written in ranges of (gram, n, id), so a search reads the row groups of its keyword's trigrams, within the lengths that can
reach the threshold, and no text. A common trigram's postings lie in many ranges.

A delta adds a generation of postings, and tombstones (id, generation) for the ids that it takes away: a posting counts unless
its id has a tombstone of a later generation. ``merged`` writes what counts as one generation again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.similarity import THRESHOLD, keyword_trigrams, trigrams
from corpusloom.operators.snapshots import State, Store, Table

#: generations that a search meets before the next delta merges them
MOST_GENERATIONS = 8


def cut_texts(rows: DataFrame, texts: list[str], key: str = "id") -> DataFrame:
    """(id, field, grams) of each row's texts that have trigrams. ``field`` is the place of the text's column."""
    grams = F.array(*(F.struct(F.lit(k).alias("field"), trigrams(F.col(t)).alias("grams")) for k, t in enumerate(texts)))
    each = rows.select(F.col(key).alias("id"), F.explode(grams).alias("x")).filter(F.size("x.grams") > 0)
    return each.select("id", "x.*")


def postings(cut: DataFrame, generation: int) -> DataFrame:
    """(gram, n, id, field, generation) of ``cut_texts``."""
    listed = cut.select("id", "field", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    return listed.select("gram", "n", "id", "field", F.lit(generation).alias("generation"))


def in_ranges(found: DataFrame) -> DataFrame:
    """Postings in the order that lets readers skip row groups."""
    order = ["gram", "n", "id"]
    return found.repartitionByRange(*order).sortWithinPartitions(*order)


def tombstones(ids: DataFrame, generation: int, key: str = "id") -> DataFrame:
    """(id, generation) for ids whose postings of earlier generations no longer count."""
    return ids.select(F.col(key).alias("id"), F.lit(generation).alias("generation")).distinct()


def alive(found: DataFrame, gone: DataFrame | None) -> DataFrame:
    """The postings without a tombstone of a later generation."""
    if gone is None:
        return found
    latest = gone.groupBy("id").agg(F.max("generation").alias("_until"))
    met = found.join(latest.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id")), "left")
    return met.filter(F.coalesce(F.col("_until") <= F.col("generation"), F.lit(True))).select(*found.columns)


def lengths(keyword: str, threshold: float) -> tuple[int, int]:
    """The fewest and the most trigrams of a text that may reach the threshold: it shares no more than either side has."""
    own = len(keyword_trigrams(keyword))
    return math.ceil(own * threshold - 1e-9), math.floor(own / threshold + 1e-9)


def wanted(keyword: str, threshold: float) -> Column:
    """The condition on postings; on literals, so that it reaches the scan."""
    least, most = lengths(keyword, threshold)
    return F.col("gram").isin(keyword_trigrams(keyword)) & F.col("n").between(least, most)


def scores(found: DataFrame, gone: DataFrame | None, keyword: str, threshold: float = THRESHOLD) -> DataFrame:
    """(id, similarity) of the ids with a text that reaches the threshold: the best of their texts."""
    own = len(keyword_trigrams(keyword))
    met = alive(found.filter(wanted(keyword, threshold)), gone)
    shared = met.groupBy("id", "field").agg(F.count("*").alias("shared"), F.first("n").alias("n"))
    similarity = F.col("shared") / (F.col("n") + own - F.col("shared"))
    best = shared.select("id", similarity.alias("similarity")).filter(F.col("similarity") >= threshold)
    return best.groupBy("id").agg(F.max("similarity").alias("similarity"))


def names(name: str) -> tuple[str, str]:
    """The names of an index's two tables in a store."""
    return f"{name}_postings", f"{name}_tombstones"


def built(store: Store, name: str, rows: DataFrame, texts: list[str], key: str = "id") -> dict[str, Table]:
    """New tables of an index over all rows, to be committed."""
    listed, gone = names(name)
    kind = T.StructType([T.StructField("id", rows.schema[key].dataType), T.StructField("generation", T.IntegerType(), False)])
    # ranges are found by reading what is to be ranged: stored trigrams are read twice, not made twice
    cut = store.write(cut_texts(rows, texts, key))
    made = store.write(in_ranges(postings(store.rows(cut), 0)))
    store.discard(cut)
    return {listed: made, gone: Table(kind.json())}


def updated(store: Store, state: State, name: str, delta: DataFrame, gone: DataFrame, texts: list[str], key: str = "id") -> dict[str, Table]:
    """The index's tables once the rows of ``delta`` are added and those with the ids in ``gone`` taken away (ids of replaced
    rows are in both). Only the delta is written; every ``MOST_GENERATIONS`` deltas all generations are merged."""
    listed, dead = names(name)
    generation = len(state.tables[listed].parts)
    found = store.appended(state.tables[listed], in_ranges(postings(cut_texts(delta, texts, key), generation)))
    removed = store.appended(state.tables[dead], tombstones(gone, generation, key))
    if generation < MOST_GENERATIONS:
        return {listed: found, dead: removed}
    whole = alive(store.rows(found), store.rows(removed)).withColumn("generation", F.lit(0))
    return {listed: store.write(in_ranges(whole)), dead: Table(removed.schema)}


def search(store: Store, name: str, keyword: str, threshold: float = THRESHOLD, state: State | None = None) -> DataFrame:
    """(id, similarity) from the stored index alone."""
    listed, dead = ((state or store.state()).tables[n] for n in names(name))
    return scores(store.rows(listed), store.rows(dead) if dead.parts else None, keyword, threshold)
