"""First rows, ranks, limits and rank fusion. Every order ends in a unique key, so results don't depend on arrival."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import filled
from corpusloom.schema import CORPUS_ORDER

RRF_K = 60


def first_by(rows: DataFrame, keys: Sequence[Column | str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps the first rank of a window before the shuffle too, so a hot key moves one row from each task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def limit_by(rows: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank")


def corpus_rank(corpus: Column, names: dict[str, int] = CORPUS_ORDER) -> Column:
    out = F.lit(len(names) + 5)
    for name, place in names.items():
        out = F.when(corpus == name, place).otherwise(out)
    return out


def round_robin(rows: DataFrame, tie: Sequence[Column], limit: int) -> DataFrame:
    """Rows by descending score; among equal scores corpora take turns. Adds ``turn``."""
    turn = F.row_number().over(Window.partitionBy("score", "corpus").orderBy(*tie))
    ranked = rows.withColumn("turn", turn)
    return ranked.orderBy(F.desc("score"), "turn", corpus_rank(F.col("corpus")), *tie).limit(limit)


def corpus_fan_out(rows: DataFrame, tie: Sequence[Column], limit: int) -> DataFrame:
    """A capped number of rows from each corpus, in one scan, then round-robin."""
    each = min(120, -(-limit * 6 // 10) + 15)
    return round_robin(limit_by(rows, ["corpus"], [F.desc("score"), *tie], each), tie, limit)


def one_by_institution(rows: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The first row of each institution; rows without one go by document title."""
    return first_by(rows, [filled(F.col("inst_name"), F.col("doc_title"), default="")], order)


def fusion_key() -> Column:
    """What rank fusion takes for the same article: path (else title), article label and article title."""
    part = lambda *names: filled(*(F.col(n) for n in names), default="")
    return F.struct(part("rel_path", "doc_title"), part("art_ref"), part("art_title"))


def reciprocal_rank_fusion(arms: Sequence[DataFrame], order: Sequence[Sequence[Column]], limit: int,
                           key: Column | None = None, unique: str = "id", depth: int = 1000) -> DataFrame:
    """Sum of 1 / (60 + rank) over the arms by key; the row seen first (by arm, then rank) stands for its key.

    The first ``depth`` rows of each arm count, so a global rank is never over more rows than that.
    """
    ranked = None
    for number, (arm, by) in enumerate(zip(arms, order, strict=True)):
        place = F.row_number().over(Window.orderBy(*by))
        own = arm.orderBy(*by).limit(depth).withColumn("_rank", place).withColumn("_arm", F.lit(number))
        ranked = own if ranked is None else ranked.unionByName(own, allowMissingColumns=True)
    key = fusion_key() if key is None else key
    names = [c for c in ranked.columns if not c.startswith("_")]
    summed = ranked.groupBy(key.alias("_key")).agg(
        F.sum(1.0 / (RRF_K + F.col("_rank"))).alias("_sum"),
        F.min_by(F.struct(*names), F.struct("_arm", "_rank")).alias("_row"),
    )
    out = summed.select(*(F.col(f"_row.{n}").alias(n) for n in names), F.round("_sum", 4).alias("rrf"), "_sum")
    return out.orderBy(F.desc("_sum"), unique).limit(limit).drop("_sum")


def best_of_variants(arms: Sequence[DataFrame], floor: float | None, limit: int, unique: str = "id") -> DataFrame:
    """One row for each article over several queries' results: that with the best score, if it reaches the floor."""
    every = arms[0]
    for arm in arms[1:]:
        every = every.unionByName(arm)
    best = first_by(every.withColumn("_key", fusion_key()), ["_key"], [F.desc("score"), F.col(unique)]).drop("_key")
    best = best if floor is None else best.filter(F.col("score") >= floor)
    return best.orderBy(F.desc("score"), unique).limit(limit)
