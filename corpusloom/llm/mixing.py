"""Temperature mixing of sources, with built-in functions only.

A source's weight is its token share to the power of an exponent, normalised: 1 keeps the shares, 0 makes them equal.
The exponent is bisected: the largest one whose weights reach the target entropy, raised where needed so that no source
repeats its tokens more often than the limit (with a budget above the limit times all tokens it is 1). The budget is then
realised: each source's rows fall into blocks by a hash of their id, each epoch has its own permutation of the blocks,
whole epochs are taken while the source's budget lasts and of the last epoch the blocks up to the budget, the last of
them if more than half of it fits. A source's realised tokens so differ from its budget by half a block at most.

Edge cases: a null source is a source of its own. Rows without words cost nothing and go with their block; a source
without any token is taken once. Repeated ids share a block, repeated rows are counted and taken row by row. An empty
table gives an empty result. Extra columns are kept; columns of the input named as those that are added are replaced. The number of sources
must allow one row with all of their totals; rows of a source are never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.shared import staged, unused

BLOCKS = 1024
ENTROPY_SHARE = 0.95
MAX_REPEATS = 4.0
STEPS = 50
BROADCAST_BLOCKS = 500_000
SEED = "mix"


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; 0 for null."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, "[\\x20\\x09-\\x0D]+"))).cast("long")


def block_of(id_column: Column) -> Column:
    digest = F.md5(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % BLOCKS).cast("int")


def exponent(shares: Column, budget_ratio: Column, entropy_share: float, max_repeats: float) -> Column:
    """Bisect the exponent over an array of positive shares; budget_ratio: budget by all tokens."""
    logs = F.transform(shares, lambda p: F.log(p))

    def sums(alpha: Column) -> Column:
        zero = F.struct(F.lit(0.0).alias("z"), F.lit(0.0).alias("s"), F.lit(0.0).alias("most"))

        def add(a: Column, x: Column) -> Column:
            e = F.exp(alpha * x)
            most = F.greatest(a["most"], F.exp((alpha - 1) * x))
            return F.struct((a["z"] + e).alias("z"), (a["s"] + e * alpha * x).alias("s"), most.alias("most"))

        return F.aggregate(logs, zero, add)

    def bisect(low_is_fine) -> Column:
        """The border between exponents from 0 for which the test holds and the rest up to 1."""

        def step(s: Column, _: Column) -> Column:
            mid = (s["lo"] + s["hi"]) / 2
            fine = low_is_fine(sums(mid))
            return F.struct(
                F.when(fine, mid).otherwise(s["lo"]).alias("lo"), F.when(fine, s["hi"]).otherwise(mid).alias("hi")
            )

        start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)

    target = F.log(F.size(shares).cast("double")) * entropy_share
    entropy = lambda t: F.log(t["z"]) - t["s"] / t["z"]
    by_entropy = bisect(lambda t: entropy(t) >= target)["lo"]
    by_repeats = bisect(lambda t: budget_ratio * t["most"] / t["z"] > max_repeats)["hi"]
    at = lambda a: sums(F.lit(a))
    return F.greatest(
        F.when(entropy(at(1.0)) >= target, 1.0).otherwise(by_entropy),
        F.when(budget_ratio * at(0.0)["most"] / at(0.0)["z"] <= max_repeats, 0.0).otherwise(by_repeats),
    )


def sized(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, source, n_tokens) of every row, staged: texts are read once and leave no more than this."""
    narrow = docs.select(F.col(id_col), F.col(source_col), word_count(F.col(text_col)).alias("n_tokens"))
    return staged(narrow, "mix-sizes")


def plan(
    sizes: DataFrame, id_col: str = "doc_id", source_col: str = "source", budget: int | None = None,
    entropy_share: float = ENTROPY_SHARE, max_repeats: float = MAX_REPEATS, seed: str = SEED,
) -> DataFrame:
    """(mix_source, mix_block, mix_epoch, mix_rank, mix_weight): the blocks taken in each epoch of each source."""
    source = F.col(source_col)
    keyed = sizes.select(
        source.alias("mix_source"), source.isNull().alias("none"), block_of(F.col(id_col)).alias("mix_block"), "n_tokens"
    )
    blocks = keyed.groupBy("mix_source", "none", "mix_block").agg(F.sum("n_tokens").alias("n"))
    totals = blocks.groupBy("mix_source", "none").agg(F.sum("n").alias("all"))
    row = totals.agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("mix_source", F.lit("")).alias("name"), "none", "all"))).alias("t"),
        F.sum("all").alias("total"),
    )
    limit = F.col("total").cast("double") if budget is None else F.lit(float(budget))
    some = F.filter("t", lambda x: x["all"] > 0)
    shares = F.transform(some, lambda x: x["all"] / F.col("total"))
    row = row.select("t", "total", limit.alias("budget"), shares.alias("shares"))
    alpha = exponent(F.col("shares"), F.col("budget") / F.col("total"), entropy_share, max_repeats)
    row = row.select("t", "total", "budget", "shares", F.when(F.size("shares") > 0, alpha).alias("alpha"))
    sum_of = F.aggregate("shares", F.lit(0.0), lambda a, p: a + F.pow(p, F.col("alpha")))
    row = row.select("t", "total", "budget", "alpha", sum_of.alias("z")).select(
        F.explode("t").alias("x"), "total", "budget", "alpha", "z"
    )
    weight = F.when(F.col("x.all") > 0, F.pow(F.col("x.all") / F.col("total"), F.col("alpha")) / F.col("z")).otherwise(0.0)
    weights = row.select(
        F.col("x.name").alias("name"), F.col("x.none").alias("none"), F.col("x.all").alias("all"),
        weight.alias("mix_weight"), (weight * F.col("budget")).alias("own"),
    )
    whole = F.when(F.col("all") > 0, F.floor(F.col("own") / F.col("all"))).otherwise(1).cast("int")
    weights = weights.withColumn("whole", whole).withColumn("rest", F.col("own") - F.col("whole") * F.col("all"))
    named = blocks.withColumn("name", F.coalesce("mix_source", F.lit("")))
    epochs = named.join(weights, ["name", "none"]).withColumn("mix_epoch", F.explode(F.sequence(F.lit(0), "whole")))
    place = F.md5(F.concat_ws(":", F.lit(seed), "mix_epoch", "name", "mix_block").cast("binary"))
    order = Window.partitionBy("name", "none", "mix_epoch").orderBy(place, "mix_block")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = epochs.withColumn("mix_rank", F.row_number().over(order)).withColumn("before", before)
    fits = (F.col("all") > 0) & (F.col("before") + F.col("n") / 2 <= F.col("rest"))
    taken = ranked.filter((F.col("mix_epoch") < F.col("whole")) | fits)
    return taken.select("mix_source", "mix_block", "mix_epoch", "mix_rank", "mix_weight")


def apply(docs: DataFrame, blocks: DataFrame, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Each row once for every epoch that takes its block, with ``mix_epoch``, ``mix_rank`` and ``mix_weight``."""
    rows = docs.drop("mix_source", "mix_block", "mix_epoch", "mix_rank", "mix_weight")
    rows = rows.withColumn("mix_block", block_of(F.col(id_col)))
    by_source, by_block = unused("taken_source", rows), unused("taken_block", rows)
    taken = staged(blocks.withColumnsRenamed({"mix_source": by_source, "mix_block": by_block}), "mix-plan")
    if taken.count() <= BROADCAST_BLOCKS:
        taken = F.broadcast(taken)
    same = F.col(source_col).eqNullSafe(F.col(by_source)) & (F.col("mix_block") == F.col(by_block))
    return rows.join(taken, same).drop(by_source, by_block)
