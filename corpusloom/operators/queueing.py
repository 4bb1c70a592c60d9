"""Conversion work queues: classes, bands, shards, order and completion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.planning import conversion_cost, density, megabytes, shard


def classify(items: DataFrame, existing: DataFrame, previous: DataFrame, key: str = "id") -> DataFrame:
    """Items (id, size, pages, hash) with ``class``: DEDUP if their output exists, CDEDUP if an item before them or an
    earlier batch has their hash, else CANONICAL; and ``canonical`` and ``score``. Items without a hash are canonical."""
    rows = items.join(existing.select(key, F.lit(True).alias("_there")).distinct(), key, "left")
    rows = rows.join(previous.select("hash", F.lit(True).alias("_earlier")).distinct(), "hash", "left")
    open_ = F.col("_there").isNull()
    first = rows.filter(open_ & F.col("hash").isNotNull()).groupBy("hash").agg(F.min(key).alias("_first"))
    rows = rows.join(first, "hash", "left")
    again = F.col("hash").isNotNull() & (F.col("_earlier") | (F.col(key) != F.col("_first")))
    kind = F.when(~open_, "DEDUP").when(F.coalesce(again, F.lit(False)), "CDEDUP").otherwise("CANONICAL")
    rows = rows.withColumn("class", kind).withColumn("canonical", F.coalesce(F.when(open_, F.col("_first")), F.col(key)))
    return rows.withColumn("score", conversion_cost(F.col("size"), F.col("pages"))).drop("_there", "_earlier", "_first")


def is_heavy(size: Column, most_mb: float = 0.9) -> Column:
    return megabytes(size) > most_mb


def is_small(size: Column, pages: Column, most_pages: int = 100, most_mb: float = 0.9) -> Column:
    return (F.when(pages > 0, pages).otherwise(1) <= most_pages) & (megabytes(size) <= most_mb)


def is_safe(size: Column, pages: Column, quarantined: Column, most_mb: float = 0.9, most_density: float = 0.5,
            least_pages: int = 3, split_pages: int = 0) -> Column:
    """Whether a small instance can take an item: not quarantined, light or of many light pages, and not too long."""
    thin = (F.coalesce(pages, F.lit(0)) >= least_pages) & (density(size, pages) <= most_density)
    fits = ~F.coalesce(quarantined, F.lit(False)) & (~is_heavy(size, most_mb) | thin)
    return fits & (F.when(pages > 0, pages).otherwise(1) < split_pages) if split_pages else fits


def band(name: str, size: Column, pages: Column, quarantined: Column | None = None, low: int = 0, high: int | None = None,
         **limits) -> Column:
    """Membership of a band; each of small/big, light/heavy and safe/risky is the other's complement."""
    quarantined = F.lit(False) if quarantined is None else quarantined
    bands = {
        "small": lambda: is_small(size, pages, **limits), "big": lambda: ~is_small(size, pages, **limits),
        "light": lambda: ~is_heavy(size, **limits), "heavy": lambda: is_heavy(size, **limits),
        "safe": lambda: is_safe(size, pages, quarantined, **limits),
        "risky": lambda: ~is_safe(size, pages, quarantined, **limits),
    }
    if name:
        return bands[name]()
    count = F.when(pages > 0, pages).otherwise(1)
    return count >= low if high is None else count.between(low, high)


def in_shard(canonical: Column, number: int, shards: int) -> Column:
    """Whether an item is this shard's; copies go with their canonical item."""
    return shard(canonical, shards) == number


def worklist(rows: DataFrame, priority: DataFrame | None = None, ascending: bool = False, key: str = "id") -> DataFrame:
    """Items in order of work: finished ones, priority items, the rest by score, then copies. Adds ``bucket``."""
    marked = rows if priority is None else rows.join(priority.select(key, F.lit(True).alias("_first")).distinct(), key, "left")
    first = F.lit(False) if priority is None else F.coalesce("_first", F.lit(False))
    bucket = F.when(F.col("class") == "DEDUP", 0).when(F.col("class") == "CDEDUP", 3).when(first, 1).otherwise(2)
    marked = marked.withColumn("bucket", bucket).drop("_first")
    score = F.col("score").asc() if ascending else F.col("score").desc()
    return marked.orderBy("bucket", score, key)


def by_extension(rows: DataFrame, order: Sequence[str], large: int, key: str = "id") -> DataFrame:
    """Adds ``is_large`` and sorts by the extension's place in the list, unknown ones last."""
    place = F.lit(len(order))
    for i, extension in enumerate(order):
        place = F.when(F.col("ext") == extension, i).otherwise(place)
    # a bare literal would be taken for the position of a column
    return rows.withColumn("is_large", F.col("size") >= large).orderBy(*([place] if order else []), key)


def reuse_by_hash(rows: DataFrame, converted: DataFrame) -> DataFrame:
    """Items whose bytes were converted before, with the body to copy: (id, hash, reused_from, body)."""
    first = converted.groupBy("hash").agg(F.min_by(F.struct("id", "body"), "id").alias("_one"))
    return rows.join(first, "hash").select("id", "hash", F.col("_one.id").alias("reused_from"), F.col("_one.body").alias("body"))


def without_pending(rows: DataFrame, lists: DataFrame, now: Column, hours: int = 12, key: str = "id") -> DataFrame:
    """Items that no fresh list holds; a list counts for ``hours`` after its ``updated_at``."""
    fresh = lists.filter(F.col("updated_at") >= now - F.make_dt_interval(hours=F.lit(hours)))
    return rows.join(fresh.select(key), key, "left_anti")


def reset_retryable(rows: DataFrame, errors: Sequence[str]) -> DataFrame:
    """Failed items whose error holds one of the texts become open again."""
    hit = F.lit(False)
    for text in errors:
        hit = hit | F.col("error").contains(text)
    return rows.withColumn("status", F.when((F.col("status") == "failed") & hit, F.lit(None)).otherwise(F.col("status")))


def completion(queue: DataFrame, statuses: DataFrame, key: str = "id") -> DataFrame:
    """One row: queued, succeeded, failed, open, and whether every item ended in any map."""
    best = statuses.groupBy(key).agg(F.bool_or(F.col("status") == "success").alias("_good"),
                                     F.bool_or(F.col("status") == "failed").alias("_bad"))
    rows = queue.select(key).distinct().join(best, key, "left")
    good, bad = F.coalesce("_good", F.lit(False)), F.coalesce("_bad", F.lit(False))
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return rows.agg(
        F.count("*").alias("queued"), count(good).alias("succeeded"), count(~good & bad).alias("failed"),
        count(~good & ~bad).alias("open"), (count(~good & ~bad) == 0).alias("complete"),
    )


def size_percentiles(rows: DataFrame, column: str = "score", shares: Sequence[float] = (0.1, 0.5, 0.9),
                     ranges: int = 256) -> DataFrame:
    """One row with p10, p50, p90: the value at index floor(n * p) of the sorted values, exactly.

    Values fall into ranges between approximate quantiles; ranges are counted, and values are ordered only within the range
    that a percentile lies in, so no task orders all of them.
    """
    values = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    edges = values.agg(F.array_distinct(F.percentile_approx("v", [i / ranges for i in range(1, ranges)], 100_000)).alias("edges"))
    placed = values.crossJoin(F.broadcast(edges)).select("v", "n", F.size(F.filter("edges", lambda e: e <= F.col("v"))).alias("part"))
    sizes = placed.groupBy("part").agg(F.sum("n").alias("size"))
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = sizes.select("part", F.coalesce(F.sum("size").over(every), F.lit(0)).alias("start"))
    total = sizes.agg(F.sum("size").alias("total"))
    own = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = placed.withColumn("within", F.sum("n").over(own)).join(F.broadcast(starts), "part")
    upto = upto.withColumn("upto", F.col("start") + F.col("within")).crossJoin(F.broadcast(total))
    return upto.agg(*(
        F.min(F.when(F.col("upto") > F.floor(F.col("total") * p), F.col("v"))).alias(f"p{round(100 * p)}") for p in shares
    ))


def hits_in_window(events: DataFrame, key: str, ts: str, seconds: int = 60, most: int = 40, windows: int = 64) -> DataFrame:
    """Adds ``hits`` (this one and the key's others less than the window before it) and ``blocked``; blocked ones count.

    Time is cut into slices of so many windows, each with the last window of the slice before it, so a key with very many
    events is spread over its slices.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    width = seconds * 1_000_000
    slice_ = F.floor(F.col("_at") / (width * windows))
    late = F.pmod(F.col("_at"), F.lit(width * windows)) >= width * (windows - 1)
    rows = events.withColumn("_at", micros).withColumn("_slice", F.explode(F.when(late, F.array(slice_, slice_ + 1)).otherwise(F.array(slice_))))
    span = Window.partitionBy(key, "_slice").orderBy("_at").rangeBetween(-(width - 1), 0)
    counted = rows.withColumn("hits", F.count("*").over(span)).filter(F.col("_slice") == slice_).drop("_at", "_slice")
    return counted.withColumn("blocked", F.col("hits") > most)
