"""Costs, limits and shards of a conversion queue as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MB = 1024 * 1024


def megabytes(size: Column) -> Column:
    return size / F.lit(float(MB))


def conversion_cost(size: Column, pages: Column) -> Column:
    """Seconds: 60 for a megabyte or 20 for a page, whichever is more."""
    by_size = megabytes(size) * 60
    return F.greatest(by_size, F.when(pages > 0, pages * 20.0).otherwise(by_size))


def conversion_timeout(size: Column, pages: Column, cap_ms: int = 0, multiplier: float = 1.0) -> Column:
    """Milliseconds, between 30 and 90 minutes, then capped and multiplied."""
    by_size = 300_000 + F.ceil(megabytes(size) * 60_000)
    by_pages = F.when(pages > 0, pages * 20_000).otherwise(0)
    base = F.greatest(F.lit(1_800_000), F.least(F.greatest(by_size, by_pages), F.lit(5_400_000)))
    base = F.least(base, F.lit(cap_ms)) if cap_ms else base
    return F.round(base * multiplier).cast("long")


def quick_timeout(size: Column) -> Column:
    """Seconds: 180 and 42 for a megabyte, at most an hour."""
    return F.least(F.lit(3600), F.greatest(F.lit(180), 180 + F.ceil(megabytes(size) * 42))).cast("long")


def density(size: Column, pages: Column) -> Column:
    """Megabytes for a page."""
    return megabytes(size) / F.greatest(F.when(pages > 0, pages).otherwise(1), F.lit(1))


def shard(key: Column, shards: int) -> Column:
    """The first 8 hexadecimal digits of the key's md5, modulo the shards."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long") % shards


def record_id(*parts: Column) -> Column:
    return F.md5(F.concat_ws("-", *parts).cast("binary"))


def content_hash(title: Column, body: Column, length: int = 4000) -> Column:
    """md5 of what is embedded: the title's line, if there is one, and the start of the body."""
    head = F.when(F.coalesce(title, F.lit("")) == "", "").otherwise(F.concat(title, F.lit("\n")))
    return F.md5(F.concat(head, F.substring(F.coalesce(body, F.lit("")), 1, length)).cast("binary"))


def text_is_enough(chars: Column, pages: Column, per_page: int = 100, single_page: int = 70, least: int = 20) -> Column:
    """Whether extracted text passes for a document of so many pages; an unknown page count doesn't."""
    needed = F.when(pages == 1, single_page).otherwise(per_page)
    return (chars >= least) & (pages >= 1) & (chars / pages >= needed)


def rebalanced_split(split: Column, slow_left: Column, fast_left: Column, since_s: Column, step: int = 100,
                     most: int = 400, interval_s: int = 1800) -> Column:
    """Raise the page limit of the fast instance by a step while it has less work left; it is never lowered."""
    due = (since_s >= interval_s) & (fast_left < slow_left) & (split < most)
    return F.when(due, F.least(split + step, F.lit(most))).otherwise(split)
