"""Trigram similarity and cosine similarity as Columns."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

THRESHOLD = 0.3


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: a code point, and ahead of it the 3-gram that it begins, but for one that ends in two blanks
GRAM = "(?=(.(?:.[^ ]|[^ ] )))."


def trigrams(text: Column) -> Column:
    """Distinct 3-grams of each lower-cased word, padded by two blanks before and one after it; none of a null text.

    Words are set side by side with their padding, so one walk over the text gives all; a 3-gram that ends in two blanks
    lies across two words.
    """
    words = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", "   "))
    return F.array_distinct(F.regexp_extract_all(F.concat(F.lit("  "), words, F.lit(" ")), F.lit(GRAM), F.lit(1)))


def keyword_trigrams(keyword: str) -> list[str]:
    """The trigrams of a known text, worked out once on the driver."""
    words = [f"  {w} " for w in re.split(r"[\W_]+", keyword.lower()) if w]
    return sorted({w[i : i + 3] for w in words for i in range(len(w) - 2)})


def trigram_similarity(a: Column, b: Column | str) -> Column:
    """Shared trigrams by all trigrams; null if either text is. A keyword given as a string becomes a literal array."""
    if isinstance(b, str):
        grams = keyword_trigrams(b)
        known, present = F.array(*map(F.lit, grams)).cast("array<string>"), a.isNotNull()
        return F.when(present, _once(trigrams(a), lambda x: _share(F.size(F.array_intersect(x, known)), F.size(x), F.lit(len(grams)))))
    both = F.struct(trigrams(a).alias("x"), trigrams(b).alias("y"))
    value = _once(both, lambda s: _share(F.size(F.array_intersect(s["x"], s["y"])), F.size(s["x"]), F.size(s["y"])))
    return F.when(a.isNotNull() & b.isNotNull(), value)


def _share(both: Column, n: Column, m: Column) -> Column:
    return F.when(n + m == 0, 0.0).otherwise(both.cast("double") / (n + m - both))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, p: s + p)


def cosine(a: Column, b: Column) -> Column:
    """1 less the cosine distance; null if a vector is null or has no length."""
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size)
