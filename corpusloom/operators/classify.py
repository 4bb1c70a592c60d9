"""Multi-label classification by code, keyword and role. All rules are rows of small tables that the caller gives."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.rules import KEYWORDS


def by_code(rows: DataFrame, rules: DataFrame, code: str = "code", key: str = "id") -> DataFrame:
    """(key, usecases): labels of the code, else of its first five characters, else none. Rules: (code, usecase)."""
    labels = rules.groupBy("code").agg(F.sort_array(F.collect_set("usecase")).alias("labels"))
    exact = labels.select(F.col("code").alias(code), F.col("labels").alias("_exact"))
    short = labels.select(F.col("code").alias("_short"), F.col("labels").alias("_by_short"))
    found = rows.select(key, code).join(exact, code, "left").withColumn("_short", F.substring(code, 1, 5))
    found = found.join(short, "_short", "left")
    none = F.array().cast("array<string>")
    return found.select(key, F.coalesce("_exact", "_by_short", none).alias("usecases"))


def by_keyword(rows: DataFrame, rules: Sequence[tuple[str, Sequence[str]]] = KEYWORDS, text: str = "title", key: str = "id") -> DataFrame:
    """(key, usecases): every label with a word in the text, in rule order. No join: the rules become one expression."""
    labels = []
    for label, words in rules:
        hit = F.lit(False)
        for word in words:
            hit = hit | F.col(text).contains(word)
        labels.append(F.when(hit, label))
    return rows.select(key, F.filter(F.array(*labels), lambda x: x.isNotNull()).alias("usecases"))


def by_words(rows: DataFrame, groups: Sequence[tuple[str, Sequence[str]]], text: str = "title", key: str = "id") -> DataFrame:
    """(key, groups): every group with a word in the text, in the order of the groups; for lists of hundreds of words and more.

    One automaton over all words (Aho-Corasick) walks once over the texts of a batch, so time doesn't grow with the number of
    words, and words may overlap. Texts are parted by a NUL, which no word may hold; a null text has no groups. The automaton is
    configuration, built once a task. ``by_keyword`` gives the same by one expression a word.
    """
    labels = [label for label, _ in groups]
    places: dict[str, list[int]] = {}
    for place, (_, words) in enumerate(groups):
        for word in words:
            if not word or "\0" in word:
                raise ValueError("a word is empty or holds a NUL")
            places.setdefault(word, []).append(place)
    schema = T.StructType([rows.schema[key], T.StructField("groups", T.ArrayType(T.StringType()))])

    def run(batches):
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for word, own in places.items():
            automaton.add_word(word, own)
        automaton.make_automaton()
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            starts = np.cumsum([0] + [len(t) + 1 for t in texts])
            found = [(end, place) for end, own in automaton.iter("\0".join(texts)) for place in own] if places else []
            hits = np.array(found, np.int64).reshape(-1, 2)
            row = np.searchsorted(starts, hits[:, 0], "right") - 1
            hit = np.unique(row * len(labels) + hits[:, 1]) if labels else row
            bounds = np.searchsorted(hit, np.arange(len(texts) + 1) * max(1, len(labels)))
            names = pa.array(labels, pa.string()).take(pa.array(hit % max(1, len(labels))))
            columns = [batch.column(0), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), names)]
            yield pa.RecordBatch.from_arrays(columns, [key, "groups"])

    return rows.select(key, text).mapInArrow(run, schema)


def with_fallback(rows: DataFrame, corpus: str = "corpus", labels: str = "usecases") -> DataFrame:
    """Laws without a label are shared, bylaws without one stay null, agreements are about labour."""
    empty = F.coalesce(F.size(labels) <= 0, F.lit(True))
    value = (
        F.when(F.col(corpus) == "ca", F.array(F.lit("labor")))
        .when((F.col(corpus) == "legal") & empty, F.array(F.lit("_shared")))
        .when(empty, F.lit(None).cast("array<string>"))
        .otherwise(F.col(labels))
    )
    return rows.withColumn(labels, value)


def roles(rows: DataFrame, rules: DataFrame, key: str = "id") -> DataFrame:
    """(key, role): a role takes an item that is shared, or has one of its labels, codes or groups.

    rows: (key, usecases, code, groups); rules: (role, kind, value) with kind usecase, code or group.
    """
    none = F.array().cast("array<string>")
    atoms = F.concat(
        F.transform(F.coalesce("usecases", none), lambda x: F.struct(F.lit("usecase").alias("kind"), x.alias("value"))),
        F.array(F.struct(F.lit("code").alias("kind"), F.col("code").alias("value"))),
        F.transform(F.coalesce("groups", none), lambda x: F.struct(F.lit("group").alias("kind"), x.alias("value"))),
    )
    exploded = rows.select(key, F.explode(atoms).alias("x")).select(key, "x.*")
    matched = exploded.join(rules, ["kind", "value"]).select(key, "role")
    shared = rows.filter(F.array_contains("usecases", "_shared")).select(key)
    every = shared.crossJoin(rules.select("role").distinct())
    return matched.unionByName(every).distinct()


def label_counts(rows: DataFrame, by: list[str], labels: str = "usecases") -> DataFrame:
    """Rows for each label and ``by``."""
    return rows.select(*by, F.explode(labels).alias("usecase")).groupBy(*by, "usecase").agg(F.count("*").alias("n"))


def unmapped(rows: DataFrame, rules: DataFrame, code: str = "code", most: int = 15) -> DataFrame:
    """The most frequent codes that no rule names."""
    open_ = rows.join(rules.select(F.col("code").alias(code)), code, "left_anti")
    return open_.groupBy(code).agg(F.count("*").alias("n")).orderBy(F.desc("n"), code).limit(most)
