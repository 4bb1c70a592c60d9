"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A run of three letters (word breaks count as one letter) is bound by
multiplying its letters' vectors, each permuted by its place; a text's vector is the bundle (sum) over all its runs, and
a language's prototype is the bundle over its sample. A text too short for a run gets a word break at
either end, so that each letter is in a run. The language whose prototype has the largest cosine wins; the
score is a softmax over the cosines.

Edge cases: a null text and a text without a letter are ``und`` with score 0. Without any learned language every text is
``und``. Ties go to the language that sorts first. Repeated rows and ids are scored row by row. An empty table gives an
empty result. Extra columns are not read. Prototypes come from about ``per_language`` documents of each language, which
bounds what is learned from; the number of languages must be small enough to send them to the tasks. Letters beyond
``ALPHABET`` places share places by code point. Whole texts are read.
"""

from __future__ import annotations

import sys
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.kernels import text_slices
from corpusloom.llm.shared import bounded_sample, modest_batches

DIMENSIONS = 1024
ALPHABET = 256
ORDER = 3
PER_LANGUAGE = 1000
SLICE = 1 << 20  # bytes; long slices share the bound vectors of their runs
SHARPNESS = 20.0


def _place(c: int) -> int:
    """Place of a code point: 0 for what isn't a letter, the same for a letter's cases."""
    ch = chr(c)
    if not ch.isalpha():
        return 0
    low = ch.lower()
    return 1 + (ord(low) if len(low) == 1 else c) % (ALPHABET - 1)


@cache
def _letters() -> np.ndarray:
    """Places of the code points up to 0x30000; ``_place`` gives those of the few letters beyond."""
    return np.array([_place(c) for c in range(0x30000)], np.int64)


@cache
def _vectors() -> list[np.ndarray]:
    """Letter vectors, permuted for each place in a run."""
    base = np.random.default_rng(7).integers(0, 2, (ALPHABET, DIMENSIONS)).astype(np.float32) * 2 - 1
    return [np.roll(base, ORDER - 1 - place, axis=1) for place in range(ORDER)]


def _folded(letter: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and rows with the breaks that follow each other in a row made one."""
    keep = np.ones(len(letter), bool)
    keep[1:] = (letter[1:] != 0) | (letter[:-1] != 0) | (row[1:] != row[:-1])
    return letter[keep], row[keep]


def slice_runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, run code) of every run of letters in a slice, word breaks folded into one."""
    text = raw.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le" if sys.byteorder == "little" else "utf-32-be"), np.uint32)
    lead = np.flatnonzero((raw & 0xC0) != 0x80)
    if len(lead) != len(points):  # invalid UTF-8: fall back on bytes
        points, lead = raw.astype(np.uint32), np.arange(len(raw))
    table = _letters()
    letter = table[np.where(points < len(table), points, 0)]
    for c in np.unique(points[points >= len(table)]).tolist():
        letter[points == c] = _place(c)
    row = np.searchsorted(offsets, lead, "right") - 1
    letter, row = _folded(letter, row)
    places = np.bincount(row, minlength=len(offsets) - 1)
    short = ((places > 0) & (places < ORDER)).astype(np.int64)
    if short.any():  # a break before and after the row
        padded = np.zeros(len(letter) + 2 * short.sum(), np.int64)
        padded[np.arange(len(letter)) + (2 * np.cumsum(short) - short)[row]] = letter
        letter, row = _folded(padded, np.repeat(np.arange(len(places)), places + 2 * short))
    if len(letter) < ORDER:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(len(letter) - ORDER + 1, np.int64)
    some = np.zeros(len(code), bool)
    for k in range(ORDER):
        part = letter[k : len(letter) - ORDER + 1 + k]
        code = code * ALPHABET + part
        some |= part != 0
    same = (row[: len(code)] == row[ORDER - 1 :]) & some
    return row[: len(code)][same], code[same]


def bundle(rows: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """The vectors of n rows: counts of their runs times the bound vectors of the distinct runs."""
    out = np.zeros((n, DIMENSIONS), np.float32)
    if not len(codes):
        return out
    distinct, at = np.unique(codes, return_inverse=True)
    vectors = _vectors()
    step = max(1, (4 << 20) // len(distinct))
    bound = vectors[0][distinct // ALPHABET**2] * vectors[1][distinct // ALPHABET % ALPHABET]
    bound *= vectors[2][distinct % ALPHABET]
    edges = np.searchsorted(rows, np.arange(n + 1))
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        a, b = edges[lo], edges[hi]
        counts = np.bincount((rows[a:b] - lo) * len(distinct) + at[a:b], minlength=(hi - lo) * len(distinct))
        out[lo:hi] = counts.reshape(hi - lo, len(distinct)).astype(np.float32) @ bound
    return out


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> dict[str, np.ndarray]:
    """Unit prototypes by language, from a bounded sample of the rows of ``docs`` that have a language."""
    modest_batches(docs.sparkSession)
    keys = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang")).filter("_lang is not null")
    chosen = bounded_sample(keys.filter("_id is not null").distinct(), "_id", "_lang", per_language)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")

    def run(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lo, hi, raw, offsets in text_slices(batch.column(1), SLICE):
                vectors = bundle(*slice_runs(raw, offsets), hi - lo)
                for lang in set(langs[lo:hi]):
                    total = vectors[langs[lo:hi] == lang].sum(0, dtype=np.float64)
                    yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([total.tolist()])], ["lang", "vector"])

    parts = rows.select("_lang", "_text").mapInArrow(run, "lang string, vector array<double>")
    at = F.posexplode("vector").alias("place", "value")
    summed = parts.select("lang", at).groupBy("lang", "place").agg(F.sum("value").alias("value")).toPandas()
    found = {}
    for lang, own in summed.groupby("lang"):
        vector = np.zeros(DIMENSIONS)
        vector[own.place.to_numpy()] = own.value.to_numpy()
        if np.any(vector):
            found[lang] = vector / np.linalg.norm(vector)
    return dict(sorted(found.items()))


def predict(
    docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_pred, score) of every row; one pass over whole texts, no shuffle."""
    modest_batches(docs.sparkSession)
    schema = T.StructType(
        [docs.schema[id_col], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    names = [*prototypes, "und"]
    stack = np.array(list(prototypes.values()), np.float32).reshape(-1, DIMENSIONS)

    def run(batches):
        for batch in batches:
            for lo, hi, raw, offsets in text_slices(batch.column(1), SLICE):
                vectors = bundle(*slice_runs(raw, offsets), hi - lo)
                norm = np.sqrt((vectors * vectors).sum(1))
                best, score = np.full(hi - lo, len(names) - 1), np.zeros(hi - lo)
                if len(stack):
                    cosine = vectors @ stack.T / np.maximum(norm, 1e-9)[:, None]
                    share = np.exp(SHARPNESS * (cosine - cosine.max(1, keepdims=True)))
                    known = norm > 0
                    best[known] = cosine.argmax(1)[known]
                    score[known] = (share.max(1) / share.sum(1))[known]
                lang = pa.array([names[i] for i in best])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), lang, pa.array(score)], [id_col, "lang_pred", "score"]
                )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
