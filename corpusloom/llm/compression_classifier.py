"""Quality classifier by compression.

Two zstandard dictionaries are trained, one on blocks of texts labelled good and one on blocks of texts labelled bad. A
whole text is cut into blocks, and every block is compressed with either dictionary; the difference of the two sizes, as a
share of the text's bytes, says which class the text resembles. A text that repeats itself compresses alike with any
dictionary, so its size without one, as a share of its bytes, goes into the calibration beside the difference: a logistic
regression on labelled rows that trained neither dictionary makes a probability of the two.

Edge cases: null and empty texts are compressed as no bytes and get the calibrated value of no difference and no size gained. With labels of
one class only every score is that class (1.0 or 0.0), without labels 0.5. Repeated rows and ids are scored row by row,
repeated labels count once each. An empty table gives an empty result. Extra columns are not read, but stay in what ``keep``
returns. The training sample is bounded by ``per_class`` (documents of a class, in expectation) and ``BLOCKS_A_TEXT`` (blocks
that a document gives a dictionary), so at most some 20 MB reach the driver; calibration and scoring read whole texts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.shared import bounded_sample, modest_batches

BLOCK = 1024
DICTIONARY_BYTES = 65536
PER_CLASS = 2000
BLOCKS_A_TEXT = 8


@dataclass(frozen=True)
class Model:
    """bad, good: dictionaries (None if a class had no row); constant: score in that case."""

    bad: bytes | None
    good: bytes | None
    centre: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    weights: tuple[float, ...] = ()
    constant: float = 0.5


def blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK] for i in range(0, len(text), BLOCK)] or [b""]


def train_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; raw content where the samples are too few to train on."""
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, samples)) // 8))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:] or b" "


def measurer(bad: bytes, good: bytes) -> Callable[[bytes], tuple[float, float]]:
    """A function from a text's bytes to the normalised difference of its compressed sizes, and the size with neither."""
    plain = zstandard.ZstdCompressor(level=1, write_checksum=False, write_content_size=False).compress
    either = []
    for content in (bad, good):
        table = zstandard.ZstdCompressionDict(content)
        table.precompute_compress(level=1)
        options = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
        either.append(zstandard.ZstdCompressor(dict_data=table, level=1, **options).compress)
    by_bad, by_good = either

    def measure(text: bytes) -> tuple[float, float]:
        parts, n = blocks(text), max(1, len(text))
        gap = sum(len(by_bad(b)) for b in parts) - sum(len(by_good(b)) for b in parts)
        return gap / n, min(1.0, len(plain(text)) / n)

    return measure


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 40) -> tuple[np.ndarray, ...]:
    """Ridge-penalised logistic regression on standardised features by Newton steps: (centre, scale, weights)."""
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - centre) / scale]
    w = np.zeros(z.shape[1])
    penalty = ridge * len(x) * np.eye(len(w))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        s = np.maximum(p * (1 - p), 1e-6)
        w = w + np.linalg.solve((z * s[:, None]).T @ z + penalty, z.T @ (y - p) - penalty @ w)
    return centre, scale, w


def sample_blocks(rows: DataFrame) -> DataFrame:
    """(id, label, place, block): of each row (id, text, label) ``BLOCKS_A_TEXT`` blocks at most, at even distances."""

    def run(batches):
        for batch in batches:
            out = []
            for key, text, label in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts = blocks(text)
                for place in np.unique(np.linspace(0, len(parts) - 1, BLOCKS_A_TEXT).astype(int)).tolist():
                    out.append((key, label, place, parts[place]))
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary()]
            columns = [pa.array([o[k] for o in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "place", "block"])

    return rows.mapInArrow(run, "id string, label int, place int, block binary")


def differences(rows: DataFrame, bad: bytes, good: bytes) -> DataFrame:
    """(gap, plain, label) of each row (id, text, label)."""

    def run(batches):
        measure = measurer(bad, good)
        for batch in batches:
            found = np.array([measure(t) for t in batch.column(1).to_pylist()]).reshape(-1, 2)
            columns = [pa.array(found[:, 0]), pa.array(found[:, 1]), batch.column(2)]
            yield pa.RecordBatch.from_arrays(columns, ["gap", "plain", "label"])

    return rows.mapInArrow(run, "gap double, plain double, label int")


def fit_labelled(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
    per_class: int = PER_CLASS,
) -> Model:
    """Fit on a bounded sample of labelled rows; blocks for the dictionaries and calibration numbers reach the driver."""
    modest_batches(docs.sparkSession)
    keys = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    chosen = bounded_sample(keys.filter("_id is not null and _label in (0, 1)"), "_id", "_label", per_class)
    part = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit("part")), F.lit(3))
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))
    rows = rows.join(F.broadcast(chosen.withColumn("_part", part)), "_id")
    rows = rows.select(F.col("_id").cast("string"), "_text", "_label", "_part")
    training, rest = rows.filter("_part > 0").drop("_part"), rows.filter("_part = 0").drop("_part")
    got = sample_blocks(training).collect()
    if len({r["label"] for r in got}) < 2:  # few labels: the same rows train and calibrate
        rest = rows.drop("_part")
        got = sample_blocks(rest).collect()
    known = {r["label"] for r in got}
    if len(known) < 2:
        return Model(None, None, constant=float(next(iter(known), 0.5)))
    got.sort(key=lambda r: (r["label"], r["id"], r["place"], bytes(r["block"])))
    bad, good = (train_dictionary([bytes(r["block"]) for r in got if r["label"] == y]) for y in (0, 1))
    seen = sorted(map(tuple, differences(rest, bad, good).collect()))
    if len({label for *_, label in seen}) < 2:
        seen = sorted(map(tuple, differences(rows.drop("_part"), bad, good).collect()))
    table = np.array(seen, float)
    centre, scale, w = fit_logistic(table[:, :2], table[:, 2])
    return Model(bad, good, tuple(centre.tolist()), tuple(scale.tolist()), tuple(w.tolist()))


def probabilities(model: Model, measure: Callable[[bytes], tuple[float, float]] | None, texts: pa.Array) -> np.ndarray:
    """Scores of a batch of texts."""
    if measure is None:
        return np.full(len(texts), model.constant)
    x = np.array([measure(t.as_py()) for t in texts], float).reshape(len(texts), 2)
    z = model.weights[0] + (x - model.centre) / model.scale @ np.array(model.weights[1:])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; one pass over whole texts, no shuffle."""
    modest_batches(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])

    def run(batches):
        measure = measurer(model.bad, model.good) if model.good is not None else None
        for batch in batches:
            got = probabilities(model, measure, batch.column(1).cast(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got)], [id_col, "score"])

    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(run, schema)


def keep(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose score reaches the threshold."""
    modest_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        measure = measurer(model.bad, model.good) if model.good is not None else None
        for batch in batches:
            good = probabilities(model, measure, batch.column(at).fill_null("").cast(pa.binary())) >= threshold
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
