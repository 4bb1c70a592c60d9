"""Toxicity by FTRL-proximal logistic regression over hashed words, word pairs and skip-pairs.

Words are lower-cased (A-Z) and lose ASCII punctuation at either end (words of nothing else stay whole). Features are words, pairs of neighbours and pairs
with one word between them, hashed to ``2 ** BITS`` places and counted once per text. Learning rates are kept per
coordinate and L1 leaves few weights, which are sent to the scoring tasks as two short arrays.

Edge cases: null and blank texts have no feature and get the bias' probability. With labels of one class only the
bias alone decides; without labels every score is 0.5. Repeated rows and ids are scored row by row. An empty table gives
an empty result. Extra columns are not read. The training sample is bounded by ``per_class`` (documents of a class, in
expectation) and is learned in one task, in an order fixed by a hash of the id; scoring covers every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.kernels import Words, mix, text_slices
from corpusloom.llm.shared import bounded_sample, modest_batches

BITS = 20
PER_CLASS = 5000
EPOCHS = 6
ALPHA, BETA, L1, L2 = 2.0, 1.0, 8.0, 0.01


@dataclass(frozen=True)
class Model:
    """Places with a weight, their weights, and the bias."""

    places: np.ndarray
    weights: np.ndarray
    bias: float


def feature_runs(raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, place) arrays for words, pairs and skip-pairs; a feature that occurs again is given again."""
    words = Words(raw, offsets, lower=True)
    h = words.span_hashes(*words.bare_spans())
    shift = np.uint64(64 - BITS)
    out = [(words.row, (h >> shift).astype(np.int64))]
    for gap, salt in ((1, 0xA24BAED4963EE407), (2, 0x9FB21C651E98DF25)):
        if len(h) > gap:
            same = words.row[:-gap] == words.row[gap:]
            pair = mix(h[:-gap] * np.uint64(salt) + h[gap:])[same]
            out.append((words.row[:-gap][same], (pair >> shift).astype(np.int64)))
    return out


def train(examples: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> Model:
    """FTRL-proximal over (distinct places, label) examples in the given order."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last place is the bias, without L1

    def weights(at: np.ndarray) -> np.ndarray:
        pull = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1 * (at < size), 0)
        return -pull / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for places, label in examples:
            at = np.append(places, size)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    w = weights(np.arange(size + 1))
    places = np.flatnonzero(w[:size])
    return Model(places, w[places].astype(np.float32), float(w[size]))


def fit_labelled(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text",
    per_class: int = PER_CLASS,
) -> Model:
    """Fit on a bounded sample of labelled rows, in one task; only the weights reach the driver."""
    modest_batches(docs.sparkSession)
    keys = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    chosen = bounded_sample(keys.filter("_id is not null and _label in (0, 1)"), "_id", "_label", per_class)
    rows = (
        docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
        .join(F.broadcast(chosen), "_id")
        .select("_text", "_label", F.xxhash64(F.col("_id").cast("string"), F.lit("order")).alias("_order"))
    )

    def learn(batches):
        examples = []
        for batch in batches:
            labels_, order = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for lo, hi, raw, offsets in text_slices(batch.column(0)):
                runs = feature_runs(raw, offsets)
                row = np.concatenate([r for r, _ in runs])
                place = np.concatenate([p for _, p in runs])
                key = np.unique(row << (BITS + 1) | place)
                cut = np.searchsorted(key, np.arange(hi - lo + 1) << (BITS + 1))
                at = key & ((1 << BITS) - 1)
                for i in range(hi - lo):
                    examples.append((int(order[lo + i]), at[cut[i] : cut[i + 1]], int(labels_[lo + i])))
        examples.sort(key=lambda e: (e[0], e[2], len(e[1])))
        if examples:
            model = train([e[1:] for e in examples])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(model.places, -1)), pa.array(np.append(model.weights, model.bias).astype(float))],
                ["place", "weight"],
            )

    got = rows.repartition(1).mapInArrow(learn, "place long, weight double").toPandas()
    body = got[got.place >= 0].sort_values("place")
    bias = got[got.place < 0].weight
    return Model(
        body.place.to_numpy(np.int64), body.weight.to_numpy(np.float32), float(bias.iloc[0]) if len(bias) else 0.0
    )


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; one pass over whole texts, no shuffle."""
    modest_batches(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], T.StructField("score", T.DoubleType())])

    def run(batches):
        table = np.zeros(1 << BITS, np.float32)
        table[model.places] = model.weights
        for batch in batches:
            for lo, hi, raw, offsets in text_slices(batch.column(1)):
                keys = []
                for row, place in feature_runs(raw, offsets):
                    hit = np.flatnonzero(table[place])
                    keys.append(row[hit] << (BITS + 1) | place[hit])
                key = np.unique(np.concatenate(keys))
                total = np.bincount(key >> (BITS + 1), table[key & ((1 << BITS) - 1)].astype(float), hi - lo)
                got = 1 / (1 + np.exp(-np.clip(total + model.bias, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(got)], [id_col, "score"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)
