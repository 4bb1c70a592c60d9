"""Quality rules by weak supervision.

Every rule looks at counts of one whole text and votes good (1), bad (-1) or abstains (0). Expectation-maximisation
over the counts of vote patterns estimates how accurate each rule is in either class, without labels; a document is
kept if its posterior probability of being good reaches the threshold.

Edge cases: a null or blank text has no words: every count is 0, it fails the base test and its posterior is the one of
its vote pattern. Repeated rows and repeated ids are scored row by row. An empty table gives an empty result. Extra
columns of the input are not read. Hashes of 64 bits stand for lines and windows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.kernels import Words, per_row, row_duplicates, text_slices
from corpusloom.llm.shared import modest_batches, staged

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
ROUNDS = 100
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
    "n_distinct", "n_marked_words", "n_lone_marks",
)


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


SYMBOLS = _table(b"#*$%&|<>")
UPPER = _table(bytes(range(ord("A"), ord("Z") + 1)))
LETTER = _table(bytes(range(ord("A"), ord("Z") + 1)) + bytes(range(ord("a"), ord("z") + 1)) + bytes(range(0xC0, 0x100)))
MARK = _table(b"!?#*$%&|<>=~^")


def count_slice(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each row of a slice."""
    n = len(offsets) - 1
    words = Words(raw, offsets)
    code_points = words.inside & ((raw & 0xC0) != 0x80)
    hashes = words.hashes

    cut = raw == 0x0A
    line_start = np.union1d(offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(cut) + 1)
    line_start = line_start[line_start < len(raw)]
    row_of = np.searchsorted(offsets, line_start, "right") - 1
    line_end = np.append(line_start[1:], len(raw))
    closed = line_end > line_start
    closed &= cut[np.maximum(line_end - 1, 0)]
    line_end = line_end - closed
    in_words = np.concatenate(([0], np.cumsum(words.inside, dtype=np.int64)))
    worded = in_words[line_end] > in_words[line_start]
    line_start, line_end, row_of = line_start[worded], line_end[worded], row_of[worded]
    order, again = row_duplicates(row_of, words.span_hashes(line_start, line_end))
    dup_lines = np.bincount(row_of[order][again], minlength=n)

    first, grams = words.ngrams(hashes, WINDOW)
    order, again = row_duplicates(words.row[first], grams)
    twice = again.copy()
    twice[:-1] |= again[1:]
    hit = first[order][twice]
    delta = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(delta, hit, 1)
    np.add.at(delta, hit + WINDOW, -1)
    repeated = np.cumsum(delta[:-1]) > 0

    order, again = row_duplicates(words.row, hashes)
    distinct = np.bincount(words.row[order][~again], minlength=n)
    marks = np.concatenate(([0], np.cumsum(MARK[raw], dtype=np.int64)))
    marked = marks[words.ends] > marks[words.starts]
    return {
        "n_words": words.counts,
        "word_chars": per_row(code_points, offsets),
        "n_symbols": per_row(SYMBOLS[raw], offsets),
        "n_dup_lines": dup_lines,
        "n_repeat_words": np.bincount(words.row[repeated], minlength=n),
        "n_lines": np.bincount(row_of, minlength=n),
        "n_upper": per_row(UPPER[raw], offsets),
        "n_letters": per_row(LETTER[raw], offsets),
        "n_distinct": distinct,
        "n_marked_words": np.bincount(words.row[marked], minlength=n),
        "n_lone_marks": np.bincount(words.row[marked & (words.ends - words.starts == 1)], minlength=n),
    }


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id and ``COUNTS`` of its whole text."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type)] + [T.StructField(c, T.LongType()) for c in COUNTS])

    def run(batches):
        for batch in batches:
            for lo, hi, raw, offsets in text_slices(batch.column(1)):
                got = count_slice(raw, offsets)
                columns = [pa.array(got[c].astype(np.int64)) for c in COUNTS]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *columns], [id_col, *COUNTS])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def _band(value: Column, good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rule_votes() -> dict[str, Column]:
    """Named rules over ``COUNTS``; each is a vote of 1, -1 or 0. The cut points are parameters of the rules."""
    ratio = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    symbols, dup = ratio("n_symbols", "word_chars"), ratio("n_dup_lines", "n_lines")
    repeat, upper = ratio("n_repeat_words", "n_words"), ratio("n_upper", "n_letters")
    length, variety = ratio("word_chars", "n_words"), ratio("n_distinct", "n_words")
    marked, letters = ratio("n_marked_words", "n_words"), ratio("n_letters", "word_chars")
    long_enough = F.col("n_words") >= 40
    bad_if = lambda bad: F.when(bad, -1).otherwise(0)
    return {
        "symbols": bad_if(symbols >= 0.04),
        "dup_lines": bad_if(dup >= 0.3),
        "capitals": bad_if(upper >= 0.5),
        "variety": bad_if(long_enough & (variety <= 0.15)),
        "marked_words": bad_if(marked >= 0.3),
        "lone_marks": bad_if(ratio("n_lone_marks", "n_words") >= 0.15),
        "letters": _band(letters, letters >= 0.9, letters <= 0.75),
        "repeats": _band(repeat, (repeat <= 0.05) & long_enough, repeat >= 0.2),
        "word_length": _band(length, length.between(3.0, 10.0), (length < 2.0) | (length > 20.0)),
        "enough": _band(F.col("n_words"), F.col("n_words") >= 50, F.col("n_words") < 10),
    }


def fit_label_model(patterns: np.ndarray, weights: np.ndarray, rounds: int = ROUNDS, prior: float = 0.8) -> dict:
    """Estimate by EM the prior and, for each class and rule, how often it votes bad, abstains and votes good.

    patterns: distinct vote rows (-1, 0, 1); weights: documents with each. A rule that abstains on clean texts tells by
    voting at all, so abstentions are an outcome of their own. Starts from majority votes in which a bad vote counts
    double, which fixes the sign; pseudo-counts keep every share above 0. ``accuracy`` is the share of right votes among
    a rule's votes in each class.
    """
    lean = (patterns == 1).sum(1) - 2 * (patterns == -1).sum(1) - 2 + np.log(prior / (1 - prior))
    good = 1 / (1 + np.exp(-np.clip(lean, -30, 30)))
    outcomes = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    shares = np.zeros((2, patterns.shape[1], 3))
    for _ in range(rounds):
        prior = float((weights * good).sum() + 2) / float(weights.sum() + 4)
        counted = [((weights * share)[:, None, None] * outcomes).sum(0) + 0.5 for share in (1 - good, good)]
        shares = np.stack([c / c.sum(1, keepdims=True) for c in counted])
        good = posterior(patterns, shares, prior)
    right = np.stack([shares[0, :, 0], shares[1, :, 2]])
    accuracy = right / (shares[:, :, 0] + shares[:, :, 2])
    return {"shares": shares, "accuracy": accuracy, "prior": prior, "posterior": good}


def posterior(patterns: np.ndarray, shares: np.ndarray, prior: float) -> np.ndarray:
    """Probability of a good document for each vote row."""
    evidence = np.log(shares[1]) - np.log(shares[0])
    logit = np.log(prior / (1 - prior)) + evidence[np.arange(patterns.shape[1]), patterns + 1].sum(1)
    return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Add votes, posterior and verdict to the counts of every row.

    Texts are read once: counts (a few dozen bytes a row) are staged, grouped by vote pattern (3 ** rules groups at
    most, so what reaches the driver has a fixed bound) and joined with the posterior of their pattern.
    """
    modest_batches(docs.sparkSession)
    rules = rule_votes()
    counts = staged(text_counts(docs, id_col, text_col), "rules")
    code = sum(((vote + 1) * 3**i for i, vote in enumerate(rules.values())), F.lit(0))
    voted = counts.withColumn("votes", code.cast("int"))
    seen = voted.groupBy("votes").count().collect()
    codes = np.array([r["votes"] for r in seen], np.int64)
    patterns = codes[:, None] // 3 ** np.arange(len(rules)) % 3 - 1
    found = posterior_of = np.zeros(0)
    if len(seen):
        found = fit_label_model(patterns, np.array([r["count"] for r in seen], float))
        posterior_of = found["posterior"]
    table = docs.sparkSession.createDataFrame(
        [(int(c), float(p)) for c, p in zip(codes, posterior_of, strict=True)], "votes int, quality_probability double"
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return (
        voted.join(F.broadcast(table), "votes", "left")
        .withColumn("base_failed", base_failed)
        .withColumn("kept", ~base_failed & (F.col("quality_probability") >= threshold))
    )
