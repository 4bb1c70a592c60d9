"""Benchmark decontamination: rare word pairs as seeds, then Smith-Waterman alignment over words.

An alignment scores 1 for a match, -1 for a mismatch and a gap, and counts if it reaches half of the item's words, or
``ENOUGH``. One that scores s has at least s - 1 pairs of neighbouring words that stand side by side in both texts, however
densely the copy is edited, and spans at most twice the item's words less s. So, without losing any alignment that counts:

* of an item's pairs, all but the s - 2 that most test items hold are its seeds; a text without a seed of the item is left;
* all pairs of an item whose seed was met are looked up in the text, and s - 1 of them must stand within that span;
* the stretches around such places are kept as windows of word hashes; windows that share fewer than s words with the item
  are left, all others are aligned. Windows of one item are aligned together, equal ones once in a batch.

Words are lower-cased and lose ASCII punctuation at either end (words of nothing else stay whole). Test items are taken in
blocks of ``ITEM_WORDS`` words, so what the tasks get is bounded for a test set of any size; each block is one scan of the
texts.

Edge cases: null and blank texts match nothing. Items of three and four words must be there as they are, items of one or two
words are too short to tell and match nothing. Repeated rows each give their own matches; items with equal texts each match.
Empty tables give an empty result. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.kernels import Words, mix, text_slices
from corpusloom.llm.shared import SALTS, modest_batches, salt, staged, unused

PAIR = 2
SHORTEST, EDITABLE = 3, 5
ITEM_WORDS = 4_000_000
SHARE, ENOUGH = 0.5, 20
BROADCAST_TEXTS = 2_000_000
CELLS = 1 << 18
RUN_PAIRS = 1 << 17


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words of a slice and the hashes of what is left of them without outer punctuation."""
    words = Words(raw, offsets)
    return words, words.span_hashes(*words.bare_spans())


def needed(n_words: int) -> int:
    """The score from which an alignment with an item of so many words counts."""
    return n_words if n_words < EDITABLE else max(EDITABLE, min(int(np.ceil(SHARE * n_words)), ENOUGH))


def expanded(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, place) of all places in the ranges ``[start, end)``."""
    n = ends - starts
    which = np.repeat(np.arange(len(n)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n - starts, n)


class Items:
    """Word hashes of a block of test items, their pairs of words, and which of those are seeds."""

    def __init__(self, ids: list, texts: list[str | None]):
        self.ids: list = []
        self.words: list[np.ndarray] = []
        column = pa.array([(t or "").lower() for t in texts], pa.string())
        for lo, hi, raw, offsets in text_slices(column):
            words, hashes = word_hashes(raw, offsets)
            for i in range(lo, hi):
                a, b = words.bounds[i - lo : i - lo + 2]
                if b - a >= SHORTEST:
                    self.ids.append(ids[i])
                    self.words.append(hashes[a:b])
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.need = np.array([needed(len(w)) for w in self.words], np.int64)
        flat = np.concatenate(self.words) if self.words else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(self.words)), self.lengths)
        first = np.flatnonzero(item[:-1] == item[1:])
        # the pairs of all items one after the other; ``pairs`` are the distinct ones, ``pair`` their numbers
        hashes = pair_hashes(flat[first], flat[first + 1])
        self.pairs, self.pair = np.unique(hashes, return_inverse=True)
        self.bounds = np.searchsorted(item[first], np.arange(len(self.words) + 1))
        held = np.unique(item[first] * max(1, len(self.pairs)) + self.pair)
        items_with = np.bincount(held % max(1, len(self.pairs)), minlength=len(self.pairs))
        _, at, uses = np.unique(flat, return_inverse=True, return_counts=True)
        common_words = np.minimum(uses[at[first]], uses[at[first + 1]])
        order = np.lexsort((hashes, common_words, items_with[self.pair], item[first]))
        rank = np.arange(len(order)) - self.bounds[item[first][order]]
        own = item[first][order]
        seeds = order[rank < self.lengths[own] - self.need[own] + 1]
        held = np.unique(self.pair[seeds] * max(1, len(self.words)) + item[first][seeds])
        self.seed_item = held % max(1, len(self.words))
        self.seed_bounds = np.searchsorted(held // max(1, len(self.words)), np.arange(len(self.pairs) + 1))
        self.mask = np.uint64((1 << max(16, int(len(self.pairs)).bit_length() + 3)) - 1)
        self.bitmap = np.zeros(int(self.mask) + 1, bool)
        self.bitmap[(self.pairs & self.mask).astype(np.int64)] = True

    def met(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indexes into ``hashes``, pair numbers) of those that are pairs of an item."""
        if not len(self.pairs):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.bitmap[(hashes & self.mask).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.pairs, hashes[maybe]), len(self.pairs) - 1)
        real = self.pairs[at] == hashes[maybe]
        return maybe[real], at[real]

    def stretches(self, row: np.ndarray, place: np.ndarray, pair: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(row, item, begin, end) of the stretches of texts that hold enough pairs of an item close together.

        row, place, pair: where the texts hold a pair of any item, in ascending order of row and place. They come in runs of
        candidates (a text and an item with a seed in it) whose items have about ``RUN_PAIRS`` pairs: where many items share a
        template, each text that holds it is a candidate for each of them.
        """
        at, seed = expanded(self.seed_bounds[pair], self.seed_bounds[pair + 1])
        both = np.unique(row[at] * max(1, len(self.words)) + self.seed_item[seed])
        if not len(both):
            return
        key = row * len(self.pairs) + pair
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
        item = both % len(self.words)
        run = np.cumsum(self.bounds[item + 1] - self.bounds[item]) // RUN_PAIRS
        for part in np.split(both, np.flatnonzero(np.diff(run)) + 1):
            found = self.stretches_of(part // len(self.words), part % len(self.words), key, place)
            if len(found[0]):
                yield found

    def stretches_of(self, c_row: np.ndarray, c_item: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
        """``stretches`` of some candidates. key: the row and pair of each place as one number, ascending."""
        none = (np.zeros(0, np.int64),) * 4
        which, at = expanded(self.bounds[c_item], self.bounds[c_item + 1])
        wanted = c_row[which] * len(self.pairs) + self.pair[at]
        lo = np.searchsorted(key, wanted)
        there = key[np.minimum(lo, len(key) - 1)] == wanted
        enough = np.bincount(which[there], minlength=len(c_row)) >= self.need[c_item] - 1
        keep = there & enough[which]
        which, lo, wanted = which[keep], lo[keep], wanted[keep]
        if not len(which):
            return none
        found, at = expanded(lo, np.searchsorted(key, wanted, "right"))
        span = np.int64(place.max() + 1)
        spots = np.unique(which[found] * span + place[at])
        which, spot = spots // span, spots % span
        need, reach = self.need[c_item[which]], 2 * self.lengths[c_item[which]] - self.need[c_item[which]]
        last = np.arange(len(which)) + need - 2
        inside = last < len(which)
        last = np.minimum(last, len(which) - 1)
        close = np.flatnonzero(inside & (which[last] == which) & (spot[last] - spot <= reach))
        if not len(close):
            return none
        which, begin, end = which[close], spot[last[close]] - reach[close], spot[close] + reach[close]
        new = np.concatenate(([True], (which[1:] != which[:-1]) | (begin[1:] > end[:-1])))
        heads = np.flatnonzero(new)
        tails = np.append(heads[1:], len(which)) - 1
        return c_row[which[heads]], c_item[which[heads]], begin[heads], end[tails]


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mix(first * np.uint64(0x9FB21C651E98DF25) + second)


WINDOWS = "item int, start long, words array<long>"


def seed_windows(docs: DataFrame, items: Items, id_col: str, text_col: str) -> DataFrame:
    """(id, item, start, words): a row for each stretch of a text that may hold a copy of an item."""
    schema = T.StructType([docs.schema[id_col], *T._parse_datatype_string(WINDOWS).fields])

    def run(batches):
        for batch in batches:
            for lo, _, raw, offsets in text_slices(batch.column(1)):
                words, hashes = word_hashes(raw, offsets)
                first = np.flatnonzero(words.row[:-1] == words.row[1:])
                at, pair = items.met(pair_hashes(hashes[first], hashes[first + 1]))
                place = first[at]
                for row, item, begin, end in items.stretches(words.row[place], place, pair):
                    begin, end = np.maximum(begin, words.bounds[row]), np.minimum(end, words.bounds[row + 1])
                    _, within = expanded(begin, end)
                    bounds = pa.array(np.concatenate(([0], np.cumsum(end - begin))).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(lo + row)),
                            pa.array(item.astype(np.int32)),
                            pa.array(begin - words.bounds[row]),
                            pa.ListArray.from_arrays(bounds, pa.array(hashes.view(np.int64)[within])),
                        ],
                        [id_col, "item", "start", "words"],
                    )

    return docs.select(F.col(id_col), F.lower(F.col(text_col))).mapInArrow(run, schema)


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """(score, item end, window end) of the best local alignment; match 1, mismatch and gap -1.

    A row of the table comes from the last one at once: gaps along the row are a running maximum with a slope.
    """
    slope = np.arange(len(window) + 1)
    above = np.zeros(len(window) + 1, np.int64)
    best = (0, 0, 0)
    for i, word in enumerate(item):
        row = np.maximum(above - 1, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(window == word, 1, -1))
        above = np.maximum.accumulate(row + slope) - slope
        top = int(above.argmax())
        if above[top] > best[0]:
            best = (int(above[top]), i + 1, top)
    return best


def padded(windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(table with a window in each row, flags of the places that are words)."""
    lengths = np.array([len(w) for w in windows])
    real = np.arange(lengths.max(initial=0)) < lengths[:, None]
    table = np.zeros(real.shape, np.uint64)
    table[real] = np.concatenate(windows)
    return table, real


def runs_of(windows: list[np.ndarray], n_words: int) -> list[np.ndarray]:
    """Numbers of the windows in groups of like lengths, so that a group's tables have about ``CELLS`` places."""
    groups, here = [], []
    for i in np.argsort([len(w) for w in windows], kind="stable").tolist():
        if here and (len(here) + 1) * (max(len(windows[i]), n_words) + 1) > CELLS:
            groups.append(np.array(here))
            here = []
        here.append(i)
    return [*groups, np.array(here)] if here else groups


def align_all(item: np.ndarray, windows: list[np.ndarray]) -> np.ndarray:
    """A row for each window with what ``align`` gives."""
    out = np.zeros((len(windows), 3), np.int64)
    for group in runs_of(windows, len(item)):
        table, real = padded([windows[i] for i in group])
        slope = np.arange(table.shape[1] + 1, dtype=np.int32)
        above = np.zeros((len(group), table.shape[1] + 1), np.int32)
        best, every = np.zeros((len(group), 3), np.int64), np.arange(len(group))
        for i, word in enumerate(item):
            row = np.maximum(above - 1, 0)
            row[:, 1:] = np.maximum(row[:, 1:], above[:, :-1] + np.where((table == word) & real, 1, -1).astype(np.int32))
            above = np.maximum.accumulate(row + slope, axis=1) - slope
            top = above.argmax(1)
            score = above[every, top]
            up = np.flatnonzero(score > best[:, 0])
            best[up] = np.stack((score[up], np.full(len(up), i + 1), top[up]), 1)
        out[group] = best
    return out


def may_reach(item: np.ndarray, windows: list[np.ndarray]) -> np.ndarray:
    """Flags of the windows that share enough words with the item: each match uses up one word of either."""
    distinct, times = np.unique(item, return_counts=True)
    out = np.zeros(len(windows), bool)
    for group in runs_of(windows, len(item)):
        table, real = padded([windows[i] for i in group])
        at = np.minimum(np.searchsorted(distinct, table), len(distinct) - 1)
        row, column = np.nonzero((distinct[at] == table) & real)
        seen = np.bincount(row * len(distinct) + at[row, column], minlength=len(group) * len(distinct))
        out[group] = np.minimum(seen.reshape(len(group), -1), times).sum(1) >= needed(len(item))
    return out


def passages(item: np.ndarray, windows: list[np.ndarray]) -> dict[int, tuple[int, int, int]]:
    """(score, start, end) of the aligned stretch of each window whose score counts, by the window's number."""
    whole = np.flatnonzero(may_reach(item, windows))
    ahead = align_all(item, [windows[i] for i in whole])
    counts = ahead[:, 0] >= needed(len(item))
    whole, ahead = whole[counts], ahead[counts]
    found = {}
    for item_end in np.unique(ahead[:, 1]):
        own = np.flatnonzero(ahead[:, 1] == item_end)
        back = align_all(item[:item_end][::-1], [windows[whole[k]][: ahead[k, 2]][::-1] for k in own])
        for k, length in zip(own, back[:, 2], strict=True):
            found[int(whole[k])] = (int(ahead[k, 0]), int(ahead[k, 2] - length), int(ahead[k, 2]))
    return found


def match_block(docs: DataFrame, items: Items, id_col: str, text_col: str, item_type: T.DataType) -> DataFrame:
    windows = staged(seed_windows(docs, items, id_col, text_col), "seed-windows")
    schema = T.StructType(
        [docs.schema[id_col], T.StructField("item_id", item_type)]
        + [T.StructField(n, T.LongType()) for n in ("score", "item_words", "start_word", "end_word")]
        + [T.StructField("similarity", T.DoubleType())]
    )

    def run(batches):
        for batch in batches:
            by_item: dict[int, dict[bytes, list[int]]] = {}
            for i, item in enumerate(batch.column(1).to_pylist()):
                by_item.setdefault(item, {}).setdefault(batch.column(3)[i].values.to_numpy().tobytes(), []).append(i)
            start = batch.column(2).to_pylist()
            found, at = [], []
            for item, equal in by_item.items():
                words, rows = items.words[item], list(equal.values())
                got = passages(words, [np.frombuffer(w, np.uint64) for w in equal])
                for number, (score, begin, end) in got.items():
                    for i in rows[number]:
                        found.append((items.ids[item], score, len(words), start[i] + begin, start[i] + end, score / len(words)))
                        at.append(i)
            if found:
                kinds = [pa.int64()] * 4 + [pa.float64()]
                values = [pa.array([f[0] for f in found])]
                values += [pa.array([f[k + 1] for f in found], t) for k, t in enumerate(kinds)]
                names = [id_col, "item_id", "score", "item_words", "start_word", "end_word", "similarity"]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *values], names)

    return windows.mapInArrow(run, schema)


def matches(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item_id, score, item_words, start_word, end_word, similarity): every aligned stretch of every text."""
    modest_batches(docs.sparkSession)
    items = benchmark.select(F.col(item_col).alias("_id"), F.col(item_text_col).alias("_text"))
    words = items.select(F.sum(F.size(F.split("_text", "[\\x20\\x09-\\x0D]+")))).first()[0] or 0
    n_blocks = words // ITEM_WORDS + 1
    block = F.pmod(F.xxhash64(F.col("_id").cast("string"), "_text"), F.lit(n_blocks))
    item_type = benchmark.schema[item_col].dataType
    out = None
    for b in range(n_blocks):
        got = sorted(items.filter(block == b).collect(), key=lambda r: (r["_id"] is None, r["_id"], r["_text"] or ""))
        found = match_block(docs, Items([r[0] for r in got], [r[1] for r in got]), id_col, text_col, item_type)
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text has no match; ids play no part, so rows that share one or have none are told apart."""
    text, hit_col, salt_col = F.col(text_col), unused("hit", docs), unused("hit_salt", docs)
    print_of = F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))
    hit = matches(docs.select(print_of.alias("print"), text.alias("text")), benchmark, "print", "text")
    hit = staged(hit.select(F.col("print").alias(hit_col)).distinct(), "contaminated")
    same = print_of == F.col(hit_col)
    if hit.count() <= BROADCAST_TEXTS:
        return docs.join(F.broadcast(hit), same, "left_anti")
    # rows of a text that many share are dealt over the salts
    hit = hit.withColumn(salt_col, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return docs.join(hit.hint("shuffle_hash"), same & (salt(F.col(id_col)) == F.col(salt_col)), "left_anti")
