"""Alignment of two tokenizers' tokens over the same bytes.

Tasks tokenise: a row gets the ids and the ends (in bytes) of its tokens under either tokenizer. Groups and links are made by
built-in functions. The ends that both share (``array_intersect``) cut a text into groups. An array with a place
for each byte says which token holds it, so a group's tokens are the ``sequence`` of token numbers between two shared ends,
and the links (pairs of tokens that share bytes) are the tokens that hold the last byte before each end of either side.

How many documents hold a pair of ids linked is counted over the corpus, a document's distinct pairs with the number of their
links. Those counts go back to the documents: the most frequent pairs, ``FREQUENT`` at most, by a broadcast; all others, which few
documents hold each, by a shuffled join.

Neither tokenizer joins anything across a space that stands after a printable character, so texts are cut there into units. A
unit is encoded once while its hash is in a worker's table, new units many to a call. No group crosses a unit's end, and where groups
and links lie in a unit follows from its shape, the sizes of its tokens on either side. So they are made once for each shape of a task,
as numbers of tokens (``packed_rows``, ``aligned``); shapes stand as rows before the units that have them, units before the texts that
hold them, many to a row. A unit's groups and links are those of its shape with its ids put in, and a text's are its units' one after
the other (``put_together``: nothing but gathering, hashing and counting, by Arrow and numpy). Tokenizers of which this isn't known
(see ``Pair``) have a unit for each text. ``tokenised`` and ``aligned`` give all of it text by text.

Edge cases: a text that is null or empty, or whose tokens don't spell out a space and the text under either tokenizer (U+2581 under a
sentencepiece model), has no tokens, groups or links; its sums are 0. Repeated rows and ids are aligned row by row, and each counts
as a document. An empty table gives an empty result. Extra columns are not read. A long unit's tables take some tens of bytes a
byte of text; of texts ``SLICE`` bytes are tokenised and ``UNITS_AT_ONCE`` units put together at a time, and a worker's table is emptied
beyond ``UNITS_KEPT`` units or ``TOKENS_KEPT`` tokens.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.kernels import WHITESPACE, Words, release, text_slices
from corpusloom.llm.shared import modest_batches, staged
from corpusloom.llm.token_counts import byte_symbols

SLICE = 1 << 20
UNITS_KEPT, TOKENS_KEPT = 1_200_000, 8_000_000
UNITS_AT_ONCE = 300_000
UNITS_A_CALL = 100
UNITS_SPELT = 20_000
FREQUENT = 500_000
SPACE = "▁"
PRINTABLE = np.zeros(256, bool)
PRINTABLE[0x21:0x7F] = True


class Pair:
    """Two tokenizers and a table of the units that they have met: A from a .json of byte-level BPE, B a sentencepiece .model."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        symbol = byte_symbols()
        self.bytes_a = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            self.bytes_a[i] = bytes(symbol[c] for c in token)
        self.bytes_b = [self.piece_bytes(i) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(x) for x in own], np.int32) for own in (self.bytes_a, self.bytes_b))
        self.by_units = self.splits_at_spaces(path_a)
        self.units_kept, self.tokens_kept = UNITS_KEPT, TOKENS_KEPT
        self.times_cleared = 0
        self.clear()

    def piece_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace(SPACE, " ").encode()

    def splits_at_spaces(self, path_a: str) -> bool:
        """Whether both tokenizers are of the kinds that join nothing across a space after a printable character."""
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        splitter = spec["pre_tokenizer"] or {}
        plain_a = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space")
        pieces = (self.b.id_to_piece(i) for i in range(self.b.get_piece_size()))
        plain_b = all(SPACE not in p.lstrip(SPACE) for p in pieces) and self.b.encode("a  b ", out_type=str)[0] == SPACE + "a"
        return bool(plain_a and spec["normalizer"] is None and plain_b)

    def clear(self) -> None:
        self.times_cleared += 1
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.numbers = np.zeros(0, np.int32)  # of the units, by sorted hash
        self.fine = np.zeros(0, bool)  # by number
        self.shapes = np.zeros(0, np.int32)  # by number
        self.shape_hashes, self.shape_numbers = self.hashes, self.numbers
        self.starts = [np.zeros(1, np.int64), np.zeros(1, np.int64)]
        self.ids = [np.zeros(0, np.min_scalar_type(len(sizes))) for sizes in (self.size_a, self.size_b)]

    def encode_calls(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, bool]]:
        """(ids of A, ids of B, whether both spell out the text) of texts that begin with a space."""
        plain = [t.decode("utf-8", "replace") for t in texts]
        ids_a = [e.ids for e in self.a.encode_batch_fast(plain, add_special_tokens=False)]
        ids_b = self.b.encode([t[1:] for t in plain], num_threads=1)
        out = []
        for text, a, b in zip(texts, ids_a, ids_b, strict=True):
            spelt = b"".join([self.bytes_a[i] for i in a]) == text and b"".join([self.bytes_b[i] for i in b]) == text
            out.append((np.array(a, np.int32), np.array(b, np.int32), spelt and bool(text)))
        return out

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """(order, (ids one after the other, number of ids of each unit) under A and B, whether they spell out each unit).

        All but the order is in that order. Units that end in a printable character go many to a call.
        """
        closed = [i for i, u in enumerate(units) if len(u) > 1 and 0x21 <= u[-1] < 0x7F] if self.by_units else []
        runs = [closed[k : k + UNITS_A_CALL] for k in range(0, len(closed), UNITS_A_CALL)]
        order, ids, counts, fine = [], ([], []), ([], []), []
        for run, (a, b, spelt) in zip(runs, self.encode_calls([b"".join([units[i] for i in r]) for r in runs]), strict=True):
            if not spelt:
                continue
            bounds = np.cumsum([len(units[i]) for i in run])
            cuts = []
            for own, sizes in ((a, self.size_a), (b, self.size_b)):
                ends = np.cumsum(sizes[own])
                at = np.searchsorted(ends, bounds)
                if np.array_equal(ends[at], bounds):
                    cuts.append(np.diff(at, prepend=-1))
            if len(cuts) == 2:
                order += run
                fine.append(np.ones(len(run), bool))
                for side, own in enumerate((a, b)):
                    ids[side].append(own)
                    counts[side].append(cuts[side])
        left = np.ones(len(units), bool)
        left[order] = False
        rest = np.flatnonzero(left).tolist()
        for found in self.encode_calls([units[i] for i in rest]):
            fine.append(np.array([found[2]]))
            for side in (0, 1):
                ids[side].append(found[side] if found[2] else found[side][:0])
                counts[side].append(np.array([len(ids[side][-1])]))
        return np.array(order + rest), [(np.concatenate(ids[side]), np.concatenate(counts[side])) for side in (0, 1)], np.concatenate(fine)

    def shapes_of(self, sides: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Numbers of the shapes of units, given as (ids, number of ids of each unit) under A and B; new shapes are added."""
        ends = [np.cumsum(sizes[ids], dtype=np.int64) for (ids, _), sizes in zip(sides, (self.size_a, self.size_b), strict=True)]
        bounds = np.concatenate(([0], ends[0]))[np.concatenate(([0], np.cumsum(sides[0][1])))]
        marks = np.zeros(bounds[-1], np.uint8)  # for each byte, of which sides a token ends there
        for side in (0, 1):
            marks[ends[side] - 1] += side + 1
        hashes = Words(marks, bounds).span_hashes(bounds[:-1], bounds[1:])
        distinct, back = np.unique(hashes, return_inverse=True)
        at = np.searchsorted(self.shape_hashes, distinct)
        new = np.append(self.shape_hashes, np.uint64(0))[at] != distinct
        new |= at == len(self.shape_hashes)
        numbers = len(self.shape_hashes) + np.arange(new.sum())
        self.shape_numbers = np.insert(self.shape_numbers, at[new], numbers)
        self.shape_hashes = np.insert(self.shape_hashes, at[new], distinct[new])
        return self.shape_numbers[np.searchsorted(self.shape_hashes, distinct)][back]

    def lookup(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: bytes) -> np.ndarray:
        """Numbers of the units at the given spans; units that aren't in the table are encoded and added."""
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(new):
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            order, sides, fine = self.encode_units([data[a:b] for a, b in spans])
            for side, (ids, n) in enumerate(sides):
                self.ids[side] = np.concatenate((self.ids[side], ids.astype(self.ids[side].dtype)))
                self.starts[side] = np.concatenate((self.starts[side], self.starts[side][-1] + np.cumsum(n)))
            numbers = np.empty(len(new), np.int32)
            numbers[order] = len(self.fine) + np.arange(len(new))
            self.fine = np.concatenate((self.fine, fine))
            self.shapes = np.concatenate((self.shapes, self.shapes_of(sides)))
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self.numbers = np.insert(self.numbers, at[new], numbers)
            at = np.searchsorted(self.hashes, distinct)
        return self.numbers[at][back]

    def cuts(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the units of a slice whose rows begin with a space each."""
        inner = np.zeros(len(raw) + 1, bool)
        if self.by_units and len(raw) > 2:
            before, after = raw[:-2], raw[2:]
            inner[1:-2] = (raw[1:-1] == 0x20) & (PRINTABLE[before] | ((before >= 0x80) & PRINTABLE[after]))
            inner[offsets[1:] - 1] = False  # a space at the end of a row
        inner[offsets] = True
        return np.flatnonzero(inner[:-1])

    def units(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(numbers, starts, ends, bounds of the rows) of the units of a slice whose rows begin with a space each.

        Rows with a unit that its tokens don't spell out have no units.
        """
        if len(self.fine) > self.units_kept or max(map(len, self.ids)) > self.tokens_kept:
            self.clear()
        starts = self.cuts(raw, offsets)
        ends = np.append(starts[1:], len(raw))[: len(starts)]
        hashes = Words(raw, offsets).span_hashes(starts, ends)
        units = self.lookup(hashes, starts, ends, raw.tobytes()) if len(starts) else np.zeros(0, np.int64)
        bounds = np.searchsorted(starts, offsets)
        bad = np.diff(np.concatenate(([0], np.cumsum(~self.fine[units])))[bounds]) > 0
        n = np.diff(bounds)
        keep = ~np.repeat(bad, n)
        return units[keep], starts[keep], ends[keep], np.concatenate(([0], np.cumsum(np.where(bad, 0, n))))

    def tokens(self, side: int, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the units one after the other, number of ids of each)."""
        first = self.starts[side][units]
        n = self.starts[side][units + 1] - first
        total = np.concatenate(([0], np.cumsum(n)))
        return self.ids[side][np.repeat(first - total[:-1], n) + np.arange(total[-1])].astype(np.int32), n

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For A and B: (ids, ends in bytes from the row's start, bounds of the rows) of a slice whose rows begin with a space each."""
        units, starts, _, bounds = self.units(raw, offsets)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        out = []
        for side, sizes in ((0, self.size_a), (1, self.size_b)):
            ids, n = self.tokens(side, units)
            sums = np.cumsum(sizes[ids], dtype=np.int64)
            before = np.concatenate(([0], sums))[np.cumsum(n) - n]
            ends = sums - np.repeat(before - (starts - offsets[row]), n)
            out.append((ids, ends.astype(np.int32), np.concatenate(([0], np.cumsum(n)))[bounds]))
        return out


_pairs: dict[tuple[str, str], Pair] = {}


def pair(path_a: str, path_b: str) -> Pair:
    """One pair for each worker process and files."""
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


def spaced(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slice with a space before each row that isn't empty."""
    full = np.diff(offsets) > 0
    out = np.insert(raw, offsets[:-1][full], 0x20)
    return out, offsets + np.concatenate(([0], np.cumsum(full)))


TOKENS = "a_ids array<int>, a_sizes array<int>, a_ends array<int>, b_ids array<int>, b_sizes array<int>, b_ends array<int>"


def tokenised(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, a_ids, a_sizes, a_ends, b_...) of every row: tokens under A and B, their bytes, and where they end in space + text."""
    modest_batches(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], *T._parse_datatype_string(TOKENS).fields])

    def run(batches):
        table = pair(path_a, path_b)
        for batch in batches:
            for lo, hi, raw, offsets in text_slices(batch.column(1), SLICE):
                columns = [batch.column(0).slice(lo, hi - lo)]
                sides = table.encode(*spaced(raw, offsets))
                for (ids, ends, bounds), sizes in zip(sides, (table.size_a, table.size_b), strict=True):
                    at = pa.array(bounds.astype(np.int32))
                    columns += [pa.ListArray.from_arrays(at, pa.array(values)) for values in (ids, sizes[ids], ends)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)
        release()

    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(run, schema)


PACKED = (
    "units array<int>, n_a long, n_b long, unit int, unit_shapes array<int>, unit_a array<int>, unit_b array<int>, "
    "shape int, a_sizes array<int>, a_ends array<int>, b_sizes array<int>, b_ends array<int>"
)


def packed_rows(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of three kinds: (id, units, n_a, n_b) of a text; before it those of its units that are new to the task, as (unit: the number
    of the first, unit_shapes, unit_a, unit_b: their ids one after the other); before them (shape, sizes and ends) of each new shape.

    Units and shapes are numbered from 0 within a task, and from 0 again once the table of units has been emptied.
    """
    modest_batches(docs.sparkSession)
    ids = T.StructField("id", docs.schema[id_col].dataType)
    schema = T.StructType([ids, *T._parse_datatype_string(PACKED).fields])

    def run(batches):
        table = pair(path_a, path_b)
        times_cleared, units_sent, shapes_sent = table.times_cleared, Sent(), Sent()
        for batch in batches:
            for lo, hi, raw, offsets in text_slices(batch.column(1), SLICE):
                units, _, _, bounds = table.units(*spaced(raw, offsets))
                if table.times_cleared != times_cleared:
                    times_cleared, units_sent, shapes_sent = table.times_cleared, Sent(), Sent()
                new = units[units_sent.add(units)]
                shapes = table.shapes[new]
                first = shapes_sent.add(shapes)
                of_shapes = {"shape": pa.array(shapes_sent.numbers[shapes[first]])}
                of_units = {"unit": pa.array(units_sent.numbers[new[:1]]), "unit_shapes": one_list(shapes_sent.numbers[shapes])}
                own = pa.array(units_sent.numbers[units])
                of_texts = {"id": batch.column(0).slice(lo, hi - lo), "units": pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), own)}
                for side, sizes in enumerate((table.size_a, table.size_b)):
                    name = "ab"[side]
                    of_units[f"unit_{name}"] = one_list(table.tokens(side, new)[0])
                    ids, n = table.tokens(side, new[first])
                    sums = np.cumsum(sizes[ids])
                    ends = sums - np.repeat(np.concatenate(([0], sums))[np.cumsum(n) - n], n)
                    of_shapes[f"{name}_sizes"], of_shapes[f"{name}_ends"] = lists(sizes[ids], n), lists(ends.astype(np.int32), n)
                    n_own = table.starts[side][units + 1] - table.starts[side][units]
                    of_texts[f"n_{name}"] = pa.array(np.diff(np.concatenate(([0], np.cumsum(n_own)))[bounds]))
                kinds = (of_shapes, len(first)), (of_units, min(len(new), 1)), (of_texts, hi - lo)
                types = {name: values.type for columns, _ in kinds for name, values in columns.items()}
                for columns, rows in kinds:
                    if rows:
                        full = [columns[name] if name in columns else pa.nulls(rows, types[name]) for name in schema.names]
                        yield pa.RecordBatch.from_arrays(full, schema.names)
        release()

    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(run, schema)


def unit_rows(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``packed_rows`` without those of shapes and with a row (unit, shape) for each unit."""
    rows = packed_rows(docs, path_a, path_b, id_col, text_col).filter("shape is null")
    each = F.transform("unit_shapes", lambda shape, k: F.struct((F.col("unit") + k).alias("unit"), shape.alias("shape")))
    return rows.select("id", "units", "n_a", "n_b", F.explode_outer(each).alias("_each")).select("id", "units", "n_a", "n_b", "_each.*")


class Sent:
    """Numbers from 0, in the order of sending, of what a task has sent; -1 for what it hasn't."""

    def __init__(self):
        self.numbers, self.n = np.zeros(0, np.int32), 0

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Where in ``keys`` those that weren't sent stand first, in order; they are numbered in that order."""
        most = int(keys.max(initial=-1)) + 1
        if most > len(self.numbers):
            self.numbers = np.concatenate((self.numbers, np.full(most - len(self.numbers), -1, np.int32)))
        there = np.flatnonzero(self.numbers[keys] < 0)
        first = np.sort(there[np.unique(keys[there], return_index=True)[1]])
        self.numbers[keys[first]] = np.arange(self.n, self.n + len(first))
        self.n += len(first)
        return first


def lists(values: np.ndarray, n: np.ndarray) -> pa.ListArray:
    """Lists of ``n`` consecutive values each."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), pa.array(values))


def one_list(values: np.ndarray) -> pa.ListArray:
    """A list of all values; none at all if there are none."""
    return lists(values, np.array([len(values)][: len(values)], np.int64))


def _steps(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are worked out once a row, before what follows: within a lambda the optimiser would put an
    expression that is used once, to be worked out for each element. It moves nothing across a generator."""
    made = df.select("*", *(column.alias(name) for name, column in columns.items()))
    return made.select("*", F.explode(F.array(F.lit(0))).alias("_once")).drop("_once")


def _spans(ends: Column) -> Column:
    """Lengths of the consecutive spans with the given ends."""
    return F.transform(ends, lambda end, k: end - F.coalesce(F.get(ends, k - 1), F.lit(0)))


def _by_byte(sizes: Column, value) -> Column:
    """For each byte, ``value`` of the number (from 0) of the span that holds it."""
    return F.flatten(F.transform(sizes, lambda n, k: F.array_repeat(value(k), n)))


def faced(tokens: DataFrame) -> DataFrame:
    """``tokens`` with the ends that both sides share, all ends in order, and the id of either side that holds each byte."""
    return _steps(
        tokens, shared=F.array_intersect("a_ends", "b_ends"), ends=F.sort_array(F.array_union("a_ends", "b_ends")),
        **{f"{side}_held": F.flatten(F.zip_with(f"{side}_ids", f"{side}_sizes", F.array_repeat)) for side in "ab"},
    )


def aligned(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``groups`` (array of a, b: the ids of either side) and ``links`` (array of a, b: linked ids), in order."""
    numbers = {f"{side}_number": _by_byte(F.col(f"{side}_sizes"), lambda k: k + 1) for side in "ab"}

    def members(side: str, end: Column, g: Column) -> Column:
        first = F.coalesce(F.element_at(f"{side}_number", F.get("shared", g - 1)), F.lit(0)) + 1
        return F.transform(F.sequence(first, F.element_at(f"{side}_number", end)), lambda k: F.element_at(f"{side}_ids", k)).alias(side)

    groups = F.transform("shared", lambda end, g: F.struct(members("a", end, g), members("b", end, g)))
    links = F.transform("ends", lambda end: F.struct(*(F.element_at(f"{side}_held", end).alias(side) for side in "ab")))
    return _steps(faced(tokens), **numbers).select(*tokens.columns, groups.alias("groups"), links.alias("links"))


def shape_groups(rows: DataFrame) -> DataFrame:
    """``packed_rows`` with the groups and links of each shape, of token numbers from 0, for its sizes and ends."""
    kept = ["id", "units", "n_a", "n_b", "unit", "unit_shapes", "unit_a", "unit_b", "shape"]
    numbered = {f"{side}_ids": F.transform(f"{side}_sizes", lambda _, k: k) for side in "ab"}
    return aligned(rows.withColumns(numbered)).select(*kept, "groups", "links")


REPORT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def put_together(rows: DataFrame, base: int, most_pairs: int) -> DataFrame:
    """A row for each text of ``shape_groups``: its units' groups one after the other, its distinct pairs and how often each is linked.

    A text's units stand before it in its task, so a task keeps what it has met; a pair is a * base + b, ``most_pairs`` more than any.
    """
    schema = T.StructType([rows.schema["id"], *T._parse_datatype_string(REPORT).fields])

    def run(batches):
        shapes, met = MetShapes(base, max(base, most_pairs // base)), MetUnits()
        for batch in batches:
            of_text = pc.and_(*(batch.column(kind).is_null() for kind in ("unit", "shape"))).to_numpy(zero_copy_only=False)
            # runs of rows of one kind
            turns = np.flatnonzero(np.diff(of_text)) + 1
            for lo, hi in zip([0, *turns], [*turns, len(of_text)], strict=True):
                part = batch.slice(lo, hi - lo)
                if not of_text[lo]:
                    shapes.add(part)
                    continue
                for units in shapes.spelt():
                    met.add(units)
                sizes = np.cumsum(pc.list_value_length(part.column("units")).to_numpy())
                cuts = np.searchsorted(sizes, np.arange(UNITS_AT_ONCE, sizes[-1] + 1, UNITS_AT_ONCE), "right")
                cuts = np.unique([0, *cuts, len(sizes)])
                for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    yield pa.RecordBatch.from_arrays(met.report(part.slice(a, b - a), most_pairs), schema.names)
        release()

    return rows.mapInArrow(run, schema)


@cache
def id_texts(n: int) -> pa.Array:
    """Each id below ``n`` with what may follow it: ``,`` within a side, ``|`` between both, ``;`` after a group."""
    return pa.array([f"{i}{mark}" for i in range(n) for mark in ",|;"], pa.large_binary())


def runs_at(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The places of runs of ``n`` each that begin at ``starts``, one after the other."""
    total = np.cumsum(n)
    return np.repeat(starts - (total - n), n) + np.arange(total[-1] if len(total) else 0)


class MetShapes:
    """What array functions gave for the shapes that a task has met, and the units that wait for their shape's."""

    def __init__(self, base: int, n_ids: int):
        self.base, self.texts = base, id_texts(n_ids)
        self.clear()

    def clear(self) -> None:
        none, start = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.tokens, self.sides, self.marks, self.token_starts = none, none.astype(np.int8), none.astype(np.int8), start
        self.links, self.link_starts = [none, none], start
        self.n_groups, self.sizes = none, [none, none]
        self.waiting: list[pa.RecordBatch] = []

    def add(self, rows: pa.RecordBatch) -> None:
        if rows.column("shape")[0].as_py() == 0:
            self.clear()
        self.waiting.append(rows)

    def spelt(self):
        """(unit, groups_text, n_groups, pairs) of the units that wait, as ``MetUnits`` takes them."""
        if not self.waiting:
            return
        rows = pa.Table.from_batches(self.waiting)
        self.waiting = []
        of_shape = pc.is_valid(rows["shape"])
        for batch in rows.filter(of_shape).combine_chunks().to_batches():
            self.learn(batch)
        for row in rows.filter(pc.invert(of_shape)).select(["unit", "unit_shapes", "unit_a", "unit_b"]).to_batches():
            for k in range(row.num_rows):
                first, shapes, *ids = (column[k] for column in row.columns)
                yield from self.put_in(first.as_py(), *(x.values.to_numpy() for x in (shapes, *ids)))

    def learn(self, rows: pa.RecordBatch) -> None:
        first = len(self.n_groups)
        if not np.array_equal(rows.column("shape").to_numpy(), np.arange(first, first + rows.num_rows)):
            raise RuntimeError("shapes aren't in the order of their numbers")
        n_groups = pc.list_value_length(rows.column("groups")).to_numpy()
        groups = pc.list_flatten(rows.column("groups"))
        members = [groups.field(side) for side in ("a", "b")]
        n_a, n_b = (pc.list_value_length(x).to_numpy() for x in members)
        ends = np.cumsum(n_a + n_b)
        tokens, sides, marks = (np.zeros(ends[-1] if len(ends) else 0, kind) for kind in (np.int32, np.int8, np.int8))
        at_a, at_b = runs_at(ends - n_b - n_a, n_a), runs_at(ends - n_b, n_b)
        tokens[at_a], tokens[at_b] = (pc.list_flatten(x).to_numpy() for x in members)
        sides[at_b], marks[ends - n_b - 1], marks[ends - 1] = 1, 1, 2
        # of each shape
        bounds = np.concatenate(([0], np.cumsum(n_groups)))
        sums = [np.diff(np.concatenate(([0], np.cumsum(n)))[bounds]) for n in (n_a, n_b)]
        self.tokens, self.sides, self.marks = (np.concatenate(x) for x in ((self.tokens, tokens), (self.sides, sides), (self.marks, marks)))
        self.token_starts = np.concatenate((self.token_starts, self.token_starts[-1] + np.cumsum(sums[0] + sums[1])))
        links = pc.list_flatten(rows.column("links"))
        self.links = [np.concatenate((own, links.field(side).to_numpy())) for own, side in zip(self.links, "ab", strict=True)]
        n_links = pc.list_value_length(rows.column("links")).to_numpy()
        self.link_starts = np.concatenate((self.link_starts, self.link_starts[-1] + np.cumsum(n_links)))
        self.n_groups = np.concatenate((self.n_groups, n_groups))
        self.sizes = [np.concatenate(x) for x in zip(self.sizes, sums, strict=True)]

    def put_in(self, first: int, shapes: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray):
        """Groups and links of units from number ``first`` on: their shapes' with their own ids."""
        if shapes.max() >= len(self.n_groups):
            raise RuntimeError("a unit stands before its shape")
        bounds = [np.concatenate(([0], np.cumsum(n[shapes]))) for n in self.sizes]
        if (bounds[0][-1], bounds[1][-1]) != (len(ids_a), len(ids_b)):
            raise RuntimeError("units haven't their shapes' numbers of tokens")
        for lo in range(0, len(shapes), UNITS_SPELT):
            hi = min(lo + UNITS_SPELT, len(shapes))
            ids = [x[at[lo] : at[hi]] for x, at in zip((ids_a, ids_b), bounds, strict=True)]
            unit = pa.array(np.arange(first + lo, first + hi, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([unit, *self.of_units(shapes[lo:hi], ids)], ["unit", "groups_text", "n_groups", "pairs"])

    def of_units(self, shapes: np.ndarray, ids: list[np.ndarray]) -> list[pa.Array]:
        sizes = [own[shapes] for own in self.sizes]
        first = [np.cumsum(n) - n for n in sizes]
        n = sizes[0] + sizes[1]
        at = runs_at(self.token_starts[shapes], n)
        own = self.tokens[at] + np.repeat(first[0], n)
        of_b = np.flatnonzero(self.sides[at])
        own[of_b] += len(ids[0]) + np.repeat(first[1] - first[0], n)[of_b]
        pieces = self.texts.take(pa.array(np.concatenate(ids)[own] * np.int64(3) + self.marks[at]))
        # pieces, one after the other, are the units' texts, each with a mark at its end
        ends = np.frombuffer(pieces.buffers()[1], np.int64)[: len(pieces) + 1]
        ends = ends[np.concatenate(([0], np.cumsum(n)))]
        texts = pa.Array.from_buffers(pa.large_binary(), len(shapes), [None, pa.py_buffer(ends), pieces.buffers()[2]])
        n_links = np.diff(self.link_starts)[shapes]
        at = runs_at(self.link_starts[shapes], n_links)
        a, b = (x[y[at] + np.repeat(z, n_links)] for x, y, z in zip(ids, self.links, first, strict=True))
        pairs = lists(a * np.int64(self.base) + b, n_links)
        return [pc.binary_slice(texts, 0, -1), pa.array(self.n_groups[shapes]), pairs]


class MetUnits:
    """Groups and links of the units that a task has met, by the units' numbers."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.n, self.texts = 0, pa.array([], pa.large_binary())
        self.n_groups, self.pairs, self.starts = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        self.waiting: list[pa.RecordBatch] = []

    def add(self, rows: pa.RecordBatch) -> None:
        again = np.flatnonzero(rows.column("unit").to_numpy() == 0)
        if len(again):
            self.clear()
            rows = rows.slice(again[-1])
        if not np.array_equal(rows.column("unit").to_numpy(), np.arange(self.n, self.n + rows.num_rows)):
            raise RuntimeError("units aren't in the order of their numbers")
        self.n += rows.num_rows
        self.waiting.append(rows)

    def settle(self) -> None:
        if self.waiting:
            whole = pa.Table.from_batches(self.waiting).combine_chunks()
            self.texts = pa.concat_arrays([self.texts, *whole["groups_text"].cast(pa.large_binary()).chunks])
            n = pc.list_value_length(whole["pairs"]).to_numpy()
            self.pairs = np.concatenate((self.pairs, pc.list_flatten(whole["pairs"]).to_numpy()))
            self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(n)))
            self.n_groups = np.concatenate((self.n_groups, whole["n_groups"].to_numpy()))
            self.waiting = []

    def report(self, rows: pa.RecordBatch, most_pairs: int) -> list[pa.Array]:
        """The columns of ``put_together`` for some texts."""
        self.settle()
        units = pc.list_flatten(rows.column("units")).to_numpy()
        bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(rows.column("units")).to_numpy())))
        if len(units) and units.max() >= self.n:
            raise RuntimeError("a text stands before one of its units")
        n_groups = np.diff(np.concatenate(([0], np.cumsum(self.n_groups[units])))[bounds])
        n = self.starts[units + 1] - self.starts[units]
        pairs = self.pairs[runs_at(self.starts[units], n)]
        n_links = np.diff(np.concatenate(([0], np.cumsum(n)))[bounds])
        keys, times = np.unique(np.repeat(np.arange(rows.num_rows), n_links) * most_pairs + pairs, return_counts=True)
        at = pa.array(np.searchsorted(keys, np.arange(rows.num_rows + 1) * most_pairs).astype(np.int32))
        own = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), self.texts.take(pa.array(units)))
        texts = pc.binary_join(own, pa.scalar(b";", self.texts.type))
        digests = [hashlib.sha256(x.as_buffer()).hexdigest() if some else "" for x, some in zip(texts, np.diff(bounds) > 0, strict=True)]
        return [
            rows.column("id"), rows.column("n_a"), rows.column("n_b"), pa.array(n_groups), pa.array(n_links), pa.array(digests, pa.string()),
            pa.ListArray.from_arrays(at, pa.array(keys % most_pairs)), pa.ListArray.from_arrays(at, pa.array(times.astype(np.int32))),
        ]


def link_counts(linked: DataFrame, pairs_col: str = "pairs") -> DataFrame:
    """(pair, n): in how many rows each number of the array column stands; a row has a number once at most."""
    return linked.select(F.explode(pairs_col).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def frequent_from(counts: DataFrame, most: int) -> int:
    """The least power of two such that ``most`` pairs at most are counted so often or more."""
    sizes = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).count().collect()
    found, total = 0, 0
    for k, n in sorted(((r["k"], r["count"]) for r in sizes), reverse=True):
        total += n
        if total > most:
            return 1 << (k + 1)
        found = k
    return 1 << found if sizes else 1


def alignment_report(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row; groups as ``a1,a2|b1;a3|b2,b3``.

    ``count_sum`` sums, over a row's links, in how many rows the pair stands; ``n_best`` counts the links whose pair stands in
    as many rows as any other pair of its A id.
    """
    base, size_a = len(pair(path_a, path_b).bytes_b), len(pair(path_a, path_b).bytes_a)  # a pair of ids as one number
    packed = packed_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), path_a, path_b, "id")
    reports = put_together(shape_groups(packed), base, size_a * base)
    rows = staged(reports.select(F.monotonically_increasing_id().alias("row"), "*"), "alignments")
    counts = staged(link_counts(rows), "link-counts")
    # one row for each id of A at most, so as many as its vocabulary
    by_a = counts.withColumn("a", F.expr(f"pair div {base}"))
    best = by_a.groupBy("a").agg(F.max("n").alias("most"))
    known = by_a.join(F.broadcast(best), "a").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    least = frequent_from(counts, FREQUENT)
    frequent = F.broadcast(known.filter(F.col("n") >= least))
    each = rows.select("row", "times", F.posexplode("pairs").alias("_at", "pair")).select("row", "pair", F.get("times", "_at").alias("_times"))
    sums = [F.sum(F.col("n") * F.col("_times")).alias("count_sum"), F.sum(F.col("best") * F.col("_times")).alias("n_best")]
    found = each.join(frequent, "pair").groupBy("row").agg(*sums)
    if least > 1:
        rare = each.join(frequent, "pair", "left_anti").join(known.filter(F.col("n") < least), "pair").groupBy("row").agg(*sums)
        found = found.unionByName(rare).groupBy("row").agg(*(F.sum(c).alias(c) for c in ("count_sum", "n_best")))
    out = rows.drop("pairs", "times").join(found, "row", "left")
    sums = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", *sums, "groups_sha256")
