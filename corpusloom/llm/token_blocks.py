"""Token ids in patched frame-of-reference files.

A file holds blocks of ``BLOCK`` ids. Each block stores its minimum and the ids less that minimum, packed at the bit
width that the ``PERCENTILE`` quantile of its differences needs; the high bits of larger ones stand in exception lists.
An index gives where each block and its exceptions start, so any range of ids decodes without what comes before it.

File (little-endian, 8-byte aligned parts): packed words | exception positions u16 | exception values u32 | block
minimum u32, width u8, word start u64, exception start u64 (one more of each start than blocks) | document ids i64,
null flags u8, token ends u64 | trailer: the six part sizes that readers need, and a magic number.

Edge cases: a null text is an empty one and yields the end id alone. Rows are written in ascending id order, null ids
first; rows with equal ids follow by a hash of their text. An empty table makes no file and an empty result. Extra
columns are not read. Ids must be integers. A file is closed after ``FILE_TOKENS`` ids, so memory is bounded but for one
document's own ids; a long text is encoded in pieces. Any tokenizer file may be given: one that doesn't split at words gets
whole texts.
"""

from __future__ import annotations

import os
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.kernels import LOWER, PUNCTUATION, WHITESPACE, Words, release, text_slices
from corpusloom.llm.shared import modest_batches, staged, work_dir
from corpusloom.llm.storage import read_file, write_file

BLOCK = 256
PERCENTILE = 0.95
FILE_TOKENS = 1 << 21
SLICE = 1 << 19
TABLE_PARTS = 1_000_000
PARTS_A_CALL = 400
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[b for b in range(128) if chr(b).isalnum()]] = True
MAGIC = b"PFORBLK1"
TRAILER = struct.Struct("<QQQQ8s")


def _padded(parts: list[np.ndarray]) -> list[bytes]:
    out = []
    for part in parts:
        raw = part.tobytes()
        out.append(raw + b"\0" * (-len(raw) % 8))
    return out


def pack(ids: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The parts of one file."""
    n_blocks = -(-len(ids) // BLOCK)
    table = np.zeros(n_blocks * BLOCK, np.uint32)
    table[: len(ids)] = ids
    if len(ids):
        table[len(ids) :] = ids[-1]
    table = table.reshape(n_blocks, BLOCK)
    low = table.min(1) if n_blocks else np.zeros(0, np.uint32)
    rest = table - low[:, None]
    rank = min(BLOCK - 1, int(np.ceil(PERCENTILE * BLOCK)) - 1)
    typical = np.partition(rest, rank, axis=1)[:, rank] if n_blocks else low
    width = np.ceil(np.log2(typical.astype(np.float64) + 1)).astype(np.uint8)
    word_start = np.concatenate(([0], np.cumsum(width.astype(np.int64) * (BLOCK // 64)))).astype(np.uint64)
    over = (rest >> width[:, None].astype(np.uint32)) > 0
    block_at, position = np.nonzero(over)
    values = rest[block_at, position] >> width[block_at].astype(np.uint32)
    exception_start = np.concatenate(([0], np.cumsum(over.sum(1)))).astype(np.uint64)
    words = np.zeros(int(word_start[-1]), np.uint64)
    for w in np.unique(width):
        if w:
            chosen = np.flatnonzero(width == w)
            lanes = (rest[chosen] & np.uint32((1 << int(w)) - 1)).astype(np.uint64).reshape(-1, 64)
            packed = np.zeros((len(lanes), int(w)), np.uint64)
            for j in range(64):
                at, shift = divmod(j * int(w), 64)
                packed[:, at] |= lanes[:, j] << np.uint64(shift)
                if shift + int(w) > 64:
                    packed[:, at + 1] |= lanes[:, j] >> np.uint64(64 - shift)
            size = int(w) * (BLOCK // 64)
            words[word_start[chosen].astype(np.int64)[:, None] + np.arange(size)] = packed.reshape(len(chosen), size)
    parts = [
        words, position.astype(np.uint16), values.astype(np.uint32), low, width, word_start, exception_start,
        doc_ids.astype(np.int64), nulls.astype(np.uint8), ends.astype(np.uint64),
    ]
    return [*_padded(parts), TRAILER.pack(len(ids), n_blocks, len(values), len(doc_ids), MAGIC)]


class Reader:
    """Index and blocks of one file."""

    def __init__(self, uri: str):
        self.uri = uri
        raw = read_file(uri)
        self.n_ids, self.n_blocks, n_over, n_docs, magic = TRAILER.unpack(raw[-TRAILER.size :])
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token block file")
        index_types = [
            (np.uint32, self.n_blocks), (np.uint8, self.n_blocks), (np.uint64, self.n_blocks + 1),
            (np.uint64, self.n_blocks + 1), (np.int64, n_docs), (np.uint8, n_docs), (np.uint64, n_docs),
        ]
        tail = sum(-(-np.dtype(t).itemsize * n // 8) * 8 for t, n in index_types) + TRAILER.size
        at = len(raw) - tail
        got = []
        for kind, n in index_types:
            got.append(np.frombuffer(raw, kind, n, at))
            at += -(-np.dtype(kind).itemsize * n // 8) * 8
        self.low, self.width, starts, overs, self.doc_ids, self.nulls, self.ends = got
        self.starts, self.overs = starts.astype(np.int64), overs.astype(np.int64)
        n_words = int(self.starts[-1])
        self.words = np.frombuffer(raw, np.uint64, n_words)
        self.positions = np.frombuffer(raw, np.uint16, n_over, 8 * n_words)
        self.values = np.frombuffer(raw, np.uint32, n_over, 8 * n_words + -(-2 * n_over // 8) * 8)

    def ids(self, first: int = 0, end: int | None = None) -> np.ndarray:
        """Ids of ``[first, end)``; only the blocks that hold them are decoded."""
        end = self.n_ids if end is None else min(end, self.n_ids)
        if end <= first:
            return np.zeros(0, np.uint32)
        lo, hi = first // BLOCK, -(-end // BLOCK)
        out = np.zeros((hi - lo, BLOCK), np.uint32)
        width = self.width[lo:hi]
        for w in np.unique(width):
            if w:
                chosen = np.flatnonzero(width == w)
                size, mask = int(w) * (BLOCK // 64), np.uint64((1 << int(w)) - 1)
                packed = self.words[self.starts[lo + chosen][:, None] + np.arange(size)].reshape(-1, int(w))
                lanes = np.empty((len(packed), 64), np.uint32)
                for j in range(64):
                    at, shift = divmod(j * int(w), 64)
                    value = packed[:, at] >> np.uint64(shift)
                    if shift + int(w) > 64:
                        value = value | packed[:, at + 1] << np.uint64(64 - shift)
                    lanes[:, j] = value & mask
                out[chosen] = lanes.reshape(len(chosen), BLOCK)
        a, b = self.overs[lo], self.overs[hi]
        block = np.repeat(np.arange(hi - lo), np.diff(self.overs[lo : hi + 1]))
        out[block, self.positions[a:b]] |= self.values[a:b] << width[block].astype(np.uint32)
        out += self.low[lo:hi, None]
        return out.reshape(-1)[first - lo * BLOCK : end - lo * BLOCK]


_encoders: dict[str, Encoder] = {}
#: Case, marks within and around words, digits, other scripts and white space: where tokenizers part ways
PROBES = (
    "Plain words, in a Sentence.", "MIXED mIxEd can't I'LL re-do x_y 3.14 1,000 a1b2 2nd", "(brackets) [x]{y} <z> \"quoted\" 'q'",
    "end... wait!!! what?! ok;", "tab\tand  spaces\n\nlines \r\n end ", "Ünïcode Straße É è ÀÉ", "漢字かな 한국어 русский العربية", "a/b\\c @x #y $5 50% & * + =",
    "emoji 😀 x😀y", "No1.x v2.0-beta e.g. U.S.A. A.B", "", " lead", "x", "!", "''", "a\u00a0b\u200bc\u0085d",
)


def word_pieces(raw: np.ndarray, size: int) -> list[np.ndarray]:
    """The bytes in pieces of about ``size``, cut at white space; a longer word stays in one piece."""
    spaces = np.flatnonzero(WHITESPACE[raw])
    cuts = [0]
    while len(raw) - cuts[-1] > size:
        at = np.searchsorted(spaces, cuts[-1] + size)
        if at == len(spaces):
            break
        cuts.append(int(spaces[at]) + 1)
    return [raw[a:b] for a, b in zip(cuts, [*cuts[1:], len(raw)], strict=True)]


class Encoder:
    """Encodes slices of texts by a table of the words that it has met.

    The tokenizer joins nothing across ASCII white space, nor a letter or digit with the ASCII punctuation after it, and
    doesn't mind the case of words that are all ASCII. So a text's ids are those of its words' lower-cased stems and of
    their tails of punctuation, which are far fewer than words. Parts are told apart by 64-bit hashes and go to the
    tokenizer once while they are in the table; parts of letters alone go many to a call, and ids with the end-of-word
    mark tell them apart again. The table starts anew above ``TABLE_PARTS``.

    The tokenizer's added tokens (``<|endoftext|>``) are looked for before anything is split or lower-cased, so a row that
    may hold one, in any case, goes to the tokenizer whole and as it is. Probe texts are encoded both ways at the start; a
    tokenizer for which the two differ gets all texts whole. A long text is encoded in pieces of words.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        added = {token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()}
        self.added = {LOWER[np.frombuffer(a, np.uint8)].tobytes() for a in added if a}
        self.splits = True
        self.clear()
        self.splits = self.agrees()

    def agrees(self) -> bool:
        """Whether words and tails encoded one by one give the ids of whole texts, on texts chosen to tell."""
        raw = [p.encode() for p in PROBES]
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
        ids, lengths = self.encode(np.frombuffer(b"".join(raw), np.uint8), offsets, 0)
        found = np.split(ids, np.cumsum(lengths)[:-1])
        wanted = self.tokenizer.encode_batch_fast(list(PROBES), add_special_tokens=False)
        return all(f[:-1].tolist() == w.ids for f, w in zip(found, wanted, strict=True))

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.numbers = np.zeros(0, np.int64)  # of the parts, by sorted hash
        self.starts = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode_parts(self, parts: list[bytes]) -> list[np.ndarray]:
        """Ids of each part."""
        out: list[np.ndarray | None] = [None] * len(parts)
        texts = [p.decode("utf-8", "replace") for p in parts]
        marked = bool(self.closes.any())
        plain = [i for i, t in enumerate(texts) if marked and t.isalpha()]
        other = [i for i, t in enumerate(texts) if not (marked and t.isalpha())]
        runs = [plain[i : i + PARTS_A_CALL] for i in range(0, len(plain), PARTS_A_CALL)]
        found = self.tokenizer.encode_batch_fast([" ".join([texts[i] for i in r]) for r in runs], add_special_tokens=False)
        for run, encoding in zip(runs, found, strict=True):
            ids = np.array(encoding.ids, np.uint32)
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(run) or ends[-1] != len(ids):
                other += run
                continue
            at = 0
            for i, end in zip(run, ends.tolist(), strict=True):
                out[i] = ids[at:end]
                at = end
        found = self.tokenizer.encode_batch_fast([texts[i] for i in other], add_special_tokens=False)
        for i, encoding in zip(other, found, strict=True):
            out[i] = np.array(encoding.ids, np.uint32)
        return out

    def lookup(self, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray, data: bytes) -> np.ndarray:
        """Numbers of the parts at the given spans; parts that aren't in the table are encoded and added."""
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(new):
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            found = self.encode_parts([data[a:b] for a, b in spans])
            lengths = np.array([len(x) for x in found])
            numbers = len(self.starts) - 1 + np.arange(len(new))
            self.ids = np.concatenate([self.ids, *found])
            self.starts = np.concatenate((self.starts, self.starts[-1] + np.cumsum(lengths)))
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self.numbers = np.insert(self.numbers, at[new], numbers)
            at = np.searchsorted(self.hashes, distinct)
        return self.numbers[at][back]

    def whole_rows(self, raw: np.ndarray, offsets: np.ndarray) -> list[int]:
        """Rows that may hold an added token."""
        if not self.splits:
            return list(range(len(offsets) - 1))
        data, rows = LOWER[raw].tobytes(), set()
        for token in self.added:
            at = data.find(token)
            while at >= 0:
                rows.add(int(np.searchsorted(offsets, at, "right")) - 1)
                at = data.find(token, at + 1)
        return sorted(rows)

    def encode(self, raw: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows of a slice, the end id after each row's; number of ids of each row)."""
        n = len(offsets) - 1
        if n == 1 and len(raw) > 2 * SLICE and not self.whole_rows(raw, offsets):
            pieces = word_pieces(raw, SLICE)
            found = [self.encode(piece, np.array([0, len(piece)]), end_id)[0][:-1] for piece in pieces]
            ids = np.concatenate([*found, np.array([end_id], np.uint32)])
            return ids, np.array([len(ids)])
        whole = self.whole_rows(raw, offsets)
        texts = [raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace") for i in whole]
        if whole:
            raw = raw.copy()
            for i in whole:
                raw[offsets[i] : offsets[i + 1]] = 0x20
        words = Words(raw, offsets)
        starts, ends = words.starts, words.ends
        if len(self.starts) > TABLE_PARTS:
            self.clear()
        # a tail is cut off where an ASCII letter or digit stands before it
        last = np.maximum.accumulate(np.where(PUNCTUATION[raw], 0, np.arange(1, len(raw) + 1)))
        stems = last[ends - 1] if len(ends) else ends
        stems = np.where((stems > starts) & (stems < ends) & ALPHANUMERIC[raw[stems - 1]], stems, ends) if len(ends) else ends
        wide = np.concatenate(([0], np.cumsum(raw >= 0x80, dtype=np.int64)))
        foreign = wide[stems] > wide[starts]
        kept = np.zeros(len(raw) + 1, np.int8)
        np.add.at(kept, starts[foreign], 1)
        np.add.at(kept, stems[foreign], -1)
        lowered = np.where(np.cumsum(kept[:-1], dtype=np.int8) > 0, raw, LOWER[raw])
        text = Words(lowered, offsets)
        tailed = np.flatnonzero(stems < ends)
        from_, to = np.concatenate((starts, stems[tailed])), np.concatenate((stems, ends[tailed]))
        numbers = self.lookup(text.span_hashes(from_, to), from_, to, lowered.tobytes())
        # parts in the order of the text: a word's stem, then its tail
        place = np.arange(len(starts)) + np.concatenate(([0], np.cumsum(stems < ends)))[:-1]
        order = np.empty(len(numbers), np.int64)
        order[place] = numbers[: len(starts)]
        order[place[tailed] + 1] = numbers[len(starts) :]
        lengths = self.starts[order + 1] - self.starts[order]
        total = np.concatenate(([0], np.cumsum(lengths)))
        ids = self.ids[np.repeat(self.starts[order] - total[:-1], lengths) + np.arange(total[-1])]
        parts = np.concatenate((place, [len(order)]))[words.bounds]
        edge = total[parts]
        if whole:
            rows = np.split(ids, edge[1:-1])
            for i, encoding in zip(whole, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                rows[i] = np.array(encoding.ids, np.uint32)
            ids = np.concatenate(rows)
            edge = np.concatenate(([0], np.cumsum([len(row) for row in rows])))
        out = np.empty(len(ids) + n, np.uint32)
        closing = edge[1:] + np.arange(n)
        own = np.ones(len(out), bool)
        own[closing] = False
        out[closing], out[own] = end_id, ids
        return out, np.diff(edge) + 1


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long, n_bytes long"


def write_tokens(
    docs: DataFrame, vocabulary: str, folder: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode and write all rows in ascending id order; return the staged manifest, a row for each file."""
    modest_batches(docs.sparkSession)
    if not isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{id_col} must be an integer column")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("id"), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        table, part = encoder(vocabulary), TaskContext.get().partitionId()
        tokens: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        nulls: list[np.ndarray] = []
        seq = 0

        def close():
            flat, ends = np.concatenate(tokens), np.cumsum(np.concatenate(lengths))
            content = pack(flat, np.concatenate(ids), np.concatenate(nulls), ends)
            path = write_file(folder, f"part-{part:05d}-{seq:04d}.pfor", content)
            row = [[part], [seq], [path], [len(ends)], [len(flat)], [sum(map(len, content))]]
            types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["part", "seq", "path", "n_docs", "n_tokens", "n_bytes"]
            for kept in (tokens, lengths, ids, nulls):
                kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names)

        for batch in batches:
            for lo, hi, raw, offsets in text_slices(batch.column(1), SLICE):
                found, sizes = table.encode(raw, offsets, end_id)
                tokens.append(found)
                lengths.append(sizes)
                ids.append(batch.column(0).slice(lo, hi - lo).fill_null(0).to_numpy())
                nulls.append(batch.column(0).slice(lo, hi - lo).is_null().to_numpy(zero_copy_only=False))
                if sum(map(len, tokens)) >= FILE_TOKENS:
                    yield close()
                    seq += 1
                    release()
        if tokens:
            yield close()
        release()

    return staged(rows.mapInArrow(run, MANIFEST), "token-manifest")


def read_tokens(manifest: DataFrame, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Read files back: a row for each document with start, length and crc32 of its ids, and the ids if asked for."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    n_files = max(1, manifest.count())
    names = [id_col, "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64()] * 4 + [pa.list_(pa.int32())] * with_ids

    def run(batches):
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = Reader(path)
                tokens = reader.ids()
                ends = reader.ends.astype(np.int64)
                begins = np.concatenate(([0], ends[:-1]))
                view = memoryview(np.ascontiguousarray(tokens)).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begins, ends, strict=True)]
                columns = [
                    pa.array(reader.doc_ids, pa.int64(), mask=reader.nulls.astype(bool)),
                    pa.array(start + begins), pa.array(ends - begins), pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    offsets = pa.array(np.append(begins, len(tokens)), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(tokens.astype(np.int32))))
                whole = pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, types, strict=True)], names)
                for lo in range(0, whole.num_rows, 10_000):
                    yield whole.slice(lo, 10_000)
        release()

    fields = [f"{n} long" for n in names[:4]] + ["ids array<int>"] * with_ids
    spread = placed.select("path", "start").repartition(min(n_files, 10_000))
    return spread.mapInArrow(run, ", ".join(fields))


def encode_corpus(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all rows to files in the shared folder and return what reading them back gives."""
    folder = work_dir(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, vocabulary, folder, id_col=id_col, text_col=text_col), id_col)
