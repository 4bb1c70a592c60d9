"""Exact token counts of every prefix of a text, by dynamic programming over byte-pair encoding.

A sequence of tokens is the encoding of its bytes exactly if each token encodes to itself and each two neighbours do not
merge with one another. So the encoding of a prefix is the encoding of a shorter prefix and one more token: for every prefix
of a word the table holds that last token and the number of tokens, and the next entry is found from the entries before it.
Whether two tokens stay apart is told by walking up their facing edges in the order of the merges.

A text falls into words at ASCII white space, which the tokenizer drops; a word falls into the tokenizer's own pieces. Counts
of words are kept in a table by hash, so a word is worked out once while it is in the table. A prefix that ends within a word
has the tokens of the whole words before it and those of the word's prefix. ``prefix_table`` stores the count at every prefix;
``tokens_of``, ``longest_within`` and ``cut`` answer truncation and budget questions from it, without any encoding.
A budget on whole documents needs ``token_counts`` alone.

The tokenizer must be byte-level BPE in a .json file which drops white space (its normaliser and pre-tokenizer are used as
they are); other files raise ValueError.

Edge cases: a null text is an empty one; an empty text, or one of white space alone, has no tokens and no prefixes but those of
its white space, of 0 tokens. The tokenizer's added tokens inside a text count as one token, as in the library; a prefix that
cuts one counts it as plain text. Repeated rows and ids are counted row by row. An empty table gives an empty result. Extra
columns are not read. A long text is counted in pieces of words; what is held is its words' hashes. Prefixes of a word that
the normaliser recomposes, or that holds an added token, are counted one by one.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.kernels import LOWER, Words, release, text_slices
from corpusloom.llm.shared import modest_batches

SLICE = 1 << 20
WORDS_KEPT, PIECES_KEPT, PAIRS_KEPT = 1_000_000, 300_000, 500_000
NEVER = 1 << 60
ASCII_PIECES = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
PLAIN = re.compile(rb"[!-~]*")


def byte_symbols() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable Latin-1 for itself, the rest from U+0100."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class PrefixCounter:
    """Counts of the prefixes of words under one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.check(spec)
        self.symbol = byte_symbols()
        self.added = [a["content"] for a in spec["added_tokens"]]
        self.splits_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.learn(spec["model"])
        self.pieces: dict[bytes, int] = {}
        self.apart: dict[int, bool] = {}
        self.clear()

    def check(self, spec: dict) -> None:
        """Raise for a tokenizer that this method does not cover."""
        model, problem = spec["model"], None
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix")):
            problem = "it is not plain byte-pair encoding"
        elif self.tokenizer.encode("a  b\n c", add_special_tokens=False).ids != [
            i for w in "abc" for i in self.tokenizer.encode(w, add_special_tokens=False).ids
        ]:
            problem = "it does not drop white space"
        elif any(a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"] for a in spec["added_tokens"]):
            problem = "its added tokens are not plain strings"
        if problem:
            raise ValueError(f"prefix counts don't cover this tokenizer: {problem}")

    def learn(self, model: dict) -> None:
        """Tokens as bytes, the rank of each merge, and the edges of each token: what stands there, until which merge."""
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = max(vocabulary.values()) + 1
        self.rank = {(vocabulary[a], vocabulary[b]): k for k, (a, b) in enumerate(merges)}
        self.left: dict[int, tuple[list[int], list[int]]] = {}
        self.right: dict[int, tuple[list[int], list[int]]] = {}
        made = set()
        for k, (a, b) in enumerate(merges):
            joined = vocabulary[(a.removesuffix(suffix) if suffix else a) + b]
            if joined in made:
                raise ValueError("prefix counts don't cover this tokenizer: two merges make one token")
            made.add(joined)
            x, y = vocabulary[a], vocabulary[b]
            if self.meet(x, y) == (x, y):
                self.left[joined] = self.grown(self.left, x, joined, k)
                self.right[joined] = self.grown(self.right, y, joined, k)
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token, i in vocabulary.items():
            if i in made and i not in self.left:
                continue  # no text encodes to it
            ends = bool(suffix) and token.endswith(suffix)
            own = token.removesuffix(suffix) if ends else token
            content = bytes(self.symbol[c] for c in own)
            (self.final if ends or not suffix else self.inner)[content] = i
        if not suffix:
            self.inner = self.final
        self.inner_reach, self.final_reach = self.longest(self.inner), self.longest(self.final)

    @staticmethod
    def longest(tokens: dict[bytes, int]) -> dict[bytes, int]:
        """Length of the longest token for each three bytes that tokens end with."""
        found: dict[bytes, int] = {}
        for token in tokens:
            found[token[-3:]] = max(found.get(token[-3:], 0), len(token))
        return found

    @staticmethod
    def grown(edges: dict[int, tuple[list[int], list[int]]], part: int, whole: int, rank: int) -> tuple[list[int], list[int]]:
        tokens, until = edges.get(part, ([part], [NEVER]))
        return [*tokens, whole], [*until[:-1], rank, NEVER]

    def meet(self, a: int, b: int) -> tuple[int, int] | None:
        """The tokens at the edge when ``a`` and ``b`` first merge with one another; None if they never do.

        Merges go by rank, equal ones from left to right: the facing tokens merge if their rule comes before the one that
        takes the left of them away, and not after the one that takes the right of them away.
        """
        tokens_a, until_a = self.right.get(a, ([a], [NEVER]))
        tokens_b, until_b = self.left.get(b, ([b], [NEVER]))
        i = j = 0
        while True:
            rank = self.rank.get((tokens_a[i], tokens_b[j]))
            if rank is not None and rank < until_a[i] and rank <= until_b[j]:
                return tokens_a[i], tokens_b[j]
            if until_a[i] == until_b[j] == NEVER:
                return None
            if until_a[i] <= until_b[j]:
                i += 1
            else:
                j += 1

    def stay_apart(self, a: int, b: int) -> bool:
        key = a * self.size + b
        known = self.apart.get(key)
        if known is None:
            if len(self.apart) >= PAIRS_KEPT:
                self.apart.clear()
            known = self.apart[key] = self.meet(a, b) is None
        return known

    def last_token(self, piece: bytes, end: int, final: bool, last: list[int], count: list[int]) -> tuple[int, int]:
        """(last token, number of tokens) of ``piece[:end]``, from the entries of the prefixes before."""
        tokens, reach = (self.final, self.final_reach) if final else (self.inner, self.inner_reach)
        longest = reach.get(piece[end - 3 if end > 3 else 0 : end], 2)
        for start in range(end - longest if end > longest else 0, end):
            token = tokens.get(piece[start:end])
            if token is not None and (start == 0 or (last[start] >= 0 and self.stay_apart(last[start], token))):
                return token, count[start] + 1
        return -1, 0

    def prefixes(self, piece: bytes, every: bool) -> list[int]:
        """Number of tokens of each prefix of a piece, from the empty one on; only that of the whole one unless ``every``."""
        n = len(piece)
        if not every and piece in self.final:
            return [0, 1]
        last, count, out = [-1] * (n + 1), [0] * (n + 1), [0]
        for end in range(1, n + 1):
            if every or end == n:
                out.append(self.last_token(piece, end, True, last, count)[1])
            if end < n:
                last[end], count[end] = self.last_token(piece, end, False, last, count)
        return out

    def piece_count(self, piece: bytes) -> int:
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= PIECES_KEPT:
                self.pieces.clear()
            found = self.pieces[piece] = self.prefixes(piece, False)[-1]
        return found

    def word_pieces(self, text: str) -> list[tuple[bytes, int, int]]:
        """(bytes, start, end in code points of the normalised text) of the pieces of a text without added tokens."""
        normal = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        found = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        return [(bytes(self.symbol[c] for c in piece), a, b) for piece, (a, b) in found]

    def count(self, word: bytes) -> int:
        """Number of tokens of a word."""
        if PLAIN.fullmatch(word) and b"<|" not in word:
            return sum(map(self.piece_count, ASCII_PIECES.findall(word.lower())))
        text, total = word.decode("utf-8", "replace"), 0
        for k, part in enumerate(self.splits_added.split(text) if self.splits_added else [text]):
            total += k % 2 if k % 2 else sum(self.piece_count(piece) for piece, _, _ in self.word_pieces(part)) if part else 0
        return total

    def counts(self, word: bytes) -> np.ndarray:
        """Number of tokens of every prefix of a word, one for each code point."""
        text = word.decode("utf-8", "replace")
        normal = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        steady = len(normal) == len(text) and unicodedata.is_normalized("NFC", text) and all(len(c.lower()) == 1 for c in text)
        if not steady or any(a in text for a in self.added):
            return np.array([self.count(text[: k + 1].encode()) for k in range(len(text))], np.int32)
        out, total, done = np.zeros(len(text), np.int32), 0, 0
        for piece, start, end in self.word_pieces(text):
            out[done:start] = total  # dropped characters
            found, at = self.prefixes(piece, True), 0
            for k, char in enumerate(normal[start:end]):
                at += len(char.encode())
                out[start + k] = total + found[at]
            if end - start == 3 and piece[:1] == b"'" and piece[1:].isalpha():  # a contraction cut short falls into two
                out[start + 1] = total + self.piece_count(piece[:1]) + self.piece_count(piece[1:2])
            total, done = total + found[-1], end
        out[done:] = total
        return out

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted
        self.totals = np.zeros(0, np.int64)

    def word_totals(self, words: Words) -> np.ndarray:
        """Number of tokens of each word of a slice; words that aren't in the table are worked out and added."""
        raw, starts, ends = words.raw, words.starts, words.ends
        if not len(starts):
            return np.zeros(0, np.int64)
        if len(self.hashes) > WORDS_KEPT:
            self.clear()
        # case doesn't count in words of ASCII alone, but in those that may hold an added token
        as_is = np.concatenate(([0], np.cumsum((raw >= 0x80) | (raw == ord("<")), dtype=np.int64)))
        foreign = as_is[ends] > as_is[starts]
        kept = np.zeros(len(raw) + 1, np.int8)
        np.add.at(kept, starts[foreign], 1)
        np.add.at(kept, ends[foreign], -1)
        lowered = Words(np.where(np.cumsum(kept[:-1], dtype=np.int8) > 0, raw, LOWER[raw]), words.offsets)
        distinct, first, back = np.unique(lowered.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.hashes, distinct)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == distinct[known]
        new = np.flatnonzero(~known)
        if len(new):
            data = lowered.raw.tobytes()
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            found = np.array([self.count(data[a:b]) for a, b in spans], np.int64)
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self.totals = np.insert(self.totals, at[new], found)
            at = np.searchsorted(self.hashes, distinct)
        return self.totals[at][back]


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    """One counter for each worker process and tokenizer."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def code_points(raw: np.ndarray) -> np.ndarray:
    """Number of code points before each byte, and of all."""
    return np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80, dtype=np.int64)))


def longest_prefix(table: PrefixCounter, words: Words, totals: np.ndarray, row: int, budget: int) -> int:
    """Code points of the longest prefix of a row with at most ``budget`` tokens.

    Whole words never take tokens away, so it ends in the first word at whose end the budget is passed, or before it.
    """
    lo, hi = words.bounds[row], words.bounds[row + 1]
    begin, end = words.offsets[row], words.offsets[row + 1]
    after = np.cumsum(totals[lo:hi])
    k = int(np.searchsorted(after, budget, "right"))
    if k == hi - lo:
        return int(((words.raw[begin:end] & 0xC0) != 0x80).sum())
    start = words.starts[lo + k]
    before = int(((words.raw[begin:start] & 0xC0) != 0x80).sum())
    inside = table.counts(words.raw[start : words.ends[lo + k]].tobytes()) + (int(after[k - 1]) if k else 0)
    fits = np.flatnonzero(inside <= budget)
    return before + (int(fits[-1]) + 1 if len(fits) else 0)


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, cut_chars) of every row; one pass, no shuffle.

    ``cut_chars`` is how many code points the longest prefix with at most ``limit`` tokens has: the whole text's if it fits.
    """
    modest_batches(docs.sparkSession)
    schema = T.StructType([docs.schema[id_col], *T._parse_datatype_string("n_bytes long, n_tokens long, over_limit boolean, cut_chars long").fields])

    def run(batches):
        table = counter(vocabulary)
        for batch in batches:
            for lo, hi, raw, offsets in text_slices(batch.column(1), SLICE):
                words = Words(raw, offsets)
                totals = table.word_totals(words)
                summed = np.concatenate(([0], np.cumsum(totals)))[words.bounds]
                tokens, size = np.diff(summed), np.diff(code_points(raw)[offsets])
                over = tokens > limit
                for row in np.flatnonzero(over).tolist():
                    size[row] = longest_prefix(table, words, totals, row, limit)
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(over), pa.array(size)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)
        release()

    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(run, schema)


def prefix_table(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_tokens, prefix_tokens) of every row: ``prefix_tokens[k]`` is the exact count of the first k + 1 code points."""
    modest_batches(docs.sparkSession)
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("prefix_tokens", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([docs.schema[id_col], T.StructField("text", T.StringType()), *fields])

    def run(batches):
        table = counter(vocabulary)
        for batch in batches:
            for lo, hi, raw, offsets in text_slices(batch.column(1)):
                words, before = Words(raw, offsets), code_points(raw)
                totals = table.word_totals(words)
                summed = np.concatenate(([0], np.cumsum(totals)))
                known: dict[bytes, np.ndarray] = {}
                out = np.zeros(before[-1], np.int32)
                # a word's end carries its count on; what stands between two words adds none
                steps = np.zeros(before[-1] + 1, np.int64)
                np.add.at(steps, before[words.ends], totals)
                np.add.at(steps, before[offsets[1:]], -np.diff(summed[words.bounds]))
                out += np.cumsum(steps[:-1]).astype(np.int32)
                for k, (a, b) in enumerate(zip(words.starts.tolist(), words.ends.tolist(), strict=True)):
                    word = raw[a:b].tobytes()
                    if word not in known:
                        known[word] = table.counts(word)
                    out[before[a] : before[b]] += known[word]
                bounds = pa.array(before[offsets].astype(np.int32))
                columns = [
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo).cast(pa.string()),
                    pa.array(np.diff(summed[words.bounds])), pa.ListArray.from_arrays(bounds, pa.array(out)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)
        release()

    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).mapInArrow(run, schema)


def tokens_of(prefix_tokens: Column, n_chars: Column | int) -> Column:
    """Tokens of the first ``n_chars`` code points; of the whole text beyond its end."""
    n = F.least(n_chars if isinstance(n_chars, Column) else F.lit(n_chars), F.size(prefix_tokens))
    return F.when(n > 0, F.get(prefix_tokens, n - 1)).otherwise(F.lit(0))


def longest_within(prefix_tokens: Column, budget: Column | int) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens: a longer prefix may have fewer tokens."""
    places = F.transform(prefix_tokens, lambda n, k: F.when(n <= budget, k + 1).otherwise(0))
    return F.coalesce(F.array_max(places), F.lit(0))


def cut(table: DataFrame, budget: int) -> DataFrame:
    """A prefix table's rows with their texts cut to ``budget`` tokens, and their counts."""
    size = longest_within(F.col("prefix_tokens"), budget)
    return table.withColumns({
        "text": F.substring(F.col("text"), F.lit(1), size),
        "n_tokens": tokens_of(F.col("prefix_tokens"), size).cast("long"),
        "prefix_tokens": F.slice("prefix_tokens", F.lit(1), size),
    })
