"""Vectorised text kernels used inside Arrow batches.

A batch's string column is viewed as one byte buffer with offsets, so words, lines and n-grams of many documents are
found by a few numpy passes and no Python string is made. Words are ``[^\\x20\\x09-\\x0D]+``; hashes have 64 bits.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 18
PIECE = 1 << 20

WHITESPACE = np.zeros(256, bool)
WHITESPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_MARKS = bytes(np.flatnonzero(PUNCTUATION).tolist())

_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, below ``n``."""
    if len(_powers.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def _piece_powers(base: int, n_pieces: int) -> np.ndarray:
    """The base to the power of each piece's first position."""
    step = pow(base, PIECE, 1 << 64)
    return np.array([pow(step, i, 1 << 64) for i in range(n_pieces)], np.uint64)


def release() -> None:
    """Give freed memory back to the system: Python workers live on after a task, next to an executor's heap."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) for runs of rows of about ``limit`` bytes; a longer row comes alone."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    _, offset_buffer, data = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, raw[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
    release()


def per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Count the true values of each row."""
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


class Words:
    """Words of a slice: ``starts``/``ends`` in bytes, ``bounds`` of rows in words, ``hashes``, ``row`` of each word."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.raw = LOWER[raw] if lower else raw
        self.offsets = offsets
        inside = ~WHITESPACE[self.raw]
        self.inside = inside
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = offsets[:-1][np.diff(offsets) > 0]
        first[full] = inside[full]
        ends = offsets[1:][np.diff(offsets) > 0] - 1
        last[ends] = inside[ends]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        self._sums: np.ndarray | None = None

    def _prefix(self, at: np.ndarray) -> np.ndarray:
        """Sums of the polynomial over the bytes before each position; a long row's are made piece by piece."""
        n = len(self.raw)
        up, _ = _power_tables(min(n, PIECE) + 1)
        if n <= PIECE:
            if self._sums is None:
                self._sums = np.zeros(n + 1, np.uint64)
                np.cumsum(_BYTE_VALUES[self.raw] * up[:n], out=self._sums[1:])
            return self._sums[at]
        order = np.argsort(at, kind="stable")
        sorted_at, out = at[order], np.empty(len(at), np.uint64)
        scale, before = _piece_powers(_BASE, n // PIECE + 1), np.uint64(0)
        for i, lo in enumerate(range(0, n, PIECE)):
            part = self.raw[lo : lo + PIECE]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE_VALUES[part] * up[: len(part)], out=sums[1:])
            a, b = np.searchsorted(sorted_at, [lo, n + 1 if lo + PIECE >= n else lo + PIECE])
            out[order[a:b]] = before + sums[sorted_at[a:b] - lo] * scale[i]
            before = before + sums[-1] * scale[i]
        return out

    def _down(self, at: np.ndarray) -> np.ndarray:
        """The inverse base to the power of each position."""
        n = len(self.raw)
        _, down = _power_tables(min(n, PIECE) + 1)
        return down[at] if n <= PIECE else _piece_powers(_BASE_INVERSE, n // PIECE + 1)[at // PIECE] * down[at % PIECE]

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash byte spans by prefix sums of a polynomial, so equal bytes hash alike wherever they stand."""
        with np.errstate(over="ignore"):
            return mix((self._prefix(ends) - self._prefix(starts)) * self._down(starts) + (ends - starts).astype(np.uint64))

    def bare_spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words without ASCII punctuation at either end; words of nothing else stay whole."""
        starts, ends, raw = self.starts.copy(), self.ends.copy(), self.raw
        if not len(starts):
            return starts, ends
        other = np.concatenate(([0], np.cumsum(~PUNCTUATION[raw], dtype=np.int32)))
        some = other[ends] > other[starts]
        for _ in range(4):
            ends -= some & PUNCTUATION[raw[ends - 1]]
            starts += some & PUNCTUATION[raw[starts]]
        for i in np.flatnonzero(some & (PUNCTUATION[raw[ends - 1]] | PUNCTUATION[raw[starts]])).tolist():
            word = raw[starts[i] : ends[i]].tobytes()
            starts[i] += len(word) - len(word.lstrip(_MARKS))
            ends[i] -= len(word) - len(word.rstrip(_MARKS))
        return starts, ends

    @property
    def hashes(self) -> np.ndarray:
        return self.span_hashes(self.starts, self.ends)

    def ngrams(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every run of ``n`` words within one row."""
        if len(hashes) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        first = np.arange(len(hashes) - n + 1)
        first = first[self.row[: len(first)] == self.row[n - 1 :]]
        out = hashes[first]
        for j in range(1, n):
            out = mix(out * np.uint64(0x9FB21C651E98DF25) + hashes[first + j])
        return first, out


def row_duplicates(rows: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (row, key); flag entries equal to the one before them in that order."""
    order = np.lexsort((keys, rows))
    r, k = rows[order], keys[order]
    again = np.zeros(len(order), bool)
    again[1:] = (r[1:] == r[:-1]) & (k[1:] == k[:-1])
    return order, again
