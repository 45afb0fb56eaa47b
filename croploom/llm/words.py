"""Words of whole Arrow batches, hashed with array arithmetic instead of a Python step per word.

Texts stay in Arrow's one byte buffer.  A byte table says which bytes separate words and folds A-Z.
The hash of a word is the sum of a random number for each pair of a byte and its place in the word, so
that a batch costs a few passes over its bytes and no two words collide by their structure.  Every byte of a multi-byte character
is 0x80 or more, and so are the bytes that a class of "all but these ASCII characters" takes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
MASK = (1 << 64) - 1
PLACES = 64  # places in a word with a table of their own
FOLD = U64(0xD1342543DE82EF95)
CHUNK = 1 << 18  # bytes hashed at a time
SLICE_BYTES = 2 << 20  # bytes of text handled at a time, a longer document alone

_SPACE = frozenset([0x20, *range(0x09, 0x0E)])
_NOT_ALNUM = frozenset([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _by_place(low: np.ndarray) -> np.ndarray:
    """Random numbers for (place, byte); the last row is mixed with the place for all later ones."""
    cells = np.arange((PLACES + 1) * 256, dtype=U64).reshape(PLACES + 1, 256)[:, low]
    return mix((cells + U64(1)) * U64(0xA24BAED4963EE407))


class WordClass:
    """Which bytes, after folding A-Z, belong to words."""

    def __init__(self, separators: frozenset[int]) -> None:
        low = np.arange(256)
        low[65:91] += 32
        self.lower = low.astype(np.uint8)
        self.inside = np.array([int(b) not in separators for b in low])
        self.value = _by_place(low.astype(np.int64)).ravel()


SPACED = WordClass(_SPACE)  # [^\x20\x09-\x0D]+
ALNUM = WordClass(_NOT_ALNUM)  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    if col.null_count:
        col = col.fill_null("")
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        kind = np.int64
    else:
        kind = np.int32
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(off, kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


_libc = ctypes.CDLL(None)


def release() -> None:
    """Give memory that is no longer used back to the system: Python workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most so many bytes of text each, or a single row."""
    _, off = buffers(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, side="right")) - 1)
        hi = min(hi, batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi
    release()


class Spans:
    """Where all words of some texts begin and end: ``start[first[i]:first[i+1]]`` are those of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, apart: np.ndarray | None = None) -> None:
        """apart: whether a word ends with a byte, and another one begins with the next, for all but the last byte."""
        n = len(data)
        begins, ends = inside.copy(), inside.copy()
        if n:
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            if apart is not None:
                begins[1:] |= apart
                ends[:-1] |= apart
            cut = offsets[(offsets > 0) & (offsets < n)]
            begins[cut] = inside[cut]
            ends[cut - 1] = inside[cut - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)


class Words(Spans):
    """Hashes of all words of some texts: ``hash[first[i]:first[i+1]]`` are those of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: WordClass) -> None:
        n = len(data)
        inside = kind.inside[data]
        super().__init__(data, offsets, inside)
        at = np.empty(len(self.start), U64)
        to = np.empty(len(self.start), U64)
        carry = U64(0)
        for lo in range(0, n, CHUNK):
            hi = min(lo + CHUNK, n)
            i, j = np.searchsorted(self.start, (lo, hi))
            sums = np.zeros(hi - lo + 1, U64)
            if i < j or (i and self.end[i - 1] > lo):
                own = np.repeat(np.arange(max(i - 1, 0), j), np.diff(np.concatenate([[lo], self.start[i:j], [hi]]))[0 if i else 1 :])
                skip = hi - lo - len(own)  # what lies before the first word
                place = np.arange(lo + skip, hi) - self.start[own]
                part = kind.value[np.minimum(place, PLACES) * 256 + data[lo + skip : hi]]
                late = np.flatnonzero(place >= PLACES)
                if len(late):
                    part[late] = mix(part[late] + place[late].astype(U64) * U64(0x9E3779B97F4A7C15))
                part[~inside[lo + skip : hi]] = 0
                np.cumsum(part, out=sums[1 + skip :])
            sums += carry
            at[i:j] = sums[self.start[i:j] - lo]
            i, j = np.searchsorted(self.end, (lo, hi), side="right")
            to[i:j] = sums[self.end[i:j] - lo]
            carry = sums[-1]
        self.hash = mix(to - at)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the first words of all k-word windows within a text, and the windows' hashes."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        last = np.repeat(self.first[1:], np.diff(self.first))[:n]
        ok = np.arange(k, k + n) <= last
        return np.flatnonzero(ok), fold([self.hash[j : j + n] for j in range(k)])[ok]


def fold(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for a sequence of hashes."""
    acc = parts[0] + U64(len(parts))
    for p in parts[1:]:
        acc = acc * FOLD + p
    return mix(acc)
