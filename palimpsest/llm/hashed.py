"""Hashes of words, computed over whole Arrow columns with numpy (used inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# separators where a word is a run of letters, digits and bytes of non-ASCII characters
MARKS = np.ones(256, bool)
MARKS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: each output bit depends on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bytes_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, joined, and the rows' offsets into them (null: empty)."""
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    if not len(col) or offsets is None:
        return np.empty(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(max(n, 1), base, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with S[i] the sum of (byte + 1) * base^j over j < i, modulo 2^64."""
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data))[:len(data)], out=s[1:], dtype=np.uint64)
    return s


class Words:
    """Words of a string column: ``row``, ``start``, ``end`` (byte offsets) and a 64-bit ``hash`` each."""

    def __init__(self, col: pa.Array, separators: np.ndarray = SPACES, lower: bool = True):
        raw, self.offsets = bytes_of(col)
        self.data = LOWER[raw] if lower else raw
        n = len(raw)
        inside = ~separators[raw]
        first = np.zeros(n + 1, bool)
        first[self.offsets] = True
        self.start = np.flatnonzero(inside & (first[:n] | ~np.concatenate(([False], inside[:-1]))))
        self.end = np.flatnonzero(inside & (first[1:] | ~np.concatenate((inside[1:], [False])))) + 1
        self.row = np.searchsorted(self.offsets, self.start, side="right") - 1
        s = prefix_sums(self.data)
        self.hash = mix((s[self.end] - s[self.start]) * powers(_INVERSE, n + 1)[self.start] + (self.end - self.start).astype(np.uint64))

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=len(self.offsets) - 1)


def term_hash(term: str) -> int:
    """The hash that ``Words`` gives the one word ``term``."""
    return int(Words(pa.array([term], pa.string()), np.zeros(256, bool)).hash[0])


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and hashes of all runs of ``k`` words; the whole sequence for rows with 1 to k-1 words."""
    n, per_row = len(words.hash), words.counts()
    h = np.zeros(max(n - k + 1, 0), np.uint64)
    for i in range(k if len(h) else 0):
        h = h * _BASE + words.hash[i:i + len(h)]
    whole = words.row[:len(h)] == words.row[k - 1:][:len(h)]
    rows, out = words.row[:len(h)][whole], h[whole]
    few = np.flatnonzero((per_row > 0) & (per_row < k))
    if len(few):
        first = np.searchsorted(words.row, few)
        extra = np.zeros(len(few), np.uint64)
        for i in range(k - 1):
            more = per_row[few] > i
            extra[more] = extra[more] * _BASE + words.hash[first[more] + i]
        rows, out = np.concatenate((rows, few)), np.concatenate((out, extra + per_row[few].astype(np.uint64)))
    return rows, mix(out)
