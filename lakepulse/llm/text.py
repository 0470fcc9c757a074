"""Words and their hashes for a whole Arrow column at once, in numpy.

A word is a run of bytes other than 0x20 and 0x09..0x0D. These are ASCII, so UTF-8 characters are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

U = np.uint64
BYTE_BASE, WORD_BASE = U(0x9E3779B97F4A7C15 | 1), U(0xD6E8FEB86659FD93 | 1)
BYTES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h + U(seed * 0x632BE59BD9B4E019 % 2**64)
    h ^= h >> U(30)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most so many bytes of text each, one row at least."""
    _, offsets = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


@dataclass
class Words:
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray  # of each word
    first: np.ndarray  # of each row, and the number of words

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def split(column: pa.Array, lower: bool = False) -> Words:
    data, offsets = utf8(column)
    if lower:
        data = LOWER[data]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(data, none, none, none, np.zeros(len(offsets), np.int64))
    space = SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = edge[:-1].copy()
    before[1:] |= space[:-1]
    after = edge[1:].copy()
    after[:-1] |= space[1:]
    starts, ends = np.flatnonzero(~space & before), np.flatnonzero(~space & after) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    counts = np.bincount(row, minlength=len(offsets) - 1)
    return Words(data, starts, ends, row, np.concatenate([[0], np.cumsum(counts)]))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[:1] = 1
    return np.cumprod(out, dtype=U)


def hashes(words: Words, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, the same wherever the word stands."""
    length = words.ends - words.starts
    if not len(length):
        return np.zeros(0, U)
    # In steps of about 1 MB, to keep the arrays small.
    edges = np.unique([0, *np.searchsorted(words.starts, np.arange(0, len(words.data), 1 << 20)), len(length)])
    return np.concatenate([_hashes(words.data, words.starts[s:e], length[s:e], seed) for s, e in zip(edges[:-1], edges[1:])])


def _hashes(data: np.ndarray, starts: np.ndarray, length: np.ndarray, seed: int) -> np.ndarray:
    begin = np.cumsum(length) - length
    inside = np.arange(int(length.sum())) - np.repeat(begin, length)
    value = BYTES[data[inside + np.repeat(starts, length)]] * powers(BYTE_BASE, int(length.max()))[inside]
    return mix(np.add.reduceat(value, begin) + length.astype(U), seed)


def doubled(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of windows of twice n items, from those of n items: a window and the one that follows it."""
    return h[:-n] + h[n:] * powers(WORD_BASE, n + 1)[n] if len(h) > n else h[:0]


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes of all windows of n items (not yet mixed); row bounds are the caller's."""
    weight = powers(WORD_BASE, n + 1)
    out, done, level, size = None, 0, h, 1
    while size <= n:
        if n & size:
            if out is None:
                out = level
            else:
                m = max(0, len(h) - done - size + 1)
                out = out[:m] + level[done : done + m] * weight[done]
            done += size
        if 2 * size <= n:
            level = doubled(level, size)
        size *= 2
    return out[: max(0, len(h) - n + 1)]


def whole_windows(words: Words, n: int) -> np.ndarray:
    """Whether the window of n words that begins at each word ends in the same row."""
    left = words.first[words.row + 1] - np.arange(len(words.row))
    return left >= n


def shingles(words: Words, h: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every shingle of n words; a row with fewer words gives its whole sequence as one, one without words none."""
    full = np.flatnonzero(whole_windows(words, n))
    rows, values = words.row[full], mix(windows(h, n)[full], seed)
    counts = words.counts
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        weight = powers(WORD_BASE, n + 1)
        extra = np.array([(h[words.first[r] : words.first[r + 1]] * weight[: counts[r]]).sum(dtype=U) + U(counts[r]) for r in short], U)
        rows, values = np.concatenate([rows, short]), np.concatenate([values, mix(extra, seed)])
    return rows, values
