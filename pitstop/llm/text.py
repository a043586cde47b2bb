"""Vectorised word handling inside tasks.

Words are runs of anything but the bytes 0x20 and 0x09-0x0D, so they can be
found on UTF-8 bytes.  Texts of an Arrow batch are handled in slices of
bounded size (a longer text makes a slice of its own)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: What the words are, as a pattern for SQL and Spark.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 19

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps)
    return have[:n]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser: every bit depends on all bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def segment_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of every byte range [start, end): a polynomial over random
    byte codes, finalised.  Equal ranges have equal hashes wherever they lie."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_LOWER if lower else _BYTE)[data] * _power(_BASE, len(data)), out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * _power(_INVERSE, len(data) + 1)[starts]
                 + (ends - starts).astype(np.uint64))


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


class Slice:
    """Some texts of a batch: ``first`` is the batch row of the first one,
    ``data`` their bytes, ``offsets`` where each begins (one more at the end)."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets
        self.n = len(offsets) - 1

    def words(self) -> None:
        """Sets starts, ends (byte ranges of words), bounds (the words of text
        i are [bounds[i], bounds[i+1])), doc (the text of each word)."""
        inside = ~_SPACE[self.data]
        begins, stops = np.zeros(len(inside) + 1, bool), np.zeros(len(inside) + 1, bool)
        begins[:-1] = inside
        begins[1:-1] &= ~inside[:-1]
        stops[1:] = inside
        stops[1:-1] &= ~inside[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < len(inside))]   # texts touch
        cut = edges[inside[edges] & inside[edges - 1]]
        begins[cut] = stops[cut] = True
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops)
        self.bounds = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(self.n), self.counts)

    def shingles(self, k: int, lower: bool = False, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of k words within a text, and each run's first
        word.  short: a text of 1 to k-1 words gives its whole sequence."""
        words = segment_hash(self.data, self.starts, self.ends, lower)
        n = len(words)
        if n >= k:
            mixed = words[:n - k + 1].copy()
            for j in range(1, k):
                mixed = mixed * np.uint64(_BASE) + words[j:n - k + 1 + j]
            first = np.flatnonzero(self.doc[:n - k + 1] == self.doc[k - 1:])
            hashes = mix64(mixed[first])
        else:
            hashes, first = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if short:
            few = np.flatnonzero((self.counts > 0) & (self.counts < k))
            if len(few):
                whole = np.zeros(len(few), np.uint64)
                for j in range(k - 1):
                    has = self.counts[few] > j
                    whole[has] = whole[has] * np.uint64(_BASE) + words[self.bounds[few[has]] + j]
                whole = mix64(whole + self.counts[few].astype(np.uint64) * np.uint64(_INVERSE))
                first = np.concatenate([first, self.bounds[few]])
                hashes = np.concatenate([hashes, whole])
                order = np.argsort(first, kind="stable")
                hashes, first = hashes[order], first[order]
        return hashes, first


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """A string column in slices of about ``limit`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    _, where, body = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield Slice(at, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at])
        at = to


def code_points(data: np.ndarray) -> np.ndarray:
    """Which bytes begin a code point."""
    return (data & 0xC0) != 0x80


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]
