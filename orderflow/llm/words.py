"""Words of whole Arrow columns as numpy arrays of 64-bit hashes.

Texts of a batch lie one behind the other in one byte buffer. Splitting and
hashing run over the buffer, not over single words, a bounded slice at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240613).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POSITION = np.random.default_rng(77).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Which bytes belong to a word. All bytes from 0x80 on are parts of other characters.
NOT_WHITE = np.array([b != 0x20 and not 0x09 <= b <= 0x0D for b in range(256)])
ALPHANUMERIC = np.array([b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A for b in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    steps = np.full(count, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


@dataclass
class Texts:
    """Bytes of several texts and where each begins; ``bounds`` has one entry more."""

    data: np.ndarray
    bounds: np.ndarray

    def lower(self) -> Texts:
        return Texts(_LOWER[self.data], self.bounds)


def texts(column: pa.Array) -> Texts:
    """The buffer behind a column of strings; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    bounds = np.frombuffer(where, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Texts(raw[bounds[0] : bounds[-1]], bounds - bounds[0])


def spans(at: Texts, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of its first word."""
    inside = in_word[at.data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    begins = at.bounds[:-1][at.bounds[:-1] < len(inside)]
    before[begins] = False
    if len(inside):
        before[0] = False
        after[-1] = False
        after[begins[begins > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, at.bounds)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    first, up, down = 0, _powers(_BASE, SLICE + 1), _powers(_INVERSE, SLICE + 1)
    with np.errstate(over="ignore"):
        while first < len(starts):
            origin = starts[first]
            last = max(first + 1, int(np.searchsorted(ends, origin + SLICE, "right")))
            length = int(ends[last - 1] - origin)
            if length > len(up) - 1:
                up, down = _powers(_BASE, length + 1), _powers(_INVERSE, length + 1)
            sums = np.zeros(length + 1, np.uint64)
            np.cumsum(_BYTES[data[origin : origin + length]] * up[:length], out=sums[1:])
            s, e = starts[first:last] - origin, ends[first:last] - origin
            out[first:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
            first = last
    return out


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each ``size`` consecutive hashes, whatever text they are in."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    count = len(hashes) - size + 1
    with np.errstate(over="ignore"):
        out = np.full(count, np.uint64(size), np.uint64)
        for k in range(size):
            out += hashes[k : k + count] * _POSITION[k]
        return mix(out)


def sequence_hash(hashes: np.ndarray) -> np.uint64:
    """One hash of a whole sequence, of any length."""
    with np.errstate(over="ignore"):
        weights = mix(np.arange(1, len(hashes) + 1, dtype=np.uint64)) | np.uint64(1)
        return mix(np.array([np.sum(hashes * weights, dtype=np.uint64) ^ np.uint64(len(hashes))], np.uint64))[0]


def pieces(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``size`` bytes of text, a row at least."""
    lengths = np.diff(texts(batch.column(column)).bounds)
    part = np.cumsum(lengths) // size
    cuts = np.flatnonzero(np.diff(part)) + 1
    for begin, end in zip([0, *cuts], [*cuts, batch.num_rows]):
        if end > begin:
            yield batch.slice(begin, end - begin)
