"""Whole Arrow batches of texts as byte arrays: slices, words and span fingerprints, computed with numpy.

Every function works on one slice: `data` (uint8, the texts of some rows one after the other) and `bounds` (row i is
`data[bounds[i]:bounds[i + 1]]`). A slice holds whole texts; one longer than the limit is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _splitmix(n: int, seed: int) -> np.ndarray:
    """n well mixed odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(seed)) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of SplitMix, element by element; x may be overwritten."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUE = _splitmix(256, 0x1234567)
COEFFICIENTS = _splitmix(256, 0x7654321)


def _lookup(members, size: int = 256) -> np.ndarray:
    table = np.zeros(size, dtype=bool)
    table[list(members)] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: word bytes of [^\x20\x09-\x0D]+
NOT_SPACE = ~_lookup([0x20, *range(0x09, 0x0E)])
#: word bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, on lower-cased bytes
ALNUM = _lookup([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, data, bounds) of consecutive rows with at most `limit` bytes; null is empty."""
    if len(texts) == 0:
        return
    texts = texts.fill_null(b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, values = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        stop = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        stop = min(max(stop, first + 1), len(texts))
        yield first, stop, data[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first]
        first = stop


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            self.up, self.down = _power_table(_BASE, size), _power_table(_INVERSE, size)
        return self.up[:n], self.down[:n]


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], done = 1, 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_powers = _Powers()


class Spans:
    """Fingerprints of any byte span of a slice, from one running sum."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _powers.get(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=self.sums[1:])

    def raw(self, starts, ends) -> np.ndarray:
        return (self.sums[ends] - self.sums[starts]) * self.down[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit fingerprints; equal strings have equal ones wherever they stand."""
        return mix(self.raw(starts, ends) + (ends - starts).astype(np.uint64) * np.uint64(COEFFICIENTS[0]))

    def of_width(self, width: int) -> np.ndarray:
        """Fingerprints of the spans of that width at each offset."""
        n = len(self.sums) - width
        return (self.sums[width:] - self.sums[:n]) * self.down[:n]


def words(data: np.ndarray, bounds: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of word bytes after lower-casing A-Z: (starts, ends, fingerprints, bounds of each row's words)."""
    low = LOWER[data]
    inside = word_bytes[low]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, Spans(low).of(starts, ends), np.searchsorted(starts, bounds)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of [start, start + length) for each row, one after the other."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return np.arange(total, dtype=np.int64) + shift


def binary_rows(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Rows of a byte matrix or of consecutive byte spans as an Arrow binary column."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(np.ascontiguousarray(bounds, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(values))]
    ).cast(pa.binary())
