"""Whole columns of texts as flat numpy arrays: words, hashes of words, hashes of runs of words.

A batch of texts is one byte buffer with offsets. Words and hashes are found for all texts of a slice at once,
so the cost is a few passes over the bytes and no Python code runs per word. Slices hold about 128 kilobytes
(a longer text is a slice of its own), which bounds the memory whatever the batch.

Hashes are polynomials modulo 2**64 over random values, so the hash of any run of words is a difference of two
prefix sums; a mixing step makes them uniform.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 17
SLICE_ROWS = 2048
_U = np.uint64
_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def constants(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed * 0x632BE59BD9B4E019 % 2**64))


_BYTE_VALUES = constants(11, 256)
_BASES = constants(12, 8) | _U(1)


_KEPT: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse for at least ``n`` places. One table per base is kept; it grows with the
    slices, and the table of a very long text is not kept."""
    if which in _KEPT and len(_KEPT[which][0]) >= n:
        return _KEPT[which]
    size, base = 1 << max(16, int(n).bit_length()), int(_BASES[which])
    tables = []
    for factor in (base, pow(base, -1, 2**64)):
        table = np.full(size, _U(factor))
        table[0] = 1
        tables.append(np.cumprod(table, dtype=_U))
    if n <= 16 * SLICE_BYTES:
        _KEPT[which] = (tables[0], tables[1])
    return tables[0], tables[1]


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair of places, mixed."""
    up, down = _powers(which, len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=_U)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


class Slice:
    """Words of a run of texts. ``first[i]`` is the number of the first word of text i; the last entry is the
    number of words. ``word_start``/``word_end`` are byte places."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        n = len(data)
        solid = ~_GAP[data]
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        inner = offsets[(offsets > 0) & (offsets < n)]  # texts end between inner - 1 and inner
        begins[inner] = solid[inner]
        ends[inner - 1] = solid[inner - 1]
        self.word_start = np.flatnonzero(begins)
        self.word_end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.word_start, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def word_hashes(self) -> np.ndarray:
        return run_hashes(_BYTE_VALUES[self.data], self.word_start, self.word_end, 0)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    return data, offsets


def slices(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, Slice]]:
    """(first row, last row + 1, words) of runs of rows that hold about ``SLICE_BYTES`` together."""
    if len(column) == 0:
        return
    data, offsets = buffers(column)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        to = min(max(to, at + 1), at + SLICE_ROWS, len(column))
        own = offsets[at : to + 1]
        yield at, to, Slice(data[own[0] : own[-1]], own - own[0], lower)
        at = to


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned values as Spark's signed longs, bit for bit."""
    return x.view(np.int64)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each list."""
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))
