"""Whole texts as byte arrays: words, hashes and slices of bounded size for Arrow tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
WORD = r"[^\x20\x09-\x0D]+"
SLAB_BYTES = 1 << 20

BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**64, 256, dtype=np.uint64) | np.uint64(1)
BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slabs(offsets: np.ndarray, size: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text is a range of its own."""
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1
        hi = min(max(hi, lo + 1), rows)
        yield lo, hi
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of the first word of every row (and the count)."""
    solid = ~IS_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = np.unique(offsets[1:-1])
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets, "left")


def joined(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray
) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with one space between them, and their places in that string."""
    lengths = ends - starts
    new = np.cumsum(lengths) - lengths + np.arange(len(lengths))
    out = np.full(int(lengths.sum()) + len(lengths), 0x20, dtype=np.uint8)
    place = np.arange(int(lengths.sum()))
    which = np.repeat(np.arange(len(lengths)), lengths)
    out[place + which] = data[place + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)]
    return out.tobytes(), new, new + lengths


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((BASE, pow(BASE, -1, 2**64))):
            steps = np.full(max(n, SLAB_BYTES) + 1, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, the same wherever the span stands."""
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_CODES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
