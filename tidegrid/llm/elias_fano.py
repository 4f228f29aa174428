"""Rising sequences of whole numbers in near-minimal space, each readable without the others."""

from __future__ import annotations

import struct

import numpy as np

#: Every so many values, the place of one in the upper bits is kept.
SAMPLE = 256
HEADER = struct.Struct("<QQBxxxxxxx")
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """``width`` bits of each value, one after another, lowest bit first."""
    out = np.zeros(-(-len(values) * width // 8), dtype=np.uint8)
    for lo in range(0, len(values), 1 << 16):  # a multiple of 8, so each part starts a byte
        part = values[lo : lo + (1 << 16)]
        bits = (part[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        packed = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        out[lo * width // 8 : lo * width // 8 + len(packed)] = packed
    return out


class EliasFano:
    """``n`` values from 0 to ``universe``, none smaller than the one before.

    The lower ``width`` bits of each value stand side by side. The upper parts are written in unary: value
    ``i`` sets bit ``upper(i) + i``. With ``width = floor(log2(universe / n))`` that is about
    ``2 + log2(universe / n)`` bits a value. ``select`` finds the ``i``-th set bit from the last
    sampled one before it; samples are 32-bit numbers, one for every ``SAMPLE`` values.
    """

    def __init__(self, n: int, universe: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.width = n, universe, width
        self.low, self.high, self.samples = low, high, samples

    @staticmethod
    def _sizes(n: int, universe: int, width: int) -> tuple[int, int, int]:
        """Bytes of lower bits and upper bits, and number of samples."""
        return -(-n * width // 8), -(-(n + (universe >> width) + 1) // 8) if n else 0, -(-n // SAMPLE)

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        universe = int(values[-1]) if n else 0
        if n and (values[1:] < values[:-1]).any():
            raise ValueError("values must not fall")
        width = max(0, (universe // n).bit_length() - 1) if n else 0
        low_bytes, high_bytes, _ = cls._sizes(n, universe, width)
        if high_bytes * 8 >= 1 << 32:
            raise ValueError("too many values for 32-bit samples; write more, smaller parts")
        at = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        high = np.zeros(high_bytes, dtype=np.uint8)
        np.bitwise_or.at(high, at >> 3, (1 << (at & 7)).astype(np.uint8))
        low = _pack(values & np.uint64((1 << width) - 1), width) if width else np.zeros(0, np.uint8)
        return cls(n, universe, width, low, high, at[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = HEADER.pack(self.n, self.universe, self.width)
        return head + self.samples.astype("<u4").tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        """The sequence that starts at byte ``at``, and the byte after it. Nothing is unpacked."""
        n, universe, width = HEADER.unpack_from(data, at)
        low, high, samples = cls._sizes(n, universe, width)
        at += HEADER.size
        parts = []
        for count, kind in ((samples, "<u4"), (low, "u1"), (high, "u1")):
            part = np.frombuffer(data, dtype=kind, count=count, offset=at)
            parts.append(part)
            at += part.nbytes
        return cls(n, universe, width, parts[1], parts[2], parts[0]), at

    def __len__(self) -> int:
        return self.n

    @property
    def bits(self) -> int:
        """Size of the encoded values, samples included, without the header."""
        return 8 * (self.low.nbytes + self.high.nbytes) + 32 * len(self.samples)

    def select(self, i: int) -> int:
        """Value ``i``."""
        return int(self.select_range(i, i + 1)[0])

    def select_range(self, lo: int, hi: int) -> np.ndarray:
        """Values ``lo`` to ``hi - 1``; reads only the bits from the sample before ``lo`` on."""
        if not 0 <= lo <= hi <= self.n:
            raise IndexError((lo, hi, self.n))
        if lo == hi:
            return np.zeros(0, dtype=np.uint64)
        first = int(self.samples[lo // SAMPLE]) >> 3  # the byte of the sampled bit
        skip = lo - lo // SAMPLE * SAMPLE  # set bits from the sample to value lo
        skip += int(_ONES[self.high[first] & ((1 << (int(self.samples[lo // SAMPLE]) & 7)) - 1)])
        last = -(-hi // SAMPLE)
        end = (int(self.samples[last]) >> 3) + 1 if last < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[first:end], bitorder="little"))[skip : skip + hi - lo]
        upper = ones + 8 * first - np.arange(lo, hi)
        return (upper.astype(np.uint64) << np.uint64(self.width)) | self._low(lo, hi)

    def _low(self, lo: int, hi: int) -> np.ndarray:
        if not self.width:
            return np.zeros(hi - lo, dtype=np.uint64)
        first, end = lo * self.width // 8, -(-hi * self.width // 8)
        bits = np.unpackbits(self.low[first:end], bitorder="little")
        bits = bits[lo * self.width - 8 * first :][: (hi - lo) * self.width].reshape(hi - lo, self.width)
        weights = np.uint64(1) << np.arange(self.width, dtype=np.uint64)
        return (bits.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
