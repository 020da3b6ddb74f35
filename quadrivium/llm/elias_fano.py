"""Elias-Fano coding of a non-decreasing sequence of non-negative integers, with select.

A value below ``universe`` is split into ``low_bits`` low bits, packed, and a high part, whose gaps are written in unary:
value number i sets bit ``high(i) + i``.  That takes about 2 + log2(universe / n) bits a value.  ``select(i)`` finds
the i-th set bit from a sample of every 256th one and reads a few bytes; there is no table of 64-bit offsets.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QQBI")


def encode(values: np.ndarray, universe: int) -> bytes:
    n = len(values)
    values = values.astype(np.uint64)
    low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
    low = values & np.uint64((1 << low_bits) - 1)
    bits = ((low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
    places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    high = np.zeros((universe >> low_bits) + n + 1, np.uint8)
    high[places] = 1
    packed = np.packbits(high, bitorder="little").tobytes()
    samples = places[::SAMPLE].astype("<u4").tobytes()
    return _HEAD.pack(n, universe, low_bits, len(packed)) + samples + np.packbits(bits, bitorder="little").tobytes() + packed


class EliasFano:
    """A coded sequence, read from ``data`` at ``at``; ``end`` is where it ends."""

    def __init__(self, data: bytes, at: int = 0):
        self.n, self.universe, self.low_bits, size = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        count = -(-self.n // SAMPLE)
        self.samples = np.frombuffer(data, "<u4", count, at)
        at += 4 * count
        low_size = -(-self.n * self.low_bits // 8)
        self.low = np.frombuffer(data, np.uint8, low_size, at)
        self.high = np.frombuffer(data, np.uint8, size, at + low_size)
        self.end = at + low_size + size

    def __len__(self) -> int:
        return self.n

    def _low(self, i: int) -> int:
        start = i * self.low_bits
        first, last = start // 8, -(-(start + self.low_bits) // 8)
        return (int.from_bytes(self.low[first:last].tobytes(), "little") >> (start % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value number ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(self.samples[i // SAMPLE])
        missing = i % SAMPLE
        byte, seen = place // 8, place % 8
        while True:  # bytes with at most 8 set bits each
            bits = np.flatnonzero(np.unpackbits(self.high[byte:byte + 64], bitorder="little")[seen:])
            if len(bits) > missing:
                place = byte * 8 + seen + int(bits[missing])
                return ((place - i) << self.low_bits) | self._low(i)
            missing -= len(bits)
            byte, seen = byte + 64, 0

    def values(self) -> np.ndarray:
        """All values."""
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        out = (places - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            bits = np.unpackbits(self.low, bitorder="little")[:self.n * self.low_bits].reshape(self.n, self.low_bits)
            out |= (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return out
