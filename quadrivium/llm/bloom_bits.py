"""Bloom filters whose parts are filled by Spark tasks and which are probed in Python workers.

A 64-bit hash belongs to one segment of SEGMENT_BITS bits by its high half and sets PROBES bits there.  A filter has no
false negatives, so what it lets through must be confirmed; where it is fuller than planned, more is let through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from quadrivium.llm.words import mixed

SEGMENT_BITS = 1 << 20
PROBES = 4
#: Bits for each hash of a filter that is planned by their number.
BITS_EACH = 12


def segment_of(hashes: np.ndarray, segments: int) -> np.ndarray:
    return ((hashes.view(np.uint64) >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def segments_for(bits: int) -> int:
    """Enough segments for so many bits; at most 2**31, which the high half can tell apart."""
    return min(max(1, -(-bits // SEGMENT_BITS)), 1 << 31)


class Bits:
    """Bits of some segments; those that are met first get the next free place."""

    def __init__(self, segments: int):
        self.segments = segments
        self.slots: dict[int, int] = {}
        self.bits = np.zeros(0, np.uint8)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """(hashes, PROBES) places in ``bits``."""
        found, inverse = np.unique(segment_of(hashes, self.segments), return_inverse=True)
        slot = np.array([self.slots.setdefault(s, len(self.slots)) for s in found.tolist()], np.int64)[inverse]
        need = len(self.slots) * (SEGMENT_BITS // 8)
        if need > len(self.bits):
            self.bits = np.concatenate([self.bits, np.zeros(max(need, 2 * len(self.bits)) - len(self.bits), np.uint8)])
        code = mixed(hashes.view(np.uint64))
        first, step = (code & np.uint64(0xFFFFFF)).astype(np.int64), ((code >> np.uint64(24)) | np.uint64(1)).astype(np.int64) & 0xFFFFFF
        inside = (first[:, None] + step[:, None] * np.arange(PROBES)) & (SEGMENT_BITS - 1)
        return slot[:, None] * SEGMENT_BITS + inside

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if not len(hashes):
            return np.zeros(0, bool)
        at = self._places(hashes)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(1)

    def add(self, hashes: np.ndarray) -> None:
        if len(hashes):
            at = self._places(hashes).ravel()
            for bit in range(8):  # places that repeat write the same value
                byte = at[(at & 7) == bit] >> 3
                self.bits[byte] |= np.uint8(1 << bit)

    def segment(self, number: int) -> bytes:
        at = self.slots[number] * (SEGMENT_BITS // 8)
        return self.bits[at:at + SEGMENT_BITS // 8].tobytes()


def filter_of(hashes: DataFrame, count: int, max_bytes: int) -> Broadcast:
    """A broadcast filter of ``hashes`` (one long column) with BITS_EACH bits for each of ``count``, at most ``max_bytes``.

    Tasks fill the segments; the driver holds ``max_bytes`` at most, whatever the size of the input.
    """
    segments = max(1, min(segments_for(count * BITS_EACH), 8 * max_bytes // SEGMENT_BITS))
    name = hashes.columns[0]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(segment_of(values, segments)), batch.column(0)], ["seg", "hash"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = Bits(segments)
        for batch in batches:
            bits.add(batch.column(1).to_numpy(zero_copy_only=False))
        for seg in bits.slots:
            yield pa.RecordBatch.from_arrays([pa.array([seg], pa.int64()), pa.array([bits.segment(seg)], pa.binary())], ["seg", "bits"])

    dealt = hashes.select(name).mapInArrow(number, "seg long, hash long").repartition("seg")
    whole = Bits(segments)
    whole.slots = {s: s for s in range(segments)}
    whole.bits = np.zeros(segments * (SEGMENT_BITS // 8), np.uint8)
    for row in dealt.mapInArrow(fill, "seg long, bits binary").toLocalIterator():
        at = row["seg"] * (SEGMENT_BITS // 8)
        whole.bits[at:at + SEGMENT_BITS // 8] = np.frombuffer(row["bits"], np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(whole)
