"""64-bit hashes of all words of a batch of texts, without a loop over words.

A word's hash is the sum of its bytes' values times powers of an odd number by their place in the word, modulo 2**64.
Two words of a table agree by chance with a probability of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_ODD = 0x9E3779B97F4A7C15 | 1
_RNG = np.random.default_rng(20_240_001)
_VALUES = _RNG.integers(1, 2**64, 256, dtype=np.uint64)
_VALUES[65:91] = _VALUES[97:123]  # A-Z count as a-z
_GAP = np.zeros(256, bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
#: Powers for words of up to so many bytes are kept; longer ones make their own.
_KEPT = 4096


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _ODD, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS = _powers(_KEPT)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text; words are gaps between ASCII white space."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    if texts.buffers()[2] is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    bounds = offsets - offsets[0]
    solid = ~_GAP[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    starts_at = bounds[:-1][bounds[:-1] < bounds[1:]]
    first[starts_at] = solid[starts_at]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[starts_at[1:] - 1] = solid[starts_at[1:] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    sizes = ends - starts + 1
    heads = np.cumsum(sizes) - sizes
    place = np.arange(heads[-1] + sizes[-1]) - np.repeat(heads, sizes)
    longest = int(sizes.max())
    powers = _POWERS if longest <= _KEPT else _powers(longest)
    sums = np.add.reduceat(_VALUES[data[solid]] * powers[place], heads)
    return mixed(sums), np.diff(np.searchsorted(starts, bounds))
