"""MinHash signatures of hashed shingle sets, in bands: equal keys of one band make a candidate."""

from __future__ import annotations

import numpy as np

#: A pair of similarity 0.8 shares one of 12 bands of 4 minima with probability 0.998.
BANDS, ROWS = 12, 4
#: Shingles hashed at once.
BLOCK = 1 << 16
SEEDS = np.random.default_rng(7).integers(0, 1 << 32, (2, BANDS * ROWS), dtype=np.uint32)
ODD, FLIP = SEEDS[0] | np.uint32(1), SEEDS[1]
MIX = np.uint64(0x9E3779B97F4A7C15)


def band_keys(v: np.ndarray, start: np.ndarray) -> np.ndarray:
    """(sets, BANDS) 64-bit keys of sets of 32-bit hashes, laid end to end in v from each start; none is empty."""
    least = np.empty((BANDS * ROWS, len(start)), np.uint32)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(start, start[a] + BLOCK)))
        part = v[start[a] : start[b] if b < len(start) else len(v)]
        at, x = start[a:b] - start[a], np.empty_like(part)
        for k in range(BANDS * ROWS):
            np.bitwise_xor(part, FLIP[k], out=x)
            np.multiply(x, ODD[k], out=x)
            np.minimum.reduceat(x, at, out=least[k, a:b])
        a = b
    keys = np.empty((len(start), BANDS), np.uint64)
    for k in range(BANDS):
        x = np.full(len(start), k + 1, np.uint64)
        for r in range(ROWS):
            x = (x ^ least[k * ROWS + r]) * MIX
            x ^= x >> np.uint64(29)
        keys[:, k] = x
    return keys
