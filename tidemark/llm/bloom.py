"""URL filters by a cascade of Bloom filters.

Level 1 holds the listed keys; level 2 the keys of the corpus that level 1 takes for listed though they
are not; level 3 the listed keys that level 2 takes for such; and so on, until a level has nothing to
hold. Over the universe the cascade was made from, which is every key that any url of the corpus can
ask for and every listed key, a key's membership is exact: the first level that denies a key tells it.
So urls are judged without a join.

Building reads the corpus once for its distinct keys; each level is written to the shared folder, and
its bits are set by tasks and merged by bitwise or. Only filters reach the driver, sized by their keys.
A cascade beyond the size that may be broadcast is cut by key hash into shards, each a cascade of its own
keys, as many as it takes; one shard is held and asked at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidemark.llm.common import cut, discard

BITS_PER_KEY = 10
HASHES = 5
#: Bytes of filters that are broadcast at once; a larger cascade is cut into shards. SHARD_BYTES is the least that cuts it.
MAX_BYTES = 64 << 20
SHARD_BYTES = 4 << 10
#: Bits that one row of a partial filter holds.
SLICE = 1 << 16
MAX_LEVELS = 64


def mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th hash of 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = h.view(np.uint64) + np.uint64((k * 0x9E3779B97F4A7C15) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def places(h: np.ndarray, level: int, bits: int) -> list[np.ndarray]:
    return [(mixed(h, level * HASHES + k) % np.uint64(bits)).astype(np.int64) for k in range(HASHES)]


def holds(bitmap: np.ndarray, level: int, h: np.ndarray) -> np.ndarray:
    """Which hashes a level takes for its own; bitmap is bytes, low bit first."""
    out = np.ones(len(h), bool)
    for at in places(h, level, len(bitmap) * 8):
        out &= (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return out


def filter_of(keys: DataFrame, level: int, n: int) -> np.ndarray:
    """The bitmap of the 64-bit key hashes `h` in keys."""
    bits = -(-max(n, 1) * BITS_PER_KEY // 64) * 64

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(np.concatenate(places(batch.column(0).to_numpy(zero_copy_only=False), level, bits)))
            cuts = np.flatnonzero(np.diff(at // SLICE)) + 1
            for own in np.split(at, cuts) if len(at) else []:
                part = np.zeros(SLICE, bool)
                part[own % SLICE] = True
                yield pa.RecordBatch.from_arrays([pa.array([own[0] // SLICE]), pa.array(np.packbits(part, bitorder="little").view(np.int64)[None, :].tolist(), pa.list_(pa.int64()))], names=["slice", "words"])

    rows = keys.select("h").mapInArrow(partial, "slice long, words array<long>")
    words = rows.select("slice", F.posexplode("words").alias("at", "w")).filter("w <> 0").groupBy("slice", "at").agg(F.bit_or("w").alias("w"))
    bitmap = np.zeros(-(-bits // SLICE) * SLICE // 64, np.int64)
    got = words.toPandas()
    bitmap[got["slice"] * (SLICE // 64) + got["at"]] = got["w"]
    return bitmap.view(np.uint8)[: bits // 8]


def build(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> list[np.ndarray] | None:
    """The cascade's bitmaps for distinct key hashes h; None if it would be larger than max_bytes."""
    levels: list[np.ndarray] = []
    keys = cut(listed.select("h"), "level")
    others = cut(universe.select("h").join(keys, "h", "left_anti"), "level")
    made = [keys, others]
    while n := keys.count():
        if len(levels) == MAX_LEVELS or sum(map(len, levels)) + n * BITS_PER_KEY // 8 > max_bytes:
            levels = None
            break
        levels.append(filter_of(keys, len(levels), n))
        # what passes this level and isn't held by it is for the next
        made.append(cut(others.filter(F.get(_passes(levels[-1], len(levels) - 1)(F.array("h")), F.lit(0))), "level"))
        keys, others = made[-1], keys
    discard(*made)
    return levels


def shards(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> Iterator[tuple[list[np.ndarray], int, int]]:
    """(bitmaps, shard, of) one after another: cascades of the keys with h mod `of` = shard, of max_bytes at most each.

    A shard that is too large is cut in two. Only the one that is given out is held.
    """
    open_ = [(0, 1)]
    while open_:
        shard, of = open_.pop()
        own = F.pmod("h", F.lit(of)) == shard
        levels = build(listed.filter(own), universe.filter(own), max(max_bytes, SHARD_BYTES))
        if levels is None:
            open_ += [(shard + of, 2 * of), (shard, 2 * of)]
        else:
            yield levels, shard, of


def _per_key(test):
    """A function of an array<long> column, from one of a numpy array."""

    @pandas_udf("array<boolean>")
    def each(keys: pd.Series) -> pd.Series:
        sizes = keys.map(len).to_numpy(np.int64)
        flat = np.concatenate([np.zeros(0, np.int64), *keys]).astype(np.int64)
        return pd.Series(np.split(test(flat), np.cumsum(sizes)[:-1]))

    return each


def _passes(bitmap: np.ndarray, level: int):
    return _per_key(lambda h: holds(bitmap, level, h))


def member(levels: list[np.ndarray], shard: int = 0, of: int = 1):
    """A function of an array<long> column of key hashes: which of them are listed in this shard?"""

    def listed(h: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(h), bool), np.mod(h, of) == shard
        for level, bitmap in enumerate(levels):
            yes = holds(bitmap, level, h)
            out[open_ & ~yes] = level % 2 == 1  # denied here, so held by the level before
            open_ &= yes
        out[open_] = len(levels) % 2 == 1
        return out

    return _per_key(listed)
