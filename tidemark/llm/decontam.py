"""Benchmark decontamination: SimHash windows of an item's size, verified by shingle similarity.

A window of a document as long as an item (in words) is contaminated if the weighted similarity of its
five-word shingles with the item's (sum of smaller over sum of larger multiplicities) is THRESHOLD or
more. Every such window shares a shingle with an item of its length; other windows are passed over by
hash, which loses nothing. The rest get a SimHash fingerprint, and the items to compare them with come
from a multi-index alone: fingerprints are cut into BLOCKS blocks, of which one differs in
RADIUS // BLOCKS bits or fewer, so every item within RADIUS bits is found. An item is stored under all
block values STORED bits away, and a window asks for all values the remaining bits away. Exact
similarity then decides.

At similarity 0.8 fingerprints of 64 bits differ in about 10 bits, so some windows just above it lie
beyond RADIUS; the tests measure recall against all windows of all items.

Items are broadcast in groups of at most MAX_ITEMS items and MAX_WORDS words; each group is one pass
over the documents, so a benchmark of any size is compared whole with memory that does not grow.

Defined results: words are runs of letters, digits and underscores, lower-cased; an item of fewer than
five words is one shingle; items without words match nothing, nor do null or empty texts; a text shorter
than an item is compared whole; repeated item texts are items of their own; a null id is reported as
null; repeated rows are reported each; an empty table on either side gives an empty result. Texts are
read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.llm.common import cut, unused

SHINGLE = 5
THRESHOLD = 0.8
RADIUS = 19
BLOCKS = 4
STORED = 2
#: Windows fingerprinted, and windows looked up, at once.
RUN, ASK = 4096, 512
MAX_ITEMS = 20_000
MAX_WORDS = 2_000_000
WORD = re.compile(r"\w+")
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
REMEMBERED = 1_000_000


def hashes(parts: list[str], known: dict[str, int]) -> np.ndarray:
    if len(known) > REMEMBERED:
        known.clear()
    for w in set(parts).difference(known):
        known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))


def shingles(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; none if there are fewer."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - size + 1, np.uint64)
    for k in range(size):
        out = (out + h[k : k + len(out)]) * MULTIPLIER
    return out ^ (out >> np.uint64(29))


def bits(s: np.ndarray) -> np.ndarray:
    """(shingles, 64) bits of mixed shingle hashes."""
    s = (s ^ (s >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unpackbits(np.ascontiguousarray(s).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def packed(ones: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints from (windows, 64) counts of set bits among n shingles each, repeats included."""
    return np.packbits(2 * ones > n, axis=1, bitorder="little").view(np.uint64).ravel()


def window_prints(s: np.ndarray, first: int, last: int, n: int) -> np.ndarray:
    """The fingerprint of each window of n shingles that starts at first to last."""
    ones = np.zeros((last - first + n + 1, 64), np.int32)
    np.cumsum(bits(s[first : last + n]), axis=0, out=ones[1:])
    return packed(ones[n:] - ones[:-n], n)


def multiset(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(s, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of multisets."""
    at = np.minimum(np.searchsorted(b[0], a[0]), len(b[0]) - 1)
    both = int(np.where(b[0][at] == a[0], np.minimum(a[1], b[1][at]), 0).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


def spread(low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """The union of ranges low to high, both sorted, as ranges that don't meet."""
    out: list[tuple[int, int]] = []
    for a, b in zip(low.tolist(), high.tolist(), strict=True):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def flips(width: int, most: int) -> np.ndarray:
    return np.array([m for m in range(1 << width) if m.bit_count() <= most], np.int64)


class Items:
    """A group of benchmark items, ready for lookup."""

    def __init__(self, rows: list[tuple[int | None, str]], radius: int = RADIUS):
        known: dict[str, int] = {}
        self.radius, self.ids, self.bags, lengths, prints = radius, [], [], [], []
        first: list[np.ndarray] = []
        owner: list[np.ndarray] = []
        for item, text in rows:
            h = hashes(WORD.findall((text or "").lower()), known)
            if not len(h):
                continue
            s = shingles(h, min(SHINGLE, len(h)))
            first.append(s)
            owner.append(np.full(len(s), len(self.ids)))
            self.ids.append(item)
            self.bags.append(multiset(s))
            lengths.append(len(h))
            prints.append(packed(bits(s).sum(0, dtype=np.int64)[None], len(s)))
        self.lengths = np.array(lengths, np.int64)
        self.prints = np.concatenate([np.zeros(0, np.uint64), *prints])
        flat, own = np.concatenate([np.zeros(0, np.uint64), *first]), np.concatenate([np.zeros(0, np.int64), *owner])
        # each shingle with the lengths of the items that have it
        pairs = np.unique(np.stack([flat, self.lengths[own].astype(np.uint64)]), axis=1) if len(flat) else np.zeros((2, 0), np.uint64)
        self.shingles, self.shingle_lengths = pairs[0], pairs[1].astype(np.int64)
        self.sizes = sorted({min(SHINGLE, n) for n in lengths})
        self.mark = np.zeros(1 << 22, bool)
        self.mark[(flat >> np.uint64(42)).astype(np.int64)] = True
        self.width, near = 64 // BLOCKS, radius // BLOCKS
        stored, self.asked = flips(self.width, min(STORED, near)), flips(self.width, max(0, near - STORED))
        self.index = []
        for b in range(BLOCKS):
            values = (self.block(self.prints, b)[:, None] ^ stored).ravel()
            order = np.argsort(values, kind="stable")
            self.index.append((np.searchsorted(values[order], np.arange((1 << self.width) + 1)), (order // len(stored)).astype(np.int32)))

    def block(self, prints: np.ndarray, b: int) -> np.ndarray:
        return ((prints >> np.uint64(b * self.width)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def within(self, prints: np.ndarray, length: int) -> list[tuple[int, int]]:
        """(window, item) pairs of items of that length within the radius of a window's fingerprint."""
        found = set()
        for a in range(0, len(prints), ASK):
            some = prints[a : a + ASK]
            for b, (at, items) in enumerate(self.index):
                asked = self.block(some, b)[:, None] ^ self.asked
                low = at[asked]
                n = at[asked + 1] - low
                w, k = np.nonzero(n)
                low, n = low[w, k], n[w, k]
                item = items[np.arange(int(n.sum())) + np.repeat(low - np.cumsum(n) + n, n)]
                w = np.repeat(w, n)
                ok = (self.lengths[item] == length) & (np.bitwise_count(some[w] ^ self.prints[item]) <= self.radius)
                found.update(zip((w[ok] + a).tolist(), item[ok].tolist(), strict=True))
        return sorted(found)

    def hits(self, text: str, known: dict[str, int]) -> list[tuple[int | None, int, float]]:
        """(item, first word of the best window, its similarity) for each contaminating item."""
        h = hashes(WORD.findall(text.lower()), known)
        best: dict[int, tuple[float, int]] = {}
        for size in self.sizes:
            s = shingles(h, size)
            at = np.flatnonzero(self.mark[(s >> np.uint64(42)).astype(np.int64)])
            low, high = np.searchsorted(self.shingles, s[at], "left"), np.searchsorted(self.shingles, s[at], "right")
            n = high - low
            place = np.repeat(at, n)
            length = self.shingle_lengths[np.arange(int(n.sum())) + np.repeat(low - np.cumsum(n) + n, n)]
            for words in np.unique(length).tolist():
                if min(SHINGLE, words) != size:
                    continue
                p = place[length == words]
                m = min(words - size + 1, len(s))
                for a, b in spread(np.maximum(p - m + 1, 0), np.minimum(p, len(s) - m)):
                    for x in range(a, b + 1, RUN):
                        prints = window_prints(s, x, min(b, x + RUN - 1), m)
                        now, bag = -1, None
                        for w, k in self.within(prints, words):
                            if w != now:
                                now, bag = w, multiset(s[x + w : x + w + m])
                            sim = similarity(bag, self.bags[k])
                            if sim >= THRESHOLD and (sim, -x - w) > best.get(k, (0.0, 0)):
                                best[k] = (sim, -x - w)
        return [(self.ids[k], -a, sim) for k, (sim, a) in sorted(best.items())]


def item_groups(items: DataFrame, text: str, key: str) -> list[DataFrame]:
    """The benchmark in groups whose sizes are bounded; running sums are taken within hashed parts."""
    n = F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\\W+")).cast("long")
    rows = items.select(F.col(key).cast("long").alias("item"), F.col(text).alias("t"), n.alias("n"))
    total = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    parts = max(-(-total[0] * 2 // MAX_ITEMS), -(-total[1] * 2 // MAX_WORDS), 1)
    if parts == 1:
        return [rows]
    rows = rows.withColumn("part", F.pmod(F.xxhash64("item", "t"), F.lit(parts)).cast("int"))
    own = W.partitionBy("part").orderBy("item", "t").rowsBetween(W.unboundedPreceding, W.currentRow)
    grouped = cut(rows.withColumn("slice", F.greatest(F.floor(F.sum("n").over(own) / MAX_WORDS), F.floor(F.count("*").over(own) / MAX_ITEMS))), "items")
    names = grouped.select("part", "slice").distinct().collect()
    return [grouped.filter((F.col("part") == r[0]) & (F.col("slice") == r[1])).select("item", "t") for r in names]


def found_in(docs: DataFrame, items: DataFrame, item_text: str, item_key: str) -> DataFrame:
    """(tag, tag2, item_id, start_word, similarity) of docs (tag, tag2, text): a row for each text and item in it."""
    spark = docs.sparkSession

    def search(shared):
        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            group: Items = shared.value
            known: dict[str, int] = {}
            for batch in batches:
                hits = [(k, hit) for k, t in enumerate(batch.column(2).to_pylist()) if t for hit in group.hits(t, known)]
                at = pa.array([k for k, _ in hits], pa.int64())
                cols = list(zip(*[hit for _, hit in hits], strict=True)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()), strict=True))], names=["tag", "tag2", "item_id", "start_word", "similarity"])

        return each

    made = []
    for group in item_groups(items, item_text, item_key):
        shared = spark.sparkContext.broadcast(Items([(r["item"], r["t"]) for r in group.select("item", "t").collect()]))
        made.append(docs.mapInArrow(search(shared), "tag long, tag2 long, item_id long, start_word long, similarity double"))
    return reduce(DataFrame.unionByName, made)


def contaminated(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """(doc_id, item_id, start_word, similarity): one row for each document and item found in it."""
    rows = docs.select(F.col(key).cast("long").alias("tag"), F.lit(0).cast("long").alias("tag2"), text)
    return found_in(rows, items, item_text, item_key).withColumnRenamed("tag", "doc_id").drop("tag2")


def clean(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """The rows of docs, all their columns, whose text holds no item; ids play no part."""
    marks = (F.xxhash64(text), F.xxhash64(F.lit(1), text))
    names = (unused(docs, "__leak"), unused(docs, "__leak2"))
    found = cut(found_in(docs.select(marks[0].alias("tag"), marks[1].alias("tag2"), text), items, item_text, item_key).select(*(F.col(t).alias(n) for t, n in zip(("tag", "tag2"), names, strict=True))).distinct(), "leaks")
    return docs.join(found, (marks[0] == found[names[0]]) & (marks[1] == found[names[1]]), "left_anti")
