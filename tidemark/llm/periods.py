"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of consecutive words with smallest period q, at least max(MIN_LENGTH, 2 q) long, that
no neighbouring word extends. Every text is searched whole, exactly and in near-linear time:

- Periods up to 5 come from comparing each word with the one so far ahead.
- At scale t = 2, 4, 8, ... the periods from 3 t to 6 t - 1 are sought. Windows of t words with a period
  up to t / 3 are left out (they lie in runs that smaller scales found). A position i belongs to the
  synchronising set if the least hash of the other windows from i to i + t is that of window i or i + t;
  so equal contexts of 2 t words make the same choice. Pairs of set positions with equal contexts and
  a distance in the scale's range propose it as a period. The set has a few positions in t words.
- A run whose whole first period has a small period itself may have no set position. Then two regions of
  the same small period touch within the run, and the distances at which their phases agree propose
  its period.
- A proposal is followed word by word to both sides. What is at least twice the period long is a run;
  of equal stretches the smallest period counts.

Hashes choose and propose only; an unlucky hash costs time and never changes a result.

Defined results: a null or blank text has no words and no run; a null id plants nothing; repeated rows
count each; an empty table gives an empty result; extra columns are not read. A text is held by one task
at some 60 bytes a word.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_LENGTH = 12
#: Periods up to this are compared at every word; the scales begin above it.
DIRECT = 5
#: Words of short texts searched together.
GATHERED = 1 << 16
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SCHEMA = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, n_kept long, runs_sha256 string, collapsed_sha256 string"


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the stretches of True, at least `least` long."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], same, [False]))))
    start, size = edge[::2], edge[1::2] - edge[::2]
    return start[size >= least], size[size >= least]


def agreed(w: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from a and b on agree, forwards (step 1) or backwards (step -1, from a - 1 and b - 1)."""
    size, total = 16, 0
    most = len(w) - b if step > 0 else a
    while total < most:
        size = min(size * 2, most - total)
        if step > 0:
            bad = w[a + total : a + total + size] != w[b + total : b + total + size]
        else:
            bad = (w[a - total - size : a - total] != w[b - total - size : b - total])[::-1]
        at = int(bad.argmax())
        if bad[at]:
            return total + at
        total += size
    return total


class Runs:
    """Stretches found, each with its smallest period."""

    def __init__(self, w: np.ndarray):
        self.w, self.period = w, {}

    def put(self, start: int, end: int, d: int) -> None:
        if self.period.get((start, end), d) >= d:
            self.period[start, end] = d

    def follow(self, pairs: dict[int, list[int]]) -> None:
        """Positions i by distance d: the stretches in which words d apart agree, around i and i + d."""
        for d, places in pairs.items():
            seen = -1
            for i in sorted(places):
                if i < seen:
                    continue
                left, right = agreed(self.w, i, i + d, -1), agreed(self.w, i, i + d, 1)
                seen = i + right + 1
                if left + right >= d:
                    self.put(i - left, i + d + right, d)

    def regions(self, size: int, most: int) -> list[tuple[int, int, int]]:
        """(start, end, period) of runs of periods up to `most`, at least `size` long."""
        return sorted((s, e, q) for (s, e), q in self.period.items() if q <= most and e - s >= size)


def find(w: np.ndarray, longest: int) -> dict[tuple[int, int], int]:
    """(start, end) -> smallest period of every stretch at least twice its smallest period long.

    w: word numbers, of one text or of several with a number of its own after each; longest: the words of the longest text.
    """
    runs, n = Runs(w), len(w)
    for d in range(1, min(DIRECT, longest // 2) + 1):
        for s, size in zip(*(x.tolist() for x in stretches(w[:-d] == w[d:], d)), strict=True):
            runs.put(s, s + size + d, d)
    if 3 * 2 * 2 > longest:
        return runs.period
    code = mixed(w.astype(np.uint64) + np.uint64(BASE))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(code * powers(BASE, n), dtype=np.uint64)))
    back = powers(BASE_INVERSE, n)
    t = 2
    while 6 * t <= longest:
        scale(runs, sums, back, t, longest)
        t *= 2
    return runs.period


def scale(runs: Runs, sums: np.ndarray, back: np.ndarray, t: int, longest: int) -> None:
    """Adds the runs of periods 3 t to 6 t - 1; runs of smaller periods are there already."""
    n = len(back)
    if n < 2 * t:
        return
    low, high = 3 * t, min(6 * t, longest // 2 + 1)
    name = mixed((sums[t:] - sums[:-t]) * back[: n - t + 1])
    regions = runs.regions(t, t // 3)
    out = np.zeros(n + 1, np.int64)
    for s, e, _ in regions:
        out[s] += 1
        out[e - t + 1] -= 1
    least = np.where(np.cumsum(out)[: len(name)] > 0, NONE, name)
    clean = least
    size = 1  # least[i] is the least of windows i to i + size - 1
    while size < t + 1:
        step = min(size, t + 1 - size)
        least = np.minimum(least[: len(least) - step], least[step:])
        size += step
    m = len(least)
    place = np.flatnonzero((least != NONE) & ((least == clean[:m]) | (least == clean[t : t + m])))
    first, second = name[place], name[place + t]
    pairs: dict[int, list[int]] = {}
    for k in range(1, len(place)):
        far = place[k:] - place[:-k]
        near = far < high
        if not near.any():
            break
        good = np.flatnonzero(near & (far >= low) & (first[k:] == first[:-k]) & (second[k:] == second[:-k]))
        for i, d in zip(place[good].tolist(), far[good].tolist(), strict=True):
            pairs.setdefault(d, []).append(i)
    of_period: dict[int, tuple[int, int]] = {}
    for s, e, q in regions:
        before = of_period.get(q)
        of_period[q] = (s, e)
        if q > 1 and before and s <= before[1]:
            touching(runs.w, before, (s, e), q, low, high, pairs)
    runs.follow(pairs)


def touching(w: np.ndarray, one: tuple[int, int], two: tuple[int, int], q: int, low: int, high: int, pairs: dict[int, list[int]]) -> None:
    """Distances at which the phases of two touching regions of period q agree, from the end of the first."""
    x, most = one[1], min(one[1] - one[0], two[1] - one[1] + q, high - 1)
    shared = max(0, min(q, two[1] - x))
    for r in range(1, q):
        # words x to x + shared - 1 of the second region against the first one's, in the phase of x - r
        phase = x - q + (np.arange(shared) - r) % q
        if np.array_equal(w[x : x + shared], w[phase]):
            for d in range(low + (r - low) % q, most + 1, q):
                pairs.setdefault(d, []).append(x - d)


def planted(words: list[bytes], key: int | None) -> list[bytes]:
    """The words of a document, with the repeats that its id asks for."""
    n = len(words)
    h = 1 if key is None else zlib.crc32(str(key).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def searched(docs: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    order = sorted((k for k in range(len(docs)) if len(docs[k]) >= MIN_LENGTH), key=lambda k: len(docs[k]))
    at = 0
    while at < len(order):
        number: dict[bytes, int] = {}
        held, codes, starts = [], [], []
        while at < len(order) and (not held or len(codes) + len(docs[order[at]]) <= GATHERED and len(docs[order[at]]) <= 2 * len(docs[held[0]])):
            words = docs[order[at]]
            held.append(order[at])
            starts.append(len(codes))
            codes += [number.setdefault(x, len(number)) for x in words]
            codes.append(-len(held))  # equal to nothing else
            at += 1
        found = find(np.array(codes, np.int64), len(docs[held[-1]]))
        for (s, e), q in sorted(found.items()):
            if e - s >= max(MIN_LENGTH, 2 * q):
                k = int(np.searchsorted(starts, s, "right")) - 1
                out[held[k]].append((s - starts[k], e - s, q))
    for x in out:
        x.sort(key=lambda r: (r[0], r[2]))
    return out


def kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run has after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for s, size, q in runs:
        drop[s + q] += 1
        drop[s + size] -= 1
    gone = np.cumsum(drop)[:-1] > 0
    return [x for x, out in zip(words, gone.tolist(), strict=True) if not out]


def find_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", plant: bool = False, collapsed: bool = False) -> DataFrame:
    """For every row: key, number of words, of runs, the longest run, hashes of all runs and of the collapsed text.

    plant: first the repeats that the id asks for. collapsed: with the collapsed text itself, as `collapsed_text`,
    and all runs as an array of (start, length, period), as `runs`.
    """
    more = ", runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed_text binary" if collapsed else ""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            docs = [(t or b"").split() for t in batch.column(1).to_pylist()]  # the six characters that separate words
            if plant:
                docs = [planted(x, k) for x, k in zip(docs, keys, strict=True)]
            rows = [row(k, x, r, collapsed) for k, x, r in zip(keys, docs, searched(docs), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema) if rows else pa.RecordBatch.from_pylist([], schema=schema)

    fields = [(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in SCHEMA.split(", ")]
    if collapsed:
        fields += [("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed_text", pa.binary())]
    schema = pa.schema(fields)
    out = docs.select(F.col(key).cast("long"), F.col(text).cast("binary")).mapInArrow(each, SCHEMA + more)
    return out.withColumn("collapsed_text", F.col("collapsed_text").cast("string")) if collapsed else out


def row(key: int | None, words: list[bytes], runs: list[tuple[int, int, int]], whole: bool) -> tuple:
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    rest = kept(words, runs)
    text = b" ".join(rest)
    out = (key, len(words), len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, len(rest), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest())
    return (*out, [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], text) if whole else out
