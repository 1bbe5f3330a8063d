"""Fuzzy line dedup: MinHash over character shingles, banding, exact verification, union-find.

Lines that are equal, or whose sets of SHINGLE-character shingles have a Jaccard similarity of THRESHOLD
or more along some chain of lines, form a component; of each component the first line stays, in the
order of doc_id and line number. BANDS bands of ROWS minima find a pair of similarity 0.8 with
probability 0.998; every pair found is verified on the lines themselves.

Lines are hashed where they are read, so only hashes are shuffled to find the distinct ones. A bucket of
a band is never gathered: each line first meets its bucket's smallest one only. Once the components of
these links are known, only buckets of several components are left, and there only lines outside the
smallest line's component meet the others, in tiles of TILE by TILE lines. A tile gives a spanning forest
of its links between components. So no link that banding finds is lost to a bucket's size, and no task
holds a bucket.

The shingles are hashed by numpy in Arrow batches: the same steps as SQL functions went over this
operator's limits (README has the figures).

Defined results: lines end at \\n; a line without a visible character always stays; a shorter line than a
shingle is one shingle; a null text has no lines; equal rows (doc_id and text) are judged alike, and
keep the same lines; a null doc_id comes first; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, cut, discard
from tidemark.llm.minhash import BANDS, MIX, band_keys
from tidemark.llm.tiles import Tile, forest, tile_rows, tiles_together

SHINGLE = 8
#: Similarity in tenths.
THRESHOLD = 8
#: Pairs verified at once, columns of a tile's matrix at once, and shingles from which a tile goes pair by pair.
PAIRS = 64
COLUMNS = 1 << 15
LARGE = 1 << 22
#: Shingles of pairs compared at once, and the pairs a line up to which a tile's pairs are compared with other tiles'.
VALUES, FEW = 1 << 15, 8


def line_shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): 64-bit hashes of all shingles, line by line, and how many each line has."""
    codes = np.frombuffer("".join(x if len(x) >= SHINGLE else x + "\0" * (SHINGLE - len(x)) for x in lines).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    size = np.maximum(np.fromiter(map(len, lines), np.int64, len(lines)), SHINGLE)
    h, m = (codes + np.uint64(1)) * MIX, 1
    while m < SHINGLE:
        h = h[:-m] * np.uint64(pow(int(MIX), m, 1 << 64)) + h[m:]
        m *= 2
    own = np.ones(len(codes), bool)  # shingles that lie in one line
    ends = np.cumsum(size)
    for k in range(1, SHINGLE):
        own[ends - k] = False
    h = h[own[: len(h)]]
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93), size - SHINGLE + 1


def distinct_of(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct keys of row number and 48 bits of hash."""
    key = np.sort((rows.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16)))
    return key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key


def similar_pairs(lines: list[str], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether lines[x] and lines[y] are similar, pair by pair; each line is hashed once. At most 65,536 lines."""
    v, count = line_shingles(lines)
    key = distinct_of(np.repeat(np.arange(len(lines)), count), v)
    size = np.bincount((key >> np.uint64(48)).astype(np.int64), minlength=len(lines))
    start, value = np.cumsum(size) - size, key & np.uint64((1 << 48) - 1)
    ok = np.zeros(len(x), bool)
    near = np.nonzero(10 * np.minimum(size[x], size[y]) >= THRESHOLD * np.maximum(size[x], size[y]))[0]
    ends, at = np.cumsum(size[x[near]] + size[y[near]]), 0
    while at < len(near):
        to = max(at + 1, min(at + (1 << 16), int(np.searchsorted(ends, (ends[at - 1] if at else 0) + VALUES, "right"))))
        part, sides = near[at:to], []
        for s in (x[part], y[part]):
            n = size[s]
            own = np.repeat(start[s] - np.cumsum(n) + n, n) + np.arange(n.sum())
            sides.append((np.repeat(np.arange(len(part), dtype=np.uint64), n) << np.uint64(48)) | value[own])
        keys = np.sort(np.concatenate(sides), kind="stable")  # two sorted runs: one merge
        twice = keys[1:][keys[1:] == keys[:-1]]
        both = np.bincount((twice >> np.uint64(48)).astype(np.int64), minlength=len(part))
        ok[part] = 10 * both >= THRESHOLD * (size[x[part]] + size[y[part]] - both)
        at = to
    return ok


def similar(left: list[str], right: list[str]) -> np.ndarray:
    """Whether the lines of each pair are similar."""
    out = [np.zeros(0, bool)]
    for at in range(0, len(left), PAIRS):
        number: dict[str, int] = {}
        x, y = (np.array([number.setdefault(s, len(number)) for s in part[at : at + PAIRS]]) for part in (left, right))
        out.append(similar_pairs(list(number), x, y))
    return np.concatenate(out)


def similar_of_tile(left: list[str], right: list[str]) -> np.ndarray:
    """(left, right) similarity verdicts, by products of 0/1 matrices over some shingles at a time."""
    lines = left + right
    v, count = line_shingles(lines)
    number = np.unique(v, return_inverse=True)[1]
    order = np.argsort(number, kind="stable")
    rows, number = np.repeat(np.arange(len(lines)), count)[order], number[order]
    both, size = np.zeros((len(left), len(right)), np.float32), np.zeros(len(lines), np.float32)
    for at in range(0, int(number[-1]) + 1, COLUMNS):
        x, y = np.searchsorted(number, [at, at + COLUMNS])
        m = np.zeros((len(lines), min(COLUMNS, int(number[-1]) + 1 - at)), np.float32)
        m[rows[x:y], number[x:y] - at] = 1
        both += m[: len(left)] @ m[len(left) :].T
        size += m.sum(1)
    a, b = size[: len(left), None], size[None, len(left) :]
    return 10 * both >= THRESHOLD * (a + b - both)


def tile_links(left: list[tuple[int, int, str]], right: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Links between (component, id, line) of two tiles that connect the components that all similar pairs would."""
    apart = np.array([x[0] for x in left])[:, None] != np.array([x[0] for x in right])[None, :]
    s, t = [x[2] for x in left], [x[2] for x in right]
    if sum(map(len, s)) + sum(map(len, t)) <= LARGE:
        x, y = np.nonzero(similar_of_tile(s, t) & apart)
    else:
        x, y = np.nonzero(apart)
        ok = np.array([similar([s[i]], [t[j]])[0] for i, j in zip(x, y, strict=True)], bool)
        x, y = x[ok], y[ok]
    return forest(x, y, left, right)


def links_of_tiles(tiles: list[Tile]) -> list[tuple[int, int]]:
    """tile_links of each tile; the pairs of small tiles are compared together, as a tile alone is mostly overhead."""
    out, small = [], []
    for left, right in tiles:
        few = len(left) * len(right) <= FEW * (len(left) + len(right)) and sum(len(r[2]) for r in left + right) <= 8 * VALUES
        if few:
            small.append((left, right))
        else:
            out += tile_links(left, right)
    while small:
        number, lines, met, chars = {}, [], [], 0
        while small and (not met or (chars <= VALUES and len(lines) < 1 << 15)):
            left, right = small.pop()
            for row in left + right:
                if row[1] not in number:
                    number[row[1]] = len(lines)
                    lines.append(row[2])
                    chars += len(row[2])
            met.append((left, right, [(i, j) for i, a in enumerate(left) for j, b in enumerate(right) if a[0] != b[0]]))
        x = np.array([number[left[i][1]] for left, _, pairs in met for i, _ in pairs], np.int64)
        y = np.array([number[right[j][1]] for _, right, pairs in met for _, j in pairs], np.int64)
        ok, at = similar_pairs(lines, x, y), 0
        for left, right, pairs in met:
            found = [p for p, good in zip(pairs, ok[at : at + len(pairs)], strict=True) if good]
            at += len(pairs)
            out += forest([i for i, _ in found], [j for _, j in found], left, right)
    return out


def exploded(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(doc_id, mark, line_no, line): every line with a visible character; mark tells texts of one id apart."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return rows.filter(F.ltrim("line", F.lit(" \t\n\x0b\x0c\r")) != "")


def hashes(line: str) -> tuple[Column, Column]:
    return F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")


def signatures(rows: DataFrame) -> DataFrame:
    """(place, h1, h2, keys) of lines (doc_id, mark, line_no, line)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                v, count = line_shingles(part.column(5).to_pylist())
                keys = band_keys((v >> np.uint64(32)).astype(np.uint32), np.cumsum(count) - count).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[:5], lists], names=["doc_id", "mark", "line_no", "h1", "h2", "keys"])

    given = rows.select("doc_id", "mark", "line_no", *hashes("line"), "line")
    out = given.mapInArrow(each, "doc_id long, mark long, line_no int, h1 long, h2 long, keys array<long>")
    return out.select(F.struct("doc_id", "mark", "line_no").alias("place"), "h1", "h2", "keys")


def verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """(a, b, ok) of (a, b): are the lines of the two ids similar? lines has (id, line)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = similar(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    of = lambda c, t: lines.select(F.col("id").alias(c), F.col("line").alias(t))
    return pairs.join(of("a", "s"), "a").join(of("b", "t"), "b").select("a", "b", "s", "t").mapInArrow(each, "a long, b long, ok boolean")


def rejoined(known: DataFrame, links: DataFrame) -> DataFrame:
    """known (node, component) with the components that links (a, b) join taken as one: only components meet anew."""
    of = lambda c: known.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    between = cut(links.join(of("a"), "a").join(of("b"), "b").select(F.col("of_a").alias("a"), F.col("of_b").alias("b")), "between")
    met = between.select(F.col("a").alias("node")).union(between.select("b")).distinct()
    now = components(met, between, "line-links").select(F.col("node").alias("component"), F.col("component").alias("now"))
    out = cut(known.join(now, "component", "left").select("node", F.coalesce("now", "component").alias("component")), "components")
    discard(between, known)
    return out


def texts_of(docs: DataFrame, wanted: DataFrame, text: str, key: str) -> DataFrame:
    """(id, line) of wanted (id, place). Only documents with such a line are split, and only those lines leave them."""
    at = wanted.groupBy(F.col("place.doc_id").alias("d"), F.col("place.mark").alias("m")).agg(F.collect_list(F.struct("id", F.col("place.line_no").alias("line_no"))).alias("wanted"))
    at = cut(at, "wanted-lines")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    rows = rows.join(at, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m"))).select("wanted", F.split("text", "\n").alias("lines"))
    return rows.select("lines", F.explode("wanted").alias("one")).select("one.id", F.col("lines")[F.col("one.line_no")].alias("line")).dropDuplicates(["id"])


def line_components(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(h1, h2, keep): each line that repeats or is similar to another, and its component's first place."""
    rows = exploded(docs, text, key)
    distinct = signatures(rows).groupBy("h1", "h2").agg(F.min("place").alias("place"), F.count("*").alias("n"), F.any_value("keys").alias("keys"))
    distinct = cut(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct-lines")
    member = distinct.select("id", F.explode("keys").alias("bucket"))
    buckets = cut(member.groupBy("bucket").agg(F.min("id").alias("low"), F.count("*").alias("n")).filter("n > 1"), "buckets")
    member = cut(member.join(buckets, "bucket"), "members")
    nodes = cut(member.select(F.col("id").alias("node")).distinct(), "nodes")
    lines = cut(texts_of(docs, distinct.join(nodes, F.col("id") == F.col("node"), "left_semi").select("id", "place"), text, key), "lines")
    pairs = member.filter("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b")).distinct()
    edges = cut(verified(pairs, lines).filter("ok").select("a", "b"), "star")
    known = cut(components(nodes, edges, "line-links"), "components")
    placed = cut(member.join(known.withColumnRenamed("node", "id"), "id"), "placed")
    more = cut(tiles_together(tile_rows(placed, known).join(lines.withColumnRenamed("line", "text"), "id"), links_of_tiles).distinct(), "more")
    if not more.isEmpty():
        known = rejoined(known, more)
    first = known.join(distinct.select(F.col("id").alias("node"), "place"), "node").groupBy("component").agg(F.min("place").alias("keep"))
    fuzzy = known.join(first, "component").select(F.col("node").alias("id"), "keep")
    known_as = distinct.select("h1", "h2", "n", "id", "place").join(fuzzy, "id", "left").select("h1", "h2", "n", "place", F.coalesce("keep", "place").alias("keep"))
    out = cut(known_as.filter((F.col("n") > 1) | ~F.col("keep").eqNullSafe(F.col("place"))).select("h1", "h2", "keep"), "lines-kept")
    discard(distinct, buckets, member, nodes, lines, edges, placed, known, more)
    return out


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of docs: doc_id, n_lines, n_removed, removed (line numbers from 0), kept_text."""
    rows = exploded(docs, text, key).select("doc_id", "mark", "line_no", *hashes("line")).join(line_components(docs, text, key), ["h1", "h2"])
    gone = rows.filter(~F.struct("doc_id", "mark", "line_no").eqNullSafe(F.col("keep"))).groupBy("doc_id", "mark").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))
    gone = cut(gone.select(F.col("doc_id").alias("__doc"), F.col("mark").alias("__mark"), "removed"), "removed-lines")
    all_rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), F.coalesce(text, F.lit("")).alias("text"), F.col(text).isNull().alias("empty"))
    out = all_rows.join(gone, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("mark") == F.col("__mark")), "left")
    removed, lines = F.coalesce("removed", F.array().cast("array<int>")), F.split("text", "\n")
    return out.select(
        "doc_id",
        F.when(F.col("empty"), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.size(removed).cast("long").alias("n_removed"),
        removed.alias("removed"),
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("removed", i)), "\n")).alias("kept_text"),
    )
