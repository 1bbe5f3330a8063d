"""SimHash near-dedup: fingerprints of whole texts, tiled exact comparison, connected components.

Distinct fingerprints are laid out in tiles by the population counts of their segments. The distance of
two fingerprints is at least the sum of the differences of those counts, so only tile pairs within the
radius are compared, each by numpy exclusive-or and bit counts. A tile of many fingerprints is cut into
parts of at most about PART rows, so no task holds an unbounded tile. A comparison gives a spanning
forest of its matches, not all pairs, and equal fingerprints are linked before it, by grouping.

Defined results: a null or empty text, or one without words, has fingerprint zero and links like any
other; a text of fewer than three words is one shingle; repeated rows are rows of their own; a null
doc_id is fingerprinted and linked, but never names a component that has another id (alone: null);
an empty table gives an empty result. Extra columns are not read, but for keep_first, keep_similar and
keep_near, which choose among rows of one id by a hash of all columns. There rows are judged by id and text, so
different texts under one id, or under none, are documents of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, cut, unused
from tidemark.llm.minhash import BANDS, MIX, band_keys
from tidemark.llm.tiles import Row, forest as spanning, tile_rows, tiled

SEED = 42
SHINGLE = 3
RADIUS = 2
PART = 2048
#: Distinct fingerprints from which eight segments prune more than they replicate.
MANY = 4_000_000
#: Shingle hashes whose bits are counted at once.
CHUNK = 1 << 16
#: Groups by similarity: words of a shingle, similarity in tenths, and the bits by which fingerprints of
#: such texts differ at most (about 10 on average; 22 is four deviations more).
SIMILAR_SHINGLE = 5
SIMILARITY = 8
WIDE = 22
#: Words whose hashes a worker remembers before it forgets them all.
REMEMBERED = 1_000_000
#: Columns of a tile's matrix at once, and shingles from which a tile goes pair by pair.
COLUMNS = 1 << 15
LARGE = 1 << 22


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint: a bit is set if it is set in over half of the shingles' hashes."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and ASCII space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    n = max(len(parts) - shingle + 1, 1)
    stop = ends[-n:].tolist()
    start = [0, *(ends[: n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(start, stop, strict=True)], "<u8")
    ones = np.zeros(64, np.int64)
    for a in range(0, n, CHUNK):
        ones += np.unpackbits(hashes[a : a + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), text).mapInArrow(each, "doc_id long, fp long")


def forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (from, to) that connect what lies within radius: among a, or between a and b if b is given."""
    all_ids = a if b is None else np.concatenate([a, b])
    right = a if b is None else b
    shift = 0 if b is None else len(a)
    i, j = [], []
    for at in range(0, len(a), 512):
        x, y = np.nonzero(np.bitwise_count(a[at : at + 512, None] ^ right[None, :]) <= radius)
        x += at
        ok = x < y if b is None else slice(None)
        i.append(x[ok])
        j.append(y[ok] + shift)
    i, j = np.concatenate(i), np.concatenate(j)
    label = np.arange(len(all_ids))
    while True:  # the smallest place reachable, by jumps
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    child = np.flatnonzero(label != np.arange(len(label)))
    return all_ids[child], all_ids[label[child]]


def runs(batches: Iterator[pa.RecordBatch], at: slice) -> Iterator[list[np.ndarray]]:
    """Sorted rows of long columns as arrays (columns, rows), one for each run of rows that agree in the
    columns `at`; a list of runs for each batch, a run going on in the next one being held back."""
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.concatenate([*held, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])], axis=1)
        new = np.flatnonzero((rows[at, 1:] != rows[at, :-1]).any(0)) + 1
        if len(new):
            yield np.split(rows[:, : new[-1]], new[:-1], axis=1)
        held = [rows[:, new[-1] :] if len(new) else rows]
    if held and held[0].shape[1]:
        yield held


def tile_edges(distinct: DataFrame, radius: int = RADIUS, part: int = PART) -> DataFrame:
    """(a, b): edges whose components are those of all pairs of distinct fp within radius.

    distinct has one column fp without repeats. Every fingerprint is sent to its own tile pair and to
    the pairs with the neighbouring tiles; a pair is compared where the two tiles' parts meet.
    """
    spark = distinct.sparkSession
    segments = 8 if distinct.count() >= MANY else 4
    width = 64 // segments
    mask = (1 << width) - 1
    tile = distinct.select("fp", sum((F.bit_count(F.shiftrightunsigned("fp", width * s).bitwiseAND(F.lit(mask))).cast("long") * (1 << (7 * s)) for s in range(segments)), F.lit(0)).alias("tile"))
    sizes = tile.groupBy("tile").count()
    parts = sizes.select("tile", F.expr(f"cast((count + {part - 1}) div {part} as int)").alias("parts"))
    # the differences of two tiles' counts, in half: a pair is named by its lower tile
    steps = [d for d in offsets(segments, radius) if d >= 0]
    pairs = parts.select(F.col("tile").alias("lo"), F.col("parts").alias("lo_parts"), F.explode(F.array(*[F.lit(d) for d in steps])).alias("step"))
    pairs = pairs.withColumn("hi", F.col("lo") + F.col("step")).join(parts.select(F.col("tile").alias("hi"), F.col("parts").alias("hi_parts")), "hi")
    pairs = cut(pairs.select("lo", "hi", "lo_parts", "hi_parts"), "tile-pairs")
    home = tile.join(parts, "tile").withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    as_lo = home.join(pairs.select(F.col("lo").alias("tile"), "hi", "hi_parts"), "tile").select("fp", F.col("tile").alias("lo"), "hi", F.col("own").alias("i"), F.explode(F.sequence(F.lit(0), F.col("hi_parts") - 1)).alias("j"), F.lit(0).alias("side"))
    as_hi = home.join(pairs.select(F.col("hi").alias("tile"), "lo", "lo_parts"), "tile").select("fp", "lo", F.col("tile").alias("hi"), F.explode(F.sequence(F.lit(0), F.col("lo_parts") - 1)).alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"))
    # a tile with itself: parts i < j once, and a part with itself on one side alone
    met = as_lo.filter("lo <> hi or i <= j").union(as_hi.filter("lo <> hi or i < j"))
    met = met.repartition("lo", "hi", "i", "j").sortWithinPartitions("lo", "hi", "i", "j", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, slice(1, 5)):
            a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for own in run:
                one = own[5, 0] == own[5, -1]
                if one and (own[1, 0] != own[2, 0] or own[3, 0] != own[4, 0]):
                    continue  # nothing on the other side
                fp, n = own[0].view(np.uint64), int((own[5] == 0).sum())
                if len(fp) > 1:
                    x, y = forest(fp, None, radius) if one else forest(fp[:n], fp[n:], radius)
                    a.append(x.view(np.int64))
                    b.append(y.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return met.mapInArrow(compare, "a long, b long")


def offsets(segments: int, radius: int) -> list[int]:
    """All differences of packed counts whose absolute values sum to radius or less."""
    found = {0}
    for _ in range(radius):
        found |= {d + s * (1 << (7 * k)) for d in found for k in range(segments) for s in (1, -1)}
    return sorted(found)


def labelled(prints: DataFrame, radius: int) -> DataFrame:
    """prints with `component`, the smallest fingerprint reachable over links, beside fp."""
    distinct = cut(prints.select("fp").distinct(), "distinct")
    edges = cut(tile_edges(distinct, radius), "edges")
    classes = components(distinct.select(F.col("fp").alias("node")), edges, "links")
    return prints.join(classes.withColumnRenamed("node", "fp"), "fp")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id)."""
    prints = cut(fingerprints(docs, text, key), "prints")
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    edges = cut(tile_edges(distinct.select("fp"), radius), "edges")
    nodes = distinct.select(F.col("fp").alias("node"), "first")
    classes = components(nodes.select("node"), edges, "links").join(nodes, "node")
    names = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = classes.join(names, "component").select(F.col("node").alias("fp"), "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, classes: DataFrame, key: str) -> DataFrame:
    """The row of docs, all its columns, that comes first of each component of classes (doc_id, mark, component).

    Rows go by id, null last, then by mark, the hash of all their columns; of equal rows one stays.
    """
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    groups = classes.groupBy("component").agg(F.min(place).alias("first"))
    tag, mark = unused(docs, "__id"), unused(docs, "__mark")
    first = groups.select("first.doc_id", "first.mark")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m"))
    again = classes.join(first.select(F.col("doc_id").alias("d"), F.col("mark").alias("m")), same).groupBy("doc_id", "mark").count().filter("count > 1")
    first = cut(first.select(F.col("doc_id").alias(tag), F.col("mark").alias(mark)), "kept")
    own = marked(docs)
    kept = docs.join(first, F.col(key).cast("long").eqNullSafe(F.col(tag)) & (own == F.col(mark)), "left_semi")
    return kept if again.isEmpty() else kept.dropDuplicates()


def marked(docs: DataFrame) -> Column:
    """A hash of all columns of a row."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """The rows of docs, all their columns, that are the one kept of the texts linked by fingerprints."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), marked(docs).alias("mark"), F.col(text).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t) for t in batch.column(2).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp)], names=["doc_id", "mark", "fp"])

    return one_of_each(docs, labelled(cut(rows.mapInArrow(each, "doc_id long, mark long, fp long"), "prints"), radius), key)


# groups by similarity


def shingle_sets(texts: list[str | None], known: dict[bytes, int], size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles; a text without words has the one of no words."""
    if len(known) > REMEMBERED:
        known.clear()
    out = []
    for t in texts:
        parts = (t or "").encode("utf-8", "surrogatepass").lower().split()
        for w in set(parts).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
        n = min(size, len(h))
        s = np.zeros(len(h) - n + 1, np.uint64)
        for k in range(n):
            s = (s + h[k : k + len(s)]) * MIX
        out.append(np.unique(s ^ (s >> np.uint64(29))))
    return out


def signatures(docs: DataFrame, text: str, key: str, shingle: int, prints: bool) -> DataFrame:
    """(doc_id, mark, h1, h2, keys, fp): a text's two hashes, its band keys and, if asked for, its fingerprint."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            texts = batch.column(4)
            for a in range(0, batch.num_rows, 64):
                sets = shingle_sets(texts[a : a + 64].to_pylist(), known, shingle)
                size = np.fromiter(map(len, sets), np.int64, len(sets))
                flat = np.concatenate(sets)
                keys = band_keys(((flat * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)).astype(np.uint32), np.cumsum(size) - size).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
                fp = np.array([fingerprint(t) if prints else 0 for t in texts[a : a + 64].to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(c.slice(a, 64) for c in batch.columns[:4]), lists, pa.array(fp)], names=["doc_id", "mark", "h1", "h2", "keys", "fp"])

    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), marked(docs).alias("mark"), F.xxhash64(t).alias("h1"), F.xxhash64(F.lit(1), t).alias("h2"), t.alias("text"))
    return rows.mapInArrow(each, "doc_id long, mark long, h1 long, h2 long, keys array<long>, fp long")


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of mixed hashes: the bits that over half of them have."""
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), CHUNK):
        part = hashes[a : a + CHUNK]
        part = (part ^ (part >> np.uint64(32))) * MIX
        ones += np.unpackbits((part ^ (part >> np.uint64(29))).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, tenths: int) -> DataFrame:
    """(a, b, ok) of (a, b): are the texts of the two ids similar? texts has (id, text)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        last: tuple[str, np.ndarray] = ("", shingle_sets([""], known, shingle)[0])
        for batch in batches:
            ok = []
            for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if t != last[0]:
                    last = (t, shingle_sets([t], known, shingle)[0])
                x, y = shingle_sets([s], known, shingle)[0], last[1]
                both = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(10 * both >= tenths * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], names=["a", "b", "ok"])

    of = lambda c, t: texts.select(F.col("id").alias(c), F.col("text").alias(t))
    return pairs.join(of("a", "s"), "a").join(of("b", "t"), "b").select("a", "b", "s", "t").mapInArrow(each, "a long, b long, ok boolean")


def similar_sets(left: list[np.ndarray], right: list[np.ndarray], tenths: int) -> np.ndarray:
    """(left, right) similarity verdicts of sets of hashes, by products of 0/1 matrices over some columns at a time."""
    sets = left + right
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    order = np.argsort(number, kind="stable")
    rows, number = np.repeat(np.arange(len(sets)), list(map(len, sets)))[order], number[order]
    both = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(number[-1]) + 1, COLUMNS):
        x, y = np.searchsorted(number, [at, at + COLUMNS])
        m = np.zeros((len(sets), min(COLUMNS, int(number[-1]) + 1 - at)), np.float32)
        m[rows[x:y], number[x:y] - at] = 1
        both += m[: len(left)] @ m[len(left) :].T
    a, b = np.array(list(map(len, left)))[:, None], np.array(list(map(len, right)))[None, :]
    return 10 * both >= tenths * (a + b - both)


def text_links(left: list[Row], right: list[Row], shingle: int = SIMILAR_SHINGLE, tenths: int = SIMILARITY, radius: int = WIDE) -> list[tuple[int, int]]:
    """Links between (component, id, text) of two tiles that connect the components that all similar pairs would.

    Fingerprints of different components are compared first, by exclusive-or and bit counts; only texts
    with a neighbour within the radius are compared by their shingles.
    """
    known: dict[bytes, int] = {}
    sets = [shingle_sets([x[2] for x in rows], known, shingle) for rows in (left, right)]
    fp = [np.array([majority(s) for s in part], np.uint64) for part in sets]
    near = np.bitwise_count(fp[0][:, None] ^ fp[1][None, :]) <= radius
    near &= np.array([x[0] for x in left])[:, None] != np.array([x[0] for x in right])[None, :]
    i, j = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    if not len(i):
        return []
    some, other = [sets[0][k] for k in i], [sets[1][k] for k in j]
    if sum(map(len, some)) + sum(map(len, other)) <= LARGE:
        ok = similar_sets(some, other, tenths) & near[np.ix_(i, j)]
    else:
        ok = near[np.ix_(i, j)]
        for x, y in zip(*np.nonzero(ok), strict=True):
            ok[x, y] = similar_sets([some[x]], [other[y]], tenths)[0, 0]
    x, y = np.nonzero(ok)
    return spanning(i[x].tolist(), j[y].tolist(), left, right)


def similar_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SIMILAR_SHINGLE, tenths: int = SIMILARITY, radius: int | None = None) -> DataFrame:
    """(doc_id, mark, component) for every row of docs: texts of similarity tenths / 10 or more along a chain.

    Fingerprints this far apart leave no tile to skip, so tiles lie within buckets of MinHash bands.
    First each text of a bucket meets the bucket's smallest; what components these links make is known
    before the others are compared, and then only texts outside the smallest one's component meet the
    others of the bucket. Every such link is the exact similarity of the two texts' shingle sets.

    With a radius, near_duplicates' links come first: the fingerprints of all texts, in or out of buckets, go
    through the tiles, and what they link is known before texts are compared.
    """
    rows = cut(signatures(docs, text, key, shingle, radius is not None), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark"))
    distinct = rows.groupBy("h1", "h2").agg(first.alias("first"), F.any_value("keys").alias("keys"), F.any_value("fp").alias("fp"))
    distinct = cut(distinct.withColumn("id", F.monotonically_increasing_id()), "distinct-texts")
    member = distinct.select("id", F.explode("keys").alias("bucket"))
    buckets = cut(member.groupBy("bucket").agg(F.min("id").alias("low"), F.count("*").alias("n")).filter("n > 1"), "buckets")
    member = cut(member.join(buckets, "bucket"), "members")
    involved = distinct.join(member.select("id").distinct(), "id", "left_semi").select("id", F.col("first.doc_id").alias("d"), F.col("first.mark").alias("m"))
    own = docs.select(F.col(key).cast("long").alias("doc_id"), marked(docs).alias("mark"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = own.join(involved, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m"))).select("id", "text")
    texts = cut(texts.dropDuplicates(["id"]), "texts")
    pairs = member.filter("id <> low").select(F.col("id").alias("a"), F.col("low").alias("b")).distinct()
    edges = cut(verified(pairs, texts, shingle, tenths).filter("ok").select("a", "b"), "star")
    nodes = member.select(F.col("id").alias("node"))
    if radius is not None:
        near = labelled(distinct.select("id", "fp"), radius).select("id", F.col("component").alias("group"))
        near = cut(near.join(near.groupBy("group").agg(F.min("id").alias("low"), F.count("*").alias("n")).filter("n > 1"), "group"), "near")
        edges = cut(edges.union(near.filter("id <> low").select("id", "low")), "edges")
        nodes = nodes.union(near.select("id"))
    nodes = cut(nodes.distinct(), "nodes")
    known = cut(components(nodes, edges, "links"), "components")
    placed = cut(member.join(known.withColumnRenamed("node", "id"), "id"), "placed")
    links = lambda left, right: text_links(left, right, shingle, tenths)
    more = cut(tiled(tile_rows(placed, known).join(texts, "id"), links).distinct(), "more")
    if not more.isEmpty():
        known = cut(components(nodes, edges.union(more), "links"), "components")
    named = distinct.select("h1", "h2", "id").join(known.withColumnRenamed("node", "id"), "id", "left").select("h1", "h2", F.coalesce("component", "id").alias("component"))
    return rows.join(named, ["h1", "h2"]).select("doc_id", "mark", "component")


def keep_near(docs: DataFrame, text: str = "text", key: str = "doc_id", radius: int = RADIUS) -> DataFrame:
    """The rows of docs, all their columns, that are the one kept of the texts linked by fingerprints or by similarity."""
    return one_of_each(docs, similar_groups(docs, text, key, radius=radius), key)


def keep_similar(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of docs, all their columns, that are the one kept of each group of similar texts."""
    return one_of_each(docs, similar_groups(docs, text, key), key)
