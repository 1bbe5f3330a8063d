"""Hard negatives: for anchors and their best rows of the same label, the best rows of other labels in a window of scores.

Anchors are clustered by direction. With the cosine of an item to a cluster's centre, and the cluster's
radius (the largest angle of a member), no member's score with the item exceeds the member's norm times

    bound = norm of item x cos(max(0, angle of item to centre - radius)).

Each cluster has one list of all items, sorted by that bound into bands once; every member of the cluster
walks it band by band. A member stops when nothing after its band can enter its result: its worst
wanted score lies above the next band's bound, or no score in its window is left. The result is exact,
whatever the centres. Bands are cut at the shares BANDS of a list, from a histogram of bounds.

A band is walked in Spark tasks of at most SPAN items and GROUP members: items go to the tasks of their
band and part, members to all parts; a task multiplies block by block and gives back at most the wanted
number of rows a member, only those that can still enter. The centres come from at most SAMPLE anchors.

Scores are inner products of components floor(scale x x), exact in 64 bits. Defined results: rows with a
null label, a null vector, or a null or non-finite component take no part; shorter vectors count as
followed by zeros; a row with a null id is no anchor, comes last among ties, and is returned with a null
id; repeated rows take part each, and a repeated anchor has each of its rows; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, discard

CLUSTERS = 16
#: Anchors that the centres are fitted on.
SAMPLE = 4096
#: Shares of a list, cumulated, at which its bands end.
BANDS = (1 / 64, 1 / 16, 1 / 4, 1.0)
BINS = 2048
SPAN = 8192
GROUP = 8192
#: Items and members multiplied at once.
BLOCK = 512
LAST = np.iinfo(np.int64).max
LOWEST, HIGHEST = -(1 << 62), 1 << 62


def prepared(rows: DataFrame, key: str, vector: str, label: str | Column, is_anchor: Column, scale: float) -> tuple[DataFrame, np.dtype, int]:
    """(uid, id, label, anchor, q: bytes of whole components), their type, the dimension."""
    good = rows.select(F.col(key).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = good.filter(F.col("label").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))
    good = good.withColumn("v", F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x).cast("long")))
    most = good.agg(F.max(F.size("v")), F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, x: F.greatest(a, F.abs(x))))).first()
    dim, largest = max(1, most[0] or 1), most[1] or 0
    kind = np.dtype("<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<i8")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = [np.pad(np.array(v.as_py(), kind), (0, dim - len(v))).tobytes() for v in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(q, pa.binary())], names=["id", "label", "anchor", "q"])

    packed = good.mapInArrow(pack, "id long, label long, anchor boolean, q binary")
    return cut(packed.withColumn("uid", F.monotonically_increasing_id()), "items"), kind, dim


def matrix(column: pa.Array, kind: np.dtype, dim: int) -> np.ndarray:
    """Rows of a binary column of equal lengths."""
    if not len(column):
        return np.zeros((0, dim), kind)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset :]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[len(column)]].view(kind).reshape(len(column), dim)


def centres(sample: np.ndarray, k: int) -> np.ndarray:
    """Unit vectors: k-means by direction, from rows far apart."""
    size = np.linalg.norm(sample, axis=1)
    x = sample[size > 0] / size[size > 0, None]
    if not len(x):
        return np.eye(1, sample.shape[1])
    out = x[:1]
    while len(out) < min(k, len(x)):
        out = np.vstack([out, x[(x @ out.T).max(1).argmin()]])
    for _ in range(10):
        own = (x @ out.T).argmax(1)
        sums = np.array([x[own == c].sum(0) for c in range(len(out))])
        size = np.linalg.norm(sums, axis=1)
        out = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], out)
    return out


def angles(q: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norms, angles to each centre); a zero row has angle 0."""
    x = q.astype(np.float64)
    size = np.linalg.norm(x, axis=1)
    cos = np.where(size[:, None] > 0, x @ centre.T / np.maximum(size, 1e-300)[:, None], 1.0)
    return size, np.arccos(np.clip(cos, -1, 1))


def bounds(q: np.ndarray, centre: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Upper bounds of an item's score with any member of each cluster, divided by the member's norm."""
    size, angle = angles(q, centre)
    return size[:, None] * np.cos(np.maximum(0.0, angle - radius - 1e-9)) + 1e-6


class Lists:
    """The clusters: members, every item's band in each cluster's list, and the bands' bounds."""

    def __init__(self, items: DataFrame, kind: np.dtype, dim: int, clusters: int):
        anchors = items.filter("anchor")
        drawn = anchors.select("q").orderBy(F.xxhash64("q", "uid")).limit(SAMPLE).toArrow().column(0).combine_chunks()
        self.centre = centre = centres(matrix(drawn, kind, dim).astype(np.float64), clusters)
        self.k = k = len(centre)

        def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                size, angle = angles(matrix(batch.column(3), kind, dim), centre)
                c = angle.argmin(1) if len(angle) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(c.astype(np.int32)), pa.array(size), pa.array(np.take_along_axis(angle, c[:, None], 1)[:, 0])], names=["uid", "id", "label", "q", "cluster", "norm", "angle"])

        self.members = cut(anchors.select("uid", "id", "label", "q").mapInArrow(own, "uid long, id long, label long, q binary, cluster int, norm double, angle double"), "anchors")
        widest = {r[0]: r[1] for r in self.members.groupBy("cluster").agg(F.max("angle")).collect()}
        radius = np.array([widest.get(c, 0.0) for c in range(k)])
        longest = float(items.select("q").mapInArrow(norms(kind, dim), "n double").agg(F.max("n")).first()[0] or 1.0) + 1e-5

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((k, BINS), np.int64)
            for batch in batches:
                b = bounds(matrix(batch.column(0), kind, dim), centre, radius)
                bin_ = np.clip(((longest - b) * (BINS / (2 * longest))).astype(np.int64), 0, BINS - 1)
                for c in range(k):
                    total[c] += np.bincount(bin_[:, c], minlength=BINS)
            c, b = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[c, b])], names=["c", "b", "n"])

        hist = np.zeros((k, BINS), np.int64)
        for c, b, n in items.select("q").mapInArrow(count, "c int, b int, n long").groupBy("c", "b").agg(F.sum("n")).collect():  # clusters x BINS rows at most
            hist[c, b] = n
        reached = np.cumsum(hist, axis=1)
        whole = max(1, int(hist[0].sum()))
        #: bound at the end of each band: what comes later lies at or below it
        self.edge = edge = np.array([[longest - 2 * longest / BINS * (1 + np.searchsorted(r, share * whole)) for share in BANDS[:-1]] + [-np.inf] for r in reached])

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                b = bounds(matrix(batch.column(3), kind, dim), centre, radius)
                band = (b[:, :, None] <= edge[None, :, :-1]).sum(2).astype(np.int8)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.FixedSizeListArray.from_arrays(pa.array(band.ravel()), k).cast(pa.list_(pa.int8()))], names=["uid", "id", "label", "q", "band"])

        self.items = cut(items.select("uid", "id", "label", "q").mapInArrow(place, "uid long, id long, label long, q binary, band array<tinyint>"), "lists")
        sizes = self.items.select(F.posexplode("band").alias("c", "r")).groupBy("c", "r").count().collect()  # clusters x bands
        self.size = {(r["c"], r["r"]): r["count"] for r in sizes}


def norms(kind: np.dtype, dim: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.linalg.norm(matrix(batch.column(0), kind, dim).astype(np.float64), axis=1))], names=["n"])

    return each


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of a and b."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def wanted(scores: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(item, member) places of scores that may be among a member's first k; scores of LOWEST never are."""
    least = floor
    if len(scores) > k:
        least = np.maximum(floor, np.partition(scores, len(scores) - k, axis=0)[len(scores) - k])
    return np.nonzero((scores >= least) & (scores > LOWEST))


class Pool:
    """The first k rows (score, id) of each member so far, and the least score that may still enter."""

    def __init__(self, n: int, k: int):
        self.k, self.floor, self.held = k, np.full(n, LOWEST, np.int64), np.zeros((3, 0), np.int64)

    def add(self, member: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        held = np.concatenate([self.held, np.stack([member, score, ids])], axis=1)
        held = held[:, np.lexsort((held[2], -held[1], held[0]))]
        first = np.concatenate(([0], np.flatnonzero(np.diff(held[0])) + 1)) if held.shape[1] else np.zeros(0, np.int64)
        rank = np.arange(held.shape[1]) - np.repeat(first, np.diff(np.append(first, held.shape[1])))
        self.held = held[:, rank < self.k]
        full = held[:, rank == self.k - 1]
        self.floor[full[0]] = np.maximum(self.floor[full[0]], full[1])


def walk(lists: Lists, kind: np.dtype, dim: int, asked: DataFrame, k: int, same: bool) -> DataFrame:
    """(query, best: the first k of (score, id)) of asked: query, uid, label, q, cluster, norm, low, high.

    Candidates have the query's label (same; the query's own row is none) or another one, and a score from low to high.
    """
    part, rows = F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"), "query long, score long, id long"
    columns = ["query", "uid", "label", "q", "cluster", "norm", "low", "high", "kth", "best"]
    now = cut(asked.selectExpr("query", "uid", "label", "q", "cluster", "norm", "low", "high", "low as kth", "cast(array() as array<struct<score: bigint, id: bigint>>) as best"), "walk")
    for r in range(len(BANDS)):
        before = [float(lists.edge[c, r - 1]) if r else float("inf") for c in range(lists.k)]
        limit = F.element_at(F.array(*[F.lit(x) for x in before]), F.col("cluster") + 1) * F.col("norm")
        limit = limit + F.abs(limit) * 1e-9 + 1e-3  # rounding
        # kth: the least score that may still enter, so nothing enters once it lies above the limit
        going = now.filter(F.col("kth").cast("double") <= limit) if r else now
        active = {x[0]: x[1] for x in going.groupBy("cluster").count().collect() if lists.size.get((x[0], r))}  # clusters
        if not active:
            continue
        parts = F.element_at(F.array(*[F.lit(max(1, -(-lists.size.get((c, r), 0) // SPAN))) for c in range(lists.k)]), F.col("cluster") + 1)
        groups = F.element_at(F.array(*[F.lit(max(1, -(-active.get(c, 0) // GROUP))) for c in range(lists.k)]), F.col("cluster") + 1)
        spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        members = going.filter(F.col("cluster").isin(*active)).withColumn("groups", groups).select("cluster", F.pmod(F.xxhash64("query"), F.col("groups")).cast("int").alias("grp"), spread(parts).alias("part"), F.lit(0).alias("side"), F.col("query").alias("id"), "uid", "label", "q", "low", "high", "kth")
        place = F.explode(F.filter(F.array(*[F.lit(c) for c in sorted(active)]), lambda c: F.get("band", c) == r))
        items = lists.items.select("uid", "id", "label", "q", place.alias("cluster")).withColumns({"parts": parts, "groups": groups}).select("cluster", spread(F.col("groups")).alias("grp"), part.alias("part"), F.lit(1).alias("side"), "id", "uid", "label", "q", *[F.lit(None).cast("long").alias(c) for c in ("low", "high", "kth")])
        dealt = members.union(items).repartition("cluster", "grp", "part").sortWithinPartitions("cluster", "grp", "part", "side")
        new = dealt.mapInArrow(tile(kind, dim, k, same), rows)
        held = now.select("query", F.explode("best").alias("x")).select("query", "x.score", "x.id")
        order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
        best = new.union(held).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k).groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "id"))).alias("b"))
        found = F.coalesce(F.transform("b", lambda x: F.struct((-x["s"]).alias("score"), x["id"].alias("id"))), F.col("best"))
        then = now.join(best, "query", "left").withColumn("best", found).withColumn("kth", F.when(F.size("best") >= k, F.element_at("best", -1)["score"]).otherwise(F.col("low")))
        then = cut(then.select(columns), "walk")
        discard(now)
        now = then
    return now


def tile(kind: np.dtype, dim: int, k: int, same: bool):
    """Of each task's members (side 0, first) and items: the rows that may be among a member's first k."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, tables, pool = None, [], None, None
        for batch in batches:
            spot = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(4)])
            border = np.flatnonzero(np.concatenate(([True], (spot[:, 1:] != spot[:, :-1]).any(0), [True])))
            for a, b in zip(border[:-1].tolist(), border[1:].tolist(), strict=True):
                piece, where = batch.slice(a, b - a), tuple(spot[:3, a])
                if where != now:
                    if pool is not None:
                        yield found(pool, tables)
                    now, held, pool = where, [], None
                if spot[3, a] == 0:
                    held.append(piece)
                elif held:
                    if pool is None:
                        tables = read(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                        pool = Pool(len(tables["id"]), k)
                        pool.floor = tables["kth"].copy()
                    match(tables, read(piece), pool)
        if pool is not None:
            yield found(pool, tables)

    def read(rows: pa.RecordBatch) -> dict[str, np.ndarray]:
        number = lambda name: rows.column(rows.schema.names.index(name)).fill_null(LAST).to_numpy(zero_copy_only=False)
        return {c: number(c) for c in ("id", "uid", "label", "low", "high", "kth")} | {"q": matrix(rows.column(rows.schema.names.index("q")), kind, dim)}

    def match(own: dict[str, np.ndarray], other: dict[str, np.ndarray], pool: Pool) -> None:
        for i in range(0, len(other["id"]), BLOCK):
            x = {c: v[i : i + BLOCK] for c, v in other.items()}
            for j in range(0, len(own["id"]), BLOCK):
                m = {c: v[j : j + BLOCK] for c, v in own.items()}
                scores = product(x["q"], m["q"])
                out = (scores < m["low"]) | (scores > m["high"])
                equal = x["label"][:, None] == m["label"]
                out |= (~equal | (x["uid"][:, None] == m["uid"])) if same else equal
                scores[out] = LOWEST
                a, b = wanted(scores, pool.floor[j : j + BLOCK], pool.k)
                if len(a):
                    pool.add(b + j, scores[a, b], x["id"][a])

    def found(pool: Pool, tables: dict[str, np.ndarray]) -> pa.RecordBatch:
        member, score, ids = pool.held
        return pa.RecordBatch.from_arrays([pa.array(tables["id"][member]), pa.array(score), pa.array(ids)], names=["query", "score", "id"])

    return each


def mine(rows: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label", positives: int = 5, per_pair: int = 3, low: int = 50, high: int = 95, scale: float = 256, clusters: int = CLUSTERS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Of each anchor's first `positives` rows of its label and each of them, the first `per_pair` rows of other
    labels with low x positive_score <= 100 x negative_score <= high x positive_score.
    """
    items, kind, dim = prepared(rows, key, vector, label, is_anchor, scale)
    lists = Lists(items, kind, dim, clusters)
    asked = lists.members.selectExpr("uid as query", "uid", "label", "q", "cluster", "norm", f"{LOWEST + 1}L as low", f"{HIGHEST}L as high")
    first = walk(lists, kind, dim, asked, positives, True)
    pairs = first.select("uid", "label", "q", "cluster", "norm", F.posexplode("best").alias("n", "p")).filter("p.score >= 0")
    # with a score below 0 the window is empty
    ends = pairs.selectExpr(f"uid * {positives} + n as query", "uid", "label", "q", "cluster", "norm", f"{low} * (p.score div 100) + ({low} * (p.score % 100) + 99) div 100 as low", f"{high} * (p.score div 100) + ({high} * (p.score % 100)) div 100 as high", "p")
    ends = cut(ends, "pairs")
    second = walk(lists, kind, dim, ends.drop("p"), per_pair, False)
    named = second.join(ends.select("query", "p"), "query").join(lists.members.selectExpr("uid", "id as anchor_id"), "uid")
    null_last = lambda c: F.when(c != int(LAST), c)
    out = named.select("anchor_id", null_last(F.col("p.id")).alias("positive_id"), F.posexplode("best").alias("n", "x"), F.col("p.score").alias("positive_score"))
    return out.select("anchor_id", "positive_id", (F.col("n") + 1).cast("int").alias("rank"), null_last(F.col("x.id")).alias("negative_id"), "positive_score", F.col("x.score").alias("negative_score"))
