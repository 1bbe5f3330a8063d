"""Buckets of candidates compared in tiles: no task holds a bucket, and a tile gives a forest of its links."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

TILE = 128
#: One row of a tile: component, id, text.
Row = tuple[int, int, str]
Tile = tuple[list[Row], list[Row]]
#: Rows and characters of tiles given away at once.
ROWS, CHARS = 4096, 1 << 20


def forest(x: Iterable[int], y: Iterable[int], left: list[Row], right: list[Row]) -> list[tuple[int, int]]:
    """Of the links between left[x] and right[y], ones that connect the same components."""
    parent: dict[int, int] = {}

    def find(c: int) -> int:
        while parent.setdefault(c, c) != c:
            parent[c] = c = parent[parent[c]]
        return c

    out = []
    for i, j in zip(x, y, strict=True):
        a, b = find(left[i][0]), find(right[j][0])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((left[i][1], right[j][1]))
    return out


def tile_rows(placed: DataFrame, known: DataFrame) -> DataFrame:
    """(bucket, i, j, side, component, id) of members (bucket, low, n, id, component): the lines outside
    the component of their bucket's smallest line on side 0, all on side 1 but that line, which they met."""
    placed = placed.filter("n > 2")
    low = known.select(F.col("node").alias("low"), F.col("component").alias("main"))
    outside = placed.join(low, "low").filter("component <> main").select("bucket", "n", "component", "id")
    open_ = cut(outside.groupBy("bucket").agg(F.count("*").alias("u")), "open")
    part = lambda rows: F.pmod(F.xxhash64("id"), F.ceil(rows / TILE)).cast("int")
    tiles = lambda rows: F.explode(F.sequence(F.lit(0), (F.ceil(rows / TILE) - 1).cast("int")))
    one = outside.join(open_, "bucket").select("bucket", part(F.col("u")).alias("i"), tiles(F.col("n")).alias("j"), F.lit(0).alias("side"), "component", "id")
    other = placed.filter("id <> low").join(open_, "bucket").select("bucket", tiles(F.col("u")).alias("i"), part(F.col("n")).alias("j"), F.lit(1).alias("side"), "component", "id")
    return one.union(other)


def tiled(rest: DataFrame, links_of: Callable[[list[Row], list[Row]], list[tuple[int, int]]]) -> DataFrame:
    """(a, b) links of rows (bucket, i, j, side, component, id, text), each tile pair's rows in one task."""
    return tiles_together(rest, lambda tiles: [x for t in tiles for x in links_of(*t)], 1)


def tiles_together(rest: DataFrame, links_of: Callable[[list[Tile]], list[tuple[int, int]]], most: int = ROWS) -> DataFrame:
    """As tiled, but links_of gets whole tiles of about `most` rows together."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sides = None, ([], [])
        tiles: list[Tile] = []
        rows = chars = 0

        def links() -> pa.RecordBatch:
            out = links_of(tiles) if tiles else []
            tiles.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            for bucket, i, j, side, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (bucket, i, j) != now:
                    if all(sides):
                        tiles.append(sides)
                    if rows >= most or chars >= CHARS:
                        yield links()
                        rows = chars = 0
                    now, sides = (bucket, i, j), ([], [])
                sides[side].append(tuple(row))
                rows, chars = rows + 1, chars + len(row[2])
        if all(sides):
            tiles.append(sides)
        yield links()

    rest = rest.select("bucket", "i", "j", "side", "component", "id", "text").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return rest.mapInArrow(each, "a long, b long")
