"""A bounded flush as a stream: a source whose offset is the greatest key that a table has at the trigger.

A batch is the rows with keys after the last offset and up to the next one. Rows that are added while it is
flushed have greater keys and wait for the next; a batch that died is read again with the same ends, as
Spark logs offsets before it reads. Keys must grow with the order of arrival, as sequence numbers do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

NAME = "tidemark_keyed"


@dataclass
class Piece(InputPartition):
    """Rows of one file with keys in (after, to]."""

    file: str
    after: int | None
    to: int


def dataset(path: str):
    import pyarrow.dataset as ds
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")
    return ds.dataset(root, filesystem=store, format="parquet", partitioning=None)


class KeyedReader(DataSourceStreamReader):
    """Plans by the files' footers: only files whose keys reach into the range are read."""

    def __init__(self, path: str, key: str, columns: list[str]):
        self.path, self.key, self.columns = path, key, columns

    def ends(self) -> list[tuple[str, int, int]]:
        """(file, least key, greatest key) of every file that has keys."""
        out = []
        for f in dataset(self.path).get_fragments():
            groups = [g.statistics[self.key] for g in f.row_groups if self.key in (g.statistics or {})]
            if groups:
                out.append((f.path, min(g["min"] for g in groups), max(g["max"] for g in groups)))
        return out

    def initialOffset(self) -> dict:
        return {"key": None}

    def latestOffset(self) -> dict:
        return {"key": max((high for _, _, high in self.ends()), default=None)}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        after, to = start["key"], end["key"]
        if to is None:
            return []
        return [Piece(file, after, to) for file, low, high in self.ends() if low <= to and (after is None or high > after)]

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        inside = ds.field(self.key) <= piece.to
        if piece.after is not None:
            inside &= ds.field(self.key) > piece.after
        whole = dataset(self.path)
        one = ds.dataset(piece.file, filesystem=whole.filesystem, format="parquet", partitioning=None)
        yield from one.to_batches(columns=self.columns, filter=inside)


class KeyedTable(DataSource):
    """Options: path (of a Parquet table that pyarrow's file systems reach) and key (a whole-number column)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: StructType) -> KeyedReader:
        return KeyedReader(self.options["path"], self.options["key"], schema.fieldNames())


def source(spark: SparkSession, path: str, key: str, schema: StructType) -> DataFrame:
    """The rows of a growing table in order of its key, batch by batch."""
    spark.dataSource.register(KeyedTable)
    return spark.readStream.format(NAME).schema(schema).option("key", key).option("path", path).load()


def flush(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Flush what is there at the start, once; apply must be repeatable for a batch number."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True)
