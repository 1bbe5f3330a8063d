"""Structured Streaming forms of the flushes, hourly marts, dedupe, folds and change events.

The append logs are file sources. Where a late row must change what was computed, foreachBatch runs the
same incremental functions that batch jobs use; watermarked aggregation serves where its bound is wanted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from tidemark.sources.readers import timestamps


def source(spark: SparkSession, path: str, schema: T.StructType, files: int = 1000) -> DataFrame:
    """New Parquet files of a folder, at most so many a batch."""
    return timestamps(spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path))


def append_stream(stream: DataFrame, path: str, checkpoint: str, partitions: Sequence[str]) -> DataStreamWriter:
    """Exactly-once append to partitioned Parquet."""
    return stream.writeStream.format("parquet").partitionBy(*partitions).option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)


def hourly_counts(stream: DataFrame, ts: str, group: str, valid: str | None = None, late: str = "72 hours") -> DataFrame:
    """Rows by hour and group; a row later than `late` is dropped. Distinct counts need upsert_stream."""
    aggs = [F.count("*").alias("observation_count")] + ([F.count(valid).alias("valid_count")] if valid else [])
    return stream.withWatermark(ts, late).groupBy(F.window(ts, "1 hour"), group).agg(*aggs).select(F.col("window.start").alias("hour"), group, *[a for a in (["observation_count", "valid_count"] if valid else ["observation_count"])])


def hourly_blocks(stream: DataFrame, ts: str, kind: str, new: str, again: str, late: str = "72 hours") -> DataFrame:
    rows = stream.filter(F.col(kind).isin(new, again)).withWatermark(ts, late)
    out = rows.groupBy(F.window(ts, "1 hour")).agg(F.count_if(F.col(kind) == new).alias("new_blocks"), F.count_if(F.col(kind) == again).alias("repeated_blocks"), F.count("*").alias("total_blocks"))
    return out.select(F.col("window.start").alias("hour"), "new_blocks", "repeated_blocks", "total_blocks")


def first_wins(stream: DataFrame, key: Sequence[str], ts: str, late: str = "3 days") -> DataFrame:
    """One row a key; the first to arrive stays. Where the last should win, use upsert_stream."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(key))


def upsert_stream(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    """Run an incremental function on every micro-batch; apply must be repeatable for a batch number."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True)


class LastValue(StatefulProcessor):
    """Emits a row when a key's value differs from its last one; rows older than the state are passed on
    as late, for the batch form to repair."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", T.StructType([T.StructField("value", T.StringType()), T.StructField("ts", T.TimestampType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        seen = pd.concat(list(rows)).sort_values("ts", kind="stable")
        before = self.last.get() if self.last.exists() else None
        out = []
        for ts, value in zip(seen["ts"], seen["value"], strict=True):
            if before is not None and ts < pd.Timestamp(before[1]):
                out.append((key[0], ts, before[0], value, "late"))
                continue
            if before is not None and before[0] != value:
                out.append((key[0], ts, before[0], value, "changed"))
            before = (value, ts.to_pydatetime())
        if before is not None:
            self.last.update(before)
        yield pd.DataFrame(out, columns=["key", "ts", "before", "after", "kind"])

    def close(self) -> None:
        pass


def change_events(stream: DataFrame, key: str, ts: str, value: str) -> DataFrame:
    """(key, ts, before, after, kind) whenever a key's value changes. Needs the RocksDB state store."""
    rows = stream.select(F.col(key).cast("string").alias("key"), F.col(ts).cast("timestamp").alias("ts"), F.col(value).cast("string").alias("value"))
    out = T.StructType([T.StructField("key", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("before", T.StringType()), T.StructField("after", T.StringType()), T.StructField("kind", T.StringType())])
    return rows.groupBy("key").transformWithStateInPandas(LastValue(), outputStructType=out, outputMode="append", timeMode="none")
