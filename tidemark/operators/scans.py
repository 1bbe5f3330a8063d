"""Scans along an entity's rows that split the entity: for entities with so many rows that a window's task could not hold them.

Rows are sorted by (entity, order) in ranges and written; an entity of many rows lies in many ranges. Inside a
range a window does its work; at the borders one row for each entity and range carries over.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.sources.scratch import written


def ranged(df: DataFrame, entity: str, order: Sequence[str]) -> DataFrame:
    """df with __part, the number of the range that a row lies in; later rows of an entity never lie in an earlier range."""
    return written(df.repartitionByRange(entity, *order).sortWithinPartitions(entity, *order).withColumn("__part", F.spark_partition_id()), "ranges")


def joined(rows: DataFrame, borders: DataFrame, entity: str) -> DataFrame:
    """Rows with what their entity's range was given, if anything."""
    b = borders.withColumnsRenamed({entity: "__e", "__part": "__p"})
    return rows.join(b, F.col(entity).eqNullSafe(F.col("__e")) & (F.col("__part") == F.col("__p")), "left").drop("__e", "__p")


def neighbours(at: DataFrame, entity: str, order: Sequence[str], values: Mapping[str, str], end: str, ahead: bool = False) -> DataFrame:
    """A ranged() frame with each name's value in the entity's row before (or after), and `end`: there is none.

    order must be total within an entity.
    """
    pick, shift = (F.min_by, F.lead) if ahead else (F.max_by, F.lag)
    there = F.struct(*[F.col(c).alias(name) for name, c in values.items()], F.lit(True).alias("__is"))
    edge = at.groupBy(entity, "__part").agg(pick(there, F.struct(*order)).alias("__edge"))
    edge = edge.withColumn("__near", shift("__edge").over(W.partitionBy(entity).orderBy("__part"))).filter("__near is not null").select(entity, "__part", "__near")
    w = W.partitionBy(entity, "__part").orderBy(*order)
    rows = joined(at.withColumn("__own", shift(there).over(w)), edge, entity)
    got = F.coalesce("__own", "__near")
    return rows.select("*", *[got[name].alias(name) for name in values], got.isNull().alias(end)).drop("__own", "__near")


def running(at: DataFrame, entity: str, order: Sequence[str], value: str | Column, name: str) -> DataFrame:
    """A ranged() frame with the sum of a value from the entity's first row to each."""
    v = F.col(value) if isinstance(value, str) else value
    sums = at.groupBy(entity, "__part").agg(F.sum(v).alias("__in"))
    sums = sums.select(entity, "__part", (F.sum("__in").over(W.partitionBy(entity).orderBy("__part")) - F.col("__in")).alias("__before"))
    w = W.partitionBy(entity, "__part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = joined(at.withColumn("__upto", F.sum(v).over(w)), sums, entity)
    return rows.withColumn(name, F.col("__upto") + F.col("__before")).drop("__upto", "__before")
