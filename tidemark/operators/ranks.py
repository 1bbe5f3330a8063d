"""Exact quantiles of groups of any size: no task holds a group's values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.sources.scratch import written


def grouped_quantiles(df: DataFrame, group: Sequence[str], value: str | Column, points: Sequence[float], name: str = "q") -> DataFrame:
    """group, n, and an array of interpolated quantiles of each group's values that aren't null.

    Values are counted by group and value, and sorted by both in ranges, so a group lies in as many ranges as its
    values need. Each range is summed by group (a row a range and group), which gives the number of values before
    a range; with the running counts inside it, the two neighbours of a quantile are found by their numbers.
    Null groups are groups; a group without values has no row.
    """
    v = F.col(value) if isinstance(value, str) else value
    counts = df.select(*group, v.cast("double").alias("__v")).filter("__v is not null").groupBy(*group, "__v").agg(F.count("*").alias("__c"))
    sort = [*group, "__v"]
    at = written(counts.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("__part", F.spark_partition_id()), "ranges")
    parts = at.groupBy(*group, "__part").agg(F.sum("__c").alias("__in"))
    whole = W.partitionBy(*group)
    parts = parts.select(*[F.col(g).alias(f"__g{k}") for k, g in enumerate(group)], F.col("__part").alias("__p"), (F.sum("__in").over(whole.orderBy("__part")) - F.col("__in")).alias("__before"), F.sum("__in").over(whole).alias("n"))
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__g{k}")) for k, g in enumerate(group)], F.col("__part") == F.col("__p"))
    running = F.sum("__c").over(W.partitionBy(*group, "__part").orderBy("__v"))
    rows = at.withColumn("__upto", running).join(parts, on)
    after = F.col("__before") + F.col("__upto")  # values up to and with this one
    place = [F.lit(float(p)) * (F.col("n") - 1) for p in points]
    holds = lambda k: (after - F.col("__c") <= k) & (k < after)
    ends = [(F.floor(h), F.ceil(h)) for h in place]
    near = rows.filter(reduce(lambda a, b: a | b, [holds(x) | holds(y) for x, y in ends]))
    found = near.groupBy(*group, "n").agg(*[F.max(F.when(holds(k), F.col("__v"))).alias(f"__{side}{i}") for i, pair in enumerate(ends) for side, k in zip(("lo", "hi"), pair, strict=True)])
    q = [F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * (h - F.floor(h)) for i, h in enumerate(place)]
    return found.select(*group, "n", F.array(*q).alias(name))


def with_quantiles(df: DataFrame, group: Sequence[str], value: str | Column, points: Sequence[float], aggregates: Sequence[Column], spread: bool = False, name: str = "q") -> DataFrame:
    """Plain aggregates of every group together with its exact quantiles.

    A group's distinct values, with their counts, meet in one task; with `spread` they do not (grouped_quantiles), at
    the price of writing df, as both parts read it, and two more sorts. Both give the same result.
    """
    v = F.col(value) if isinstance(value, str) else value
    if not spread:
        return df.groupBy(*group).agg(*aggregates, F.percentile(v.cast("double"), [float(p) for p in points]).alias(name))
    df = written(df, "grouped")
    q = grouped_quantiles(df, group, value, points, name)
    q = q.select(*[F.col(g).alias(f"__g{k}") for k, g in enumerate(group)], name)
    on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__g{k}")) for k, g in enumerate(group)])
    return df.groupBy(*group).agg(*aggregates).join(q, on, "left").drop(*[f"__g{k}" for k in range(len(group))])
