"""Duplicates and storage over page histories."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tidemark.functions import exprs as X
from tidemark.operators.runs import least_values
from tidemark.operators.staging import every_nth


def semantic_duplicates(df: DataFrame, fields: Sequence[str], artifact: str, n: int = 20, members: int = 5) -> DataFrame:
    """The n largest groups of equal fields, with the first few members of each."""
    rows = df.select(artifact, X.fingerprint(fields, 256).alias("state_hash"))
    groups = rows.groupBy("state_hash").agg(F.count_distinct(artifact).alias("artifacts")).filter("artifacts > 1").orderBy(F.desc("artifacts"), "state_hash").limit(n)
    # a task passes on a few least artifacts of a group, so the largest groups are never in one
    first = least_values(rows.join(F.broadcast(groups), "state_hash", "left_semi"), "state_hash", artifact, members, "__first")
    out = first.join(F.broadcast(groups), "state_hash").select("state_hash", "artifacts", F.posexplode("__first").alias("__n", artifact))
    return out.select("state_hash", artifact, "artifacts", (F.col("__n") + 1).alias("member"))


def duplicate_profile(df: DataFrame, listing: str, artifact: str, ts: str, state: str) -> DataFrame:
    """One row: listings, artifacts, distinct states, repeats of the state before, and their rate."""
    rows = df.select(listing, artifact, ts, state).dropDuplicates([artifact])
    rows = rows.withColumn("__prev", F.lag(state).over(W.partitionBy(listing).orderBy(ts, artifact)))
    per = rows.groupBy(listing).agg(F.count("*").alias("n"), F.count_distinct(state).alias("states"), F.count_if(F.col(state) == F.col("__prev")).alias("stable"), F.count_if(F.col(state) != F.col("__prev")).alias("changed"))
    out = per.agg(F.count("*").alias("listings"), F.sum("n").alias("artifacts"), F.sum("states").alias("distinct_states"), F.sum("stable").alias("stable"), F.sum("changed").alias("changed"))
    return out.withColumn("duplicate_pct", X.percent("stable", "artifacts", 2))


def listing_activity(df: DataFrame, listing: str, artifact: str, ts: str, state: str, least: int = 2, most_per_day: float | None = None) -> DataFrame:
    """Listings with at least so many artifacts and at most so many a day."""
    out = df.groupBy(listing).agg(F.count_distinct(artifact).alias("artifacts"), F.count_distinct(state).alias("states"), F.min(ts).alias("first_at"), F.max(ts).alias("last_at"))
    out = out.withColumn("days", X.day_diff("first_at", "last_at") + 1).withColumn("per_day", F.col("artifacts") / F.col("days")).filter(F.col("artifacts") >= least)
    return out.filter(F.col("per_day") <= most_per_day) if most_per_day is not None else out


def exact_duplicates(df: DataFrame, body: str) -> DataFrame:
    """One row: bodies, bytes, and how many of each are copies.

    Bodies meet by size first, then by SHA-256, both as partial aggregates: a body is hashed where it is
    read, and only hashes are shuffled.
    """
    rows = df.filter(F.col(body).isNotNull()).select(F.octet_length(body).cast("long").alias("size"), F.sha2(body, 256).alias("h"))
    g = rows.groupBy("size", "h").agg(F.count("*").alias("n"))
    out = g.agg(F.sum("n").alias("bodies"), F.count("*").alias("distinct_bodies"), F.sum(F.col("n") - 1).alias("copies"), F.sum(F.col("n") * F.col("size")).alias("bytes"), F.sum((F.col("n") - 1) * F.col("size")).alias("copied_bytes"))
    return out.withColumn("copied_pct", X.percent("copied_bytes", "bytes", 2))


def storage_scenarios(profile: DataFrame, body_bytes: float, diff_bytes: float) -> DataFrame:
    """Bytes of keeping all bodies, one body a listing and diffs, or one body a state."""
    full = F.col("artifacts") * body_bytes
    diff = F.col("listings") * body_bytes + (F.col("artifacts") - F.col("listings")) * diff_bytes
    state = F.col("distinct_states") * body_bytes
    out = profile.select(full.alias("full_bytes"), diff.alias("diff_bytes"), state.alias("per_state_bytes"))
    return out.withColumn("diff_saving_pct", X.percent(F.col("full_bytes") - F.col("diff_bytes"), "full_bytes", 2)).withColumn("per_state_saving_pct", X.percent(F.col("full_bytes") - F.col("per_state_bytes"), "full_bytes", 2))


def common_lines(a: list, b: list) -> int:
    """Length of the longest common subsequence, by bit vectors: a word of machine bits of b for each step."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    a, b = a[lo : len(a) - hi], b[lo : len(b) - hi]
    there = set(a)
    b = [x for x in b if x in there]  # lines of one side only are in no subsequence
    places: dict = {}
    for k, x in enumerate(b):
        places.setdefault(x, []).append(k)
    masks = {x: sum(1 << k for k in p) for x, p in places.items() if len(p) > 1}
    full = (1 << len(b)) - 1
    row = full  # a 0 where the common length grows
    for x in a:
        if x in places:
            hit = row & (masks[x] if x in masks else 1 << places[x][0])
            row = ((row + hit) | (row - hit)) & full
    return lo + hi + len(b) - row.bit_count()


@pandas_udf(T.ArrayType(T.IntegerType()))
def changed_lines(before: pd.Series, after: pd.Series) -> pd.Series:
    """[added, removed] lines of a shortest edit between two versions; null if one of them is."""

    def one(a: str | None, b: str | None) -> list[int] | None:
        if a is None or b is None:
            return None
        x, y = a.split("\n"), b.split("\n")
        same = common_lines(x, y)
        return [len(y) - same, len(x) - same]

    return pd.Series([one(a, b) for a, b in zip(before, after, strict=True)])


def version_diffs(df: DataFrame, key: str, ts: str, body: str) -> DataFrame:
    """Every version after a key's first: lines added and removed since the one before, and if any.

    Versions are put in order by their hashes; a body is joined to its pair once, and only where the hashes differ.
    Versions of one key and time are ordered by hash. A version without body, or after one, has null counts.
    """
    slim = df.select(key, ts, F.sha2(body, 256).alias("__h"), F.lit(True).alias("__is"))
    order = W.partitionBy(key).orderBy(ts, "__h")
    rows = slim.withColumns({"__g": F.lag("__h").over(order), "__after": F.lag("__is").over(order)}).filter("__after and __g is not null")
    bodies = df.select(F.sha2(body, 256).alias("__x"), F.col(body).alias("__body")).filter("__x is not null").dropDuplicates(["__x"])
    pairs = rows.filter("__g <> __h").select("__g", "__h").distinct()
    pairs = pairs.join(bodies.withColumnsRenamed({"__x": "__g", "__body": "__before"}), "__g").join(bodies.withColumnsRenamed({"__x": "__h", "__body": "__now"}), "__h")
    diffs = pairs.select("__g", "__h", changed_lines("__before", "__now").alias("__d"))
    out = rows.join(diffs, ["__g", "__h"], "left")
    of = lambda k: F.when(F.col("__g") == F.col("__h"), 0).otherwise(F.col("__d")[k])
    return out.select(key, ts, of(0).alias("lines_added"), of(1).alias("lines_removed"), F.coalesce(of(0) + of(1) > 0, F.lit(False)).alias("changed"))


def diff_summary(diffs: DataFrame) -> DataFrame:
    return diffs.agg(F.count("*").alias("versions"), F.count_if("changed").alias("changed_versions"), F.avg("lines_added").alias("avg_added"), F.avg("lines_removed").alias("avg_removed"))


def recompression(df: DataFrame, body: str, key: str, now: int = 3, then: int = 9, stride: int = 1) -> DataFrame:
    """One row: bytes of a systematic sample at two zlib levels, the saving in percent, and a verdict."""

    @pandas_udf("array<long>")
    def sizes(bodies: pd.Series) -> pd.Series:
        raw = bodies.str.encode("utf-8")
        return pd.Series([[len(b), len(zlib.compress(b, now)), len(zlib.compress(b, then))] for b in raw])

    rows = df.filter(F.col(body).isNotNull())
    if stride > 1:
        rows = rows.join(every_nth(rows.select(key), [key], stride).select(key), key, "left_semi")
    rows = rows.select(sizes(body).alias("s"))
    out = rows.agg(F.count("*").alias("sampled"), F.sum(F.col("s")[0]).alias("raw_bytes"), F.sum(F.col("s")[1]).alias("now_bytes"), F.sum(F.col("s")[2]).alias("then_bytes"))
    out = out.withColumn("saving_pct", X.percent(F.col("now_bytes") - F.col("then_bytes"), "now_bytes", 2))
    return out.withColumn("verdict", F.when(F.col("saving_pct") >= 15, "worthwhile").when(F.col("saving_pct") >= 5, "marginal").otherwise("not worthwhile"))
