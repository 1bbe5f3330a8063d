"""Event-sourced current state: folds of logs, and the jobs that keep a state table true."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import exprs as X


def fold(rows: DataFrame, key: str, order: Sequence[str], take: Sequence[str], keep: Sequence[str] = (), deleted: Column | None = None) -> DataFrame:
    """The current state of every key: `take` columns of its last row, even null; `keep` columns' last
    non-null value. Keys whose last row is `deleted` are gone, and what came before a deletion too."""
    if deleted is not None:
        gone = W.partitionBy(key).orderBy(*order)
        flagged = rows.withColumn("__del", F.coalesce(deleted, F.lit(False)))
        rows = flagged.withColumn("__life", F.sum(F.col("__del").cast("int")).over(gone.rowsBetween(W.unboundedPreceding, W.currentRow)))
        life = rows.groupBy(key).agg(F.max("__life").alias("__last"))
        rows = rows.join(life, key).filter((F.col("__life") == F.col("__last")) & ~F.col("__del")).drop("__del", "__life", "__last")
    out = rows.groupBy(key).agg(X.latest_row([*order, *take], *order).alias("r"), *[X.latest(c, *order).alias(c) for c in keep])
    return out.select(key, *[F.col(f"r.c_{c}").alias(c) for c in (*order, *take)], *keep)


def merge(state: DataFrame, batch: DataFrame, key: str, take: Sequence[str], keep: Sequence[str] = (), newer: str | None = None) -> DataFrame:
    """A state after a batch of one row a key: `take` from the batch, `keep` from it unless null.

    With `newer`, only a strictly newer row of the batch counts; at equal time the state stays.
    """
    b = batch.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__{c}") for c in (*take, *keep)])
    both = state.join(b, F.col(key) == F.col("__k"), "full_outer")
    wins = F.col("__k").isNotNull()
    if newer:
        wins = wins & (F.col(key).isNull() | (F.col(f"__{newer}") > F.col(newer)))
    return both.select(
        F.coalesce(key, "__k").alias(key),
        *[F.when(wins, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in take],
        *[F.when(wins, F.coalesce(f"__{c}", c)).otherwise(F.col(c)).alias(c) for c in keep],
    )


def newest_mapping(rows: DataFrame, key: str, value: str, ts: str) -> DataFrame:
    """key -> value of the greatest time; at equal time the smaller value, which came first, stays."""
    best = F.max(F.struct(F.col(ts).alias("t"), (-F.col(value)).alias("v"))) if dict(rows.dtypes)[value] in ("int", "bigint") else None
    if best is not None:
        return rows.groupBy(key).agg(best.alias("b")).select(key, (-F.col("b.v")).alias(value), F.col("b.t").alias(ts))
    w = W.partitionBy(key).orderBy(F.col(ts).desc(), F.col(value))
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").select(key, value, ts)


def relistings(rows: DataFrame, key: str, place: str, ts: str, tie: str) -> DataFrame:
    """Mapping events: where a key's place is new (mapped) or differs from the last (remapped, with it)."""
    w = W.partitionBy(key).orderBy(ts, tie)
    out = rows.withColumn("previous", F.lag(place).over(w)).filter(F.col("previous").isNull() | (F.col("previous") != F.col(place)))
    return out.select(key, place, ts, F.when(F.col("previous").isNull(), "mapped").otherwise("remapped").alias("event_type"), "previous")


def attempt_counter(events: DataFrame, key: str, ts: str, tie: str, cleared: Column) -> DataFrame:
    """First and last attempt and attempts of every key since it was last cleared; cleared keys are out."""
    w = W.partitionBy(key).orderBy(ts, tie).rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = events.withColumn("__c", F.coalesce(cleared, F.lit(False)).cast("int")).withColumn("__life", F.sum("__c").over(w))
    lives = rows.groupBy(key, "__life").agg(F.min(F.when(F.col("__c") == 0, F.col(ts))).alias("first_attempted_at"), F.max(F.when(F.col("__c") == 0, F.col(ts))).alias("last_attempted_at"), F.count_if(F.col("__c") == 0).alias("num_of_attempts"))
    last = lives.groupBy(key).agg(F.max(F.struct("__life", "first_attempted_at", "last_attempted_at", "num_of_attempts")).alias("r"))
    return last.select(key, "r.first_attempted_at", "r.last_attempted_at", "r.num_of_attempts").filter("num_of_attempts > 0")


def newly_present(rows: DataFrame, known: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct lower-cased key columns not known yet, as 'added' events."""
    low = rows.select(*[F.lower(F.col(c)).alias(c) for c in columns]).dropna().distinct()
    return low.join(known.select(*columns), list(columns), "left_anti").withColumn("event_type", F.lit("added"))


def resolve(rows: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """Fill a null value by its key's mapping."""
    m = mapping.select(F.col(key).alias("__k"), F.col(value).alias("__v"))
    return rows.join(m, F.col(key) == F.col("__k"), "left").withColumn(value, F.coalesce(value, "__v")).drop("__k", "__v")


def clearing_events(open_keys: DataFrame, key: str, at: str | Column, *alive: DataFrame) -> DataFrame:
    """'cleared' events for open keys that no frame of living keys holds; none are left to clear after."""
    for a in alive:
        open_keys = open_keys.join(a.select(key).distinct(), key, "left_anti")
    return open_keys.select(key).distinct().withColumn("event_type", F.lit("cleared")).withColumn("event_at", X.as_of(at))


def open_cooldowns(events: DataFrame, key: str, ts: str, tie: str, kind: str, kinds: Sequence[str] = ("blocked", "incremented")) -> DataFrame:
    """Keys whose latest event is one of kinds."""
    last = events.groupBy(key).agg(X.latest_row([kind], ts, tie).alias("r"))
    return last.filter(F.col(f"r.c_{kind}").isin(*kinds)).select(key)


def stuck(queue: DataFrame, events: DataFrame, key: str, status: str, created: str, event_ts: str, event_status: str, as_of: str, working: str = "processing", after: str = "2 HOURS") -> DataFrame:
    """Rows at work since longer than `after`: since their last working event, or their creation."""
    last = events.filter(F.col(event_status) == working).groupBy(key).agg(F.max(event_ts).alias("__last"))
    rows = queue.filter(F.col(status) == working).join(last, key, "left").withColumn("working_since", F.coalesce("__last", created)).drop("__last")
    return rows.filter(F.col("working_since") < X.as_of(as_of) - F.expr(f"INTERVAL {after}"))


def expired(claims: DataFrame, claimed: str, as_of: str, after: str = "2 HOURS") -> DataFrame:
    return claims.filter(F.col(claimed) < X.as_of(as_of) - F.expr(f"INTERVAL {after}"))


def cleanup_candidates(queue: DataFrame, key: str, status: str, ts: str, as_of: str, n: int, done: Sequence[str] = ("complete", "skip"), retry: str = "retry", after: str = "1 HOURS") -> DataFrame:
    """The n oldest finished rows, and rows waiting for a retry for longer than `after`."""
    ready = F.col(status).isin(*done) | ((F.col(status) == retry) & (F.col(ts) < X.as_of(as_of) - F.expr(f"INTERVAL {after}")))
    return queue.filter(ready).orderBy(ts, key).limit(n)


def backlog(first: DataFrame, second: DataFrame, first_ts: str, second_ts: str) -> DataFrame:
    """One row: work in flight in two queues and the oldest start in either."""
    a = first.agg(F.count("*").alias("first_in_flight"), F.min(first_ts).alias("__a"))
    b = second.agg(F.count("*").alias("second_in_flight"), F.min(second_ts).alias("__b"))
    return a.crossJoin(b).select("first_in_flight", "second_in_flight", F.least("__a", "__b").alias("oldest_started_at"))


def fan_out(pages: DataFrame, primary: str, nested: str, inherit: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Parsed pages as rows: the primary struct, and one row for each nested struct with columns
    inherited from the primary; rows without a required column are dropped."""
    own = pages.select(f"{primary}.*")
    fields = pages.schema[nested].dataType.elementType.fieldNames()
    more = pages.select(F.col(primary).alias("p"), F.explode(nested).alias("n")).select(*[F.col(f"n.{c}") for c in fields], *[F.col(f"p.{c}") for c in inherit if c not in fields])
    for c in required:
        more = more.filter(F.col(c).isNotNull())
    return own.unionByName(more, allowMissingColumns=True)
