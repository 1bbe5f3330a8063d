"""Staging operators: projections, filters and small dimensions. Column names are parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import exprs as X
from tidemark.sources.scratch import written


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Exactly the named columns, renamed or computed: {new name: column}."""
    return df.select(*[X.col(c).alias(name) for name, c in columns.items()])


def observations(df: DataFrame, vin: str = "vin", renames: Mapping[str, str] | None = None) -> DataFrame:
    """All columns with the given renames, and vin17, the cleaned VIN."""
    renames = {"trim": "vehicle_trim", "year": "model_year"} if renames is None else renames
    return df.withColumnsRenamed({a: b for a, b in renames.items() if a in df.columns}).withColumn("vin17", X.clean_vin(vin))


def price_events(df: DataFrame, key: str = "vin", price: str = "price", kind: str = "event_type", dropped: str = "deleted") -> DataFrame:
    """Events with a key and a positive price that aren't of the dropped type; a null type drops too."""
    return df.filter(F.col(key).isNotNull() & (F.col(kind) != dropped) & (F.col(price) > 0)).withColumn(key, F.upper(F.col(key).cast("string")))


def cooldown_events(df: DataFrame, columns: Sequence[str] = ("event_id", "listing_id", "event_type", "num_of_attempts", "event_at")) -> DataFrame:
    return df.select(*columns)


def search_configs(df: DataFrame, params: str = "params", ints: Mapping[str, str] | None = None, firsts: Mapping[str, str] | None = None) -> DataFrame:
    """A JSON column flattened: `ints` by path as integers (null if they aren't), `firsts` as an array's first element."""
    ints = {"radius_miles": "$.radius_miles"} if ints is None else ints
    firsts = {"make": "$.makes[0]", "model": "$.models[0]"} if firsts is None else firsts
    out = df
    for name, path in firsts.items():
        out = out.withColumn(name, X.json_text(params, path))
    for name, path in ints.items():
        out = out.withColumn(name, X.json_text(params, path).try_cast("int"))
    return out.drop(params)


def dealers(df: DataFrame, key: str, values: Mapping[str, str], *order: str) -> DataFrame:
    """One row a key: for each new name, the latest non-null value of its column."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*[X.latest(c, *order).alias(name) for name, c in values.items()])


# predicates


def key_match(df: DataFrame, keys: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose key columns, nulls equal to nulls, are among the keys."""
    k = keys.select(*[F.col(c).alias(f"__{c}") for c in columns]).distinct()
    on = [df[c].eqNullSafe(k[f"__{c}"]) for c in columns]
    return df.join(k, on, "left_semi")


def among(df: DataFrame, column: str, values: DataFrame | Sequence) -> DataFrame:
    """Rows whose value is among those given, as a list or a one-column frame; none if it is empty."""
    if isinstance(values, DataFrame):
        return df.join(values.select(F.col(values.columns[0]).alias("__v")).distinct(), F.col(column) == F.col("__v"), "left_semi")
    return df.filter(F.col(column).isin(list(values))) if len(values) else df.filter(F.lit(False))


def optional_filters(df: DataFrame, **chosen: Sequence | None) -> DataFrame:
    """One `column IN (values)` for every column whose values are given and not empty."""
    for column, values in chosen.items():
        if values:
            df = df.filter(F.col(column).isin(list(values)))
    return df


def ilike(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.filter(F.col(column).ilike(pattern))


def since(df: DataFrame, ts: str, instant: str | Column, interval: str) -> DataFrame:
    """Rows no older than an interval (such as "7 DAYS") before an instant; later rows included."""
    return df.filter(F.col(ts) >= X.as_of(instant) - F.expr(f"INTERVAL {interval}"))


# joins that are more than a join type


def prefix_match(df: DataFrame, targets: DataFrame, group: str, text: str, target_group: str, target_text: str) -> DataFrame:
    """Rows whose text equals, or starts with the words of, any target of their group.

    Each distinct text asks for its starts at word ends, up to the longest target, by equality; a group's rows
    don't meet all its targets.
    """
    t = targets.select(F.col(target_group).alias("__g"), F.col(target_text).alias("__t")).distinct()
    most = F.broadcast(t.agg(F.max(F.size(F.split("__t", " "))).alias("__most")))  # one row
    words = F.slice(F.split("__x", " "), F.lit(1), F.col("__most"))
    starts = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))
    asked = df.select(F.col(group).alias("__g"), F.col(text).alias("__x")).distinct().crossJoin(most).select("__g", "__x", F.explode(starts).alias("__t"))
    met = asked.join(t, ["__g", "__t"], "left_semi").select("__g", "__x").distinct()
    return df.join(met, (df[group] == met["__g"]) & (df[text] == met["__x"]), "left_semi")


def elsewhere(df: DataFrame, other: DataFrame, key: str, place: str) -> DataFrame:
    """Rows whose key is known at another place."""
    o = other.groupBy(F.col(key).alias("__k")).agg(F.min(place).alias("__lo"), F.max(place).alias("__hi"))
    return df.join(o, (df[key] == o["__k"]) & ((df[place] != o["__lo"]) | (df[place] != o["__hi"])), "left_semi")


def followed_by(df: DataFrame, key: str, ts: str, before: Column, after: Column) -> DataFrame:
    """(key, first_before, last_after) of keys with an `after` row later than some `before` row.

    The pairs themselves aren't formed: the earliest `before` and the latest `after` decide.
    """
    out = df.groupBy(key).agg(F.min(F.when(before, F.col(ts))).alias("first_before"), F.max(F.when(after, F.col(ts))).alias("last_after"))
    return out.filter("last_after > first_before")


def with_latest_event(df: DataFrame, events: DataFrame, key: str, event_ts: str, fallback: str, name: str = "last_event_at") -> DataFrame:
    """Each row with its key's latest event time, or its own fallback time."""
    last = events.groupBy(key).agg(F.max(event_ts).alias("__last"))
    return df.join(last, key, "left").withColumn(name, F.coalesce("__last", fallback)).drop("__last")


def difference(keys: DataFrame, *others: DataFrame) -> DataFrame:
    """Keys that none of the others holds."""
    for o in others:
        keys = keys.join(o.select(*keys.columns).distinct(), keys.columns, "left_anti")
    return keys.distinct()


def union_keys(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()


# sampling and order


def hash_order(df: DataFrame, key: str, n: int) -> DataFrame:
    """n rows in the pseudo-random but fixed order of md5(key)."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def page_of(df: DataFrame, order: Sequence[Column | str], offset: int, n: int) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(n)


def every_nth(df: DataFrame, order: Sequence[str], n: int, start: int = 0) -> DataFrame:
    """A systematic sample: rows start, start + n, start + 2 n, ... of df in the given order.

    No task sees all rows: they are sorted by ranges and written, each range is counted, and a row's
    number is its place in its range plus the rows of the ranges before (one count a range).
    """
    at = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__at", 33)
    counts = at.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = counts.select("__part", (F.sum("__n").over(W.orderBy("__part")) - F.col("__n")).alias("__before"))
    number = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    rows = at.withColumn("__part", part).join(before, "__part")
    return rows.filter((number >= start) & (F.pmod(number - start, F.lit(n)) == 0)).select(*df.columns)


def bernoulli(df: DataFrame, fraction: float, seed: int = 0) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)
