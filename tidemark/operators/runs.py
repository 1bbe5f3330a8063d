"""Latest rows, price histories, fingerprints, runs (gaps and islands), benchmarks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import exprs as X
from tidemark.operators import scans
from tidemark.operators.ranks import with_quantiles


def desc(columns: Sequence[str | Column]) -> list[Column]:
    return [X.col(c).desc() for c in columns]


def top_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of every key in a total order."""
    keys = [key] if isinstance(key, str) else list(key)
    name = rank or "__rn"
    out = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def least_values(df: DataFrame, group: str, value: str, n: int, name: str) -> DataFrame:
    """The n least distinct values of each group, sorted; each task passes on n of a group at most."""
    top = top_per_key(df.select(group, value).distinct(), group, [F.col(value).asc_nulls_last()], n)
    return top.groupBy(group).agg(F.sort_array(F.collect_list(value)).alias(name))


def latest_observation(obs: DataFrame, key: str, source: str, priority: Sequence[str], ts: str, tie: str, required: str | None = None) -> DataFrame:
    """The best row of every key: source by priority, then the newest, then the greatest tie column.

    It is one aggregate over structs, so partial aggregation leaves a row for each key and task to
    shuffle, where a window would shuffle and sort all rows.
    """
    rows = obs.filter(F.col(key).isNotNull())
    if required:
        rows = rows.filter(F.col(required).isNotNull())
    rest = [c for c in rows.columns if c not in (key, ts, tie)]
    best = F.max(F.struct((-X.rank_by(source, priority)).alias("p"), F.col(ts).alias("t"), F.col(tie).alias("i"), F.struct(*[F.col(c).alias(c) for c in rest]).alias("r")))
    got = rows.groupBy(key).agg(best.alias("b"))
    return got.select(key, F.col("b.t").alias(ts), F.col("b.i").alias(tie), *[F.col(f"b.r.{c}").alias(c) for c in rest]).select(*rows.columns)


def with_previous(df: DataFrame, key: str, order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    return df.withColumn(name, F.lag(value).over(W.partitionBy(key).orderBy(*[X.col(o) for o in order])))


def price_history(events: DataFrame, key: str, price: str, ts: str, tie: str, newest: Sequence[str] = (), spread: bool = False, changes: Mapping[str, Column] | None = None) -> DataFrame:
    """One row a key: current, first, least and greatest price, counts of events, drops and rises.

    The `newest` columns come from the key's newest row, as newest_<name>. `changes` has, by name, instants from
    which on changes of the price are counted, in the same pass (marts.price_changes counts them alone). spread: for keys whose rows are too
    many for a task (scans.ranged); time and tie must then tell a key's rows apart.
    """
    rows = events.select(key, price, ts, tie, *newest)
    rows = scans.neighbours(scans.ranged(rows, key, [ts, tie]), key, [ts, tie], {"prev": price}, "__first") if spread else with_previous(rows, key, [ts, tie], price, "prev")
    p = F.col(price)
    last = [X.latest_row(list(newest), ts, tie).alias("__last")] if newest else []
    out = rows.groupBy(key).agg(
        X.latest(price, ts, tie).alias("current_price"),
        F.max(F.when(p.isNotNull(), F.col(ts))).alias("price_observed_at"),
        X.earliest(price, ts, tie).alias("first_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.count("*").alias("total_price_observations"),
        F.count_if(p < F.col("prev")).alias("price_drop_count"),
        F.count_if(p > F.col("prev")).alias("price_increase_count"),
        F.min(ts).alias("first_seen_at"),
        F.max(ts).alias("last_seen_at"),
        *[F.count_if((p != F.col("prev")) & (F.col(ts) >= since)).alias(name) for name, since in (changes or {}).items()],
        *last,
    )
    return out.select("*", *[F.col(f"__last.c_{c}").alias(f"newest_{c}") for c in newest]).drop("__last")


def percent_rank(df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """percent_rank() of value, not null, within its group: ranked are a group's distinct values with their counts."""
    counts = df.groupBy(*group, value).agg(F.count("*").alias("__n"))
    w = W.partitionBy(*group)
    below, all_ = F.sum("__n").over(w.orderBy(value)) - F.col("__n"), F.sum("__n").over(w)
    ranks = counts.select(*[F.col(c).alias(f"__{c}") for c in (*group, value)], F.when(all_ > 1, below / (all_ - 1)).otherwise(0.0).alias(name))
    on = F.col(value) == F.col(f"__{value}")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__{g}"))
    return df.join(ranks, on).drop(*[f"__{c}" for c in (*group, value)])


def benchmarks(latest: DataFrame, history: DataFrame, key: str, history_key: str, group: Sequence[str], list_price: str, discount: str = "decimal(5,2)", spread: bool = False) -> DataFrame:
    """Price statistics of each group: exact percentiles, to the even integer, and the mean discount.

    spread: for groups whose distinct prices are too many for a task.

    Percentiles are first rounded to 6 places, so that the last bits of the interpolation don't move a half.
    """
    h = history.filter(F.col("current_price") > 0).select(F.col(history_key).alias("__k"), F.col("current_price").alias("p"))
    rows = latest.join(h, F.col(key) == F.col("__k")).filter(" and ".join(f"{g} is not null" for g in group))
    p, m = F.col("p"), F.col(list_price)
    out = with_quantiles(rows.select(*group, list_price, p), group, p, [0.1, 0.25, 0.5, 0.75, 0.9], [
        F.count("*").alias("national_listing_count"),
        X.to_int_half_even(F.avg(p.cast("double"))).alias("national_avg_price"),
        F.avg(F.when(m > 0, (m - p).cast("double") / m * 100)).cast(discount).alias("national_avg_discount_pct"),
    ], spread)
    names = ["national_p10_price", "national_p25_price", "national_median_price", "national_p75_price", "national_p90_price"]
    return out.select(*group, "national_listing_count", "national_avg_price", *[X.to_int_half_even(F.round(F.col("q")[k], 6)).alias(n) for k, n in enumerate(names)], "national_avg_discount_pct")


def fingerprints(obs: DataFrame, key: Sequence[str], fields: Sequence[str], order: Sequence[str], carry: Sequence[str] = (), ids: Sequence[str] = (), name: str = "fingerprint") -> DataFrame:
    """One row a key: the md5 of its fields, of the row that is newest by `order`, then by fingerprint.

    With ids, observation_id is the md5 of those columns.
    """
    rows = obs.withColumn(name, X.fingerprint(fields))
    out = top_per_key(rows, list(key), [*desc(order), F.col(name).desc()])
    if ids:
        out = out.withColumn("observation_id", X.fingerprint(ids))
    return out.select(*dict.fromkeys([*(["observation_id"] if ids else []), *key, *order, name, *carry]))


def runs(df: DataFrame, entity: str, order: Sequence[str], state: str | Sequence[str], first: Sequence[str] = (), sources: Mapping[str, Column] | None = None, distinct: Mapping[str, str] | None = None, any_of: Sequence[str] = (), spread: bool = False) -> DataFrame:
    """Maximal runs of equal state of an entity in order; order[0] is the time, the rest break ties.

    Per run: n, start and end, duration and time to the next run in hour boundaries, is_open for the
    last. `first` columns come from the run's first row, `any_of` columns from any row that has them;
    `sources` gives counts (n_<name>) and flags (<name>_seen) of rows that meet a condition. spread: for
    entities whose rows are too many for a task (scans.ranged); order must then tell an entity's rows apart.
    """
    states = [state] if isinstance(state, str) else list(state)
    if spread:
        before = {f"__was{k}": c for k, c in enumerate(states)}
        rows = scans.neighbours(scans.ranged(df, entity, order), entity, order, before, "__first")
        differs = F.col("__first")
        for was, c in before.items():
            differs = differs | X.distinct_from(c, was)
        rows = scans.running(rows.withColumn("__new", differs.cast("int")), entity, order, "__new", "__run").drop(*before, "__first", "__part")
    else:
        w = W.partitionBy(entity).orderBy(*order)
        changed = F.lit(False)
        for s in states:
            changed = changed | X.distinct_from(s, F.lag(s).over(w))
        # the flag is a column of its own before it is summed
        rows = df.withColumn("__new", F.when((F.row_number().over(w) == 1) | changed, 1).otherwise(0))
        rows = rows.withColumn("__run", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    ts = order[0]
    aggs = [F.min(ts).alias("run_started_at"), F.max(ts).alias("run_ended_at"), F.count("*").alias("n_observations")]
    aggs += [F.first(s).alias(s) for s in states]
    aggs += [X.earliest(F.struct(c), *order)[c].alias(c) for c in first]
    aggs += [F.max(c).alias(c) for c in any_of]
    for name, met in (sources or {}).items():
        aggs += [F.count_if(met).alias(f"n_{name}"), F.coalesce(F.bool_or(met), F.lit(False)).alias(f"{name}_seen")]
    aggs += [F.count_distinct(c).alias(name) for name, c in (distinct or {}).items()]
    out = rows.groupBy(entity, "__run").agg(*aggs)
    if spread:
        out = scans.neighbours(scans.ranged(out, entity, ["__run"]), entity, ["__run"], {"next_run_started_at": "run_started_at"}, "__last", ahead=True).drop("__last", "__part")
    else:
        out = out.withColumn("next_run_started_at", F.lead("run_started_at").over(W.partitionBy(entity).orderBy("__run")))
    out = out.withColumn("run_duration_hours", X.hour_diff("run_started_at", "run_ended_at")).withColumn("hours_until_change", X.hour_diff("run_started_at", "next_run_started_at"))
    return out.withColumn("is_open_run", F.col("next_run_started_at").isNull()).drop("__run")


def novelty(df: DataFrame, key: str, step: str, new: str, frame: int = 5, least: float = 1.0) -> DataFrame:
    """Moving mean of `new` over the last `frame` steps; should_stop once a full frame lies under `least`."""
    w = W.partitionBy(key).orderBy(step).rowsBetween(1 - frame, 0)
    out = df.withColumn("avg_new", F.avg(new).over(w)).withColumn("__n", F.count(new).over(w))
    return out.withColumn("should_stop", (F.col("__n") == frame) & (F.col("avg_new") < least)).drop("__n")
