"""Dashboard, KPI and alert queries over the marts; every time-relative one takes as_of."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators.ranks import with_quantiles
from tidemark.operators.staging import optional_filters, since

TIER_ORDER = ("excellent", "good", "fair", "weak")
MARKET_DAYS = ((None, 7, "0-7"), (8, 14, "8-14"), (15, 30, "15-30"), (31, 60, "31-60"))


def deals_table(deals: DataFrame, columns: Sequence[str], score: str = "deal_score", **chosen: Sequence | None) -> DataFrame:
    """The chosen deals, best first."""
    return optional_filters(deals, **chosen).select(*columns).orderBy(F.desc(score), columns[0])


def tier_distribution(deals: DataFrame, tier: str = "deal_tier") -> DataFrame:
    return deals.groupBy(tier).agg(F.count("*").alias("deals")).orderBy(X.rank_by(tier, TIER_ORDER))


def market_days(df: DataFrame, days: str = "days_on_market") -> DataFrame:
    """Histogram of days on market, in order of its bounds."""
    rows = df.withColumn("days_bucket", X.bucket(days, MARKET_DAYS, "60+"))
    return rows.groupBy("days_bucket").agg(F.count("*").alias("vehicles"), F.min(days).alias("least_days")).orderBy("least_days")


def price_drops(df: DataFrame, key: str, first: str = "first_price", now: str = "current_price", drops: str = "price_drop_count") -> DataFrame:
    rows = df.filter((F.col(drops) > 0) & (F.col(first) > F.col(now)))
    return rows.select(key, first, now, (F.col(first) - F.col(now)).alias("drop_amount"), F.round((F.col(first) - F.col(now)) * F.lit(100.0) / F.col(first), 1).alias("drop_pct"), drops).orderBy(F.desc("drop_amount"), key)


def price_vs_list(df: DataFrame, group: Sequence[str], price: str, list_price: str) -> DataFrame:
    rows = df.filter((F.col(price) > 0) & (F.col(list_price) > 0))
    return rows.groupBy(*group).agg(F.count("*").alias("vehicles"), F.round(F.avg(price), 2).alias("avg_price"), F.round(F.avg(list_price), 2).alias("avg_list_price"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def count_active(df: DataFrame, where: Column | None = None, name: str = "active") -> DataFrame:
    return (df if where is None else df.filter(where)).agg(F.count("*").alias(name))


def new_since(df: DataFrame, ts: str, as_of: str, interval: str, name: str = "new_listings") -> DataFrame:
    return since(df, ts, as_of, interval).agg(F.count("*").alias(name))


def by_group(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Count, rounded mean and least value of each group."""
    return df.groupBy(*group).agg(F.count("*").alias("vehicles"), F.round(F.avg(value), 2).alias("avg_value"), F.min(value).alias("min_value"))


def per_day(df: DataFrame, ts: str, *group: str, where: Column | None = None) -> DataFrame:
    rows = df if where is None else df.filter(where)
    return rows.groupBy(F.date_trunc("day", F.col(ts)).alias("day"), *group).agg(F.count("*").alias("listings"))


def top_groups(df: DataFrame, names: Sequence[str], n: int, label: str = "name") -> DataFrame:
    """The n groups of most rows, a group being the first of the columns that isn't null."""
    out = df.groupBy(F.coalesce(*names).alias(label)).agg(F.count("*").alias("vehicles"))
    return out.orderBy(F.desc("vehicles"), F.col(label).asc_nulls_last()).limit(n)


def spread(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Exact median, rounded mean, least and greatest value of each group."""
    v = F.col(value).cast("double")
    return df.groupBy(*group).agg(F.count("*").alias("vehicles"), F.median(v).alias("median_value"), F.round(F.avg(v), 1).alias("avg_value"), F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def price_percentiles(df: DataFrame, group: Sequence[str], value: str, points: Sequence[int] = (10, 25, 50, 75, 90), spread: bool = False) -> DataFrame:
    """Exact interpolated percentiles p10 to p90 to 6 places. spread: for groups whose distinct values are too many for a task."""
    got = with_quantiles(df.select(*group, value), group, value, [p / 100 for p in points], [F.count(value).alias("vehicles")], spread)
    return got.select(*group, "vehicles", *[F.round(F.col("q")[k], 6).alias(f"p{p}") for k, p in enumerate(points)])


def supply(bench: DataFrame, group: Sequence[str], count: str = "national_listing_count", price: str = "national_median_price") -> DataFrame:
    return bench.groupBy(*group).agg(F.sum(count).alias("listings"), F.round(F.avg(price), 0).alias("avg_median_price"))


def recent(df: DataFrame, ts: str, as_of: str, interval: str, columns: Sequence[str]) -> DataFrame:
    return since(df, ts, as_of, interval).select(*columns)


def newest(df: DataFrame, ts: str, n: int, columns: Sequence[str] | None = None) -> DataFrame:
    """The n newest rows of a table with one row a time."""
    return df.select(*(columns or df.columns)).orderBy(F.desc(ts)).limit(n)


def freshness(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.max(ts).alias("newest"))


def roll_up(df: DataFrame, hour: str, unit: str, group: Sequence[str], sums: Sequence[str], rate: tuple[str, str, str] | None = None) -> DataFrame:
    """Hourly sums by day or week (weeks begin on Monday); rate = (name, part, whole) from the sums."""
    out = df.groupBy(F.date_trunc(unit, F.col(hour)).alias("period"), *group).agg(*[F.sum(c).alias(c) for c in sums])
    return out.withColumn(rate[0], X.percent(rate[1], rate[2], 3)) if rate else out


def today(df: DataFrame, hour: str, count: str) -> DataFrame:
    """One row: the newest day's total and the mean total of its hours."""
    per_hour = df.groupBy(hour).agg(F.sum(count).alias("n"))
    rows = per_hour.crossJoin(F.broadcast(per_hour.agg(F.date_trunc("day", F.max(hour)).alias("d")))).filter(F.col(hour) >= F.col("d"))
    return rows.agg(F.max("d").alias("day"), F.sum("n").alias("today"), F.round(F.avg("n"), 1).alias("avg_per_hour"))


def overall_percent(df: DataFrame, part: str, whole: str, name: str) -> DataFrame:
    return df.agg(F.sum(part).alias(part), F.sum(whole).alias(whole)).withColumn(name, X.percent(part, whole))


def landing(active: DataFrame, volume: DataFrame, group: Sequence[str], hour: str, count: str, as_of: str) -> DataFrame:
    """One row: active keys, all observations, distinct groups, and rows an hour over the last day."""
    a = active.agg(F.count("*").alias("active"), F.count_distinct(F.concat_ws("|", *group)).alias("groups"))
    b = volume.agg(F.sum(count).alias("observations"))
    c = since(volume, hour, as_of, "24 HOURS").agg(F.round(F.sum(count) / F.lit(24.0), 1).alias("per_hour_24h"))
    return a.crossJoin(b).crossJoin(c)


def one_row(*frames: DataFrame) -> DataFrame:
    """One-row frames side by side."""
    return reduce(lambda x, y: x.crossJoin(y), frames)


def alerts(gauges: DataFrame, rules: Mapping[str, tuple[str, float]]) -> DataFrame:
    """(gauge, value, threshold, fired) of each rule, (">" or "<", threshold); a missing gauge doesn't fire."""
    parts = []
    for name, (op, limit) in rules.items():
        v = F.col(name).cast("double")
        parts.append(F.struct(F.lit(name).alias("gauge"), v.alias("value"), F.lit(float(limit)).alias("threshold"), F.coalesce(v > limit if op == ">" else v < limit, F.lit(False)).alias("fired")))
    return gauges.select(F.explode(F.array(*parts)).alias("a")).select("a.*")


ALERT_RULES = {"volume": ("<", 100), "yield_pct": ("<", 90), "stale_pct": (">", 20), "backlog": (">", 5000), "block_events": (">", 200)}
