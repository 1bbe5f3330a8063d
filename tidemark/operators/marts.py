"""Composite models: active models, volatility features, snapshot, scores and health marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import exprs as X
from tidemark.operators.ranks import with_quantiles
from tidemark.operators.runs import percent_rank, with_previous
from tidemark.sources.scratch import written


def active_models(tracked: DataFrame, configs: DataFrame, config: str = "search_key", enabled: str = "enabled", group: Sequence[str] = ("make", "model")) -> DataFrame:
    """Distinct groups that any enabled config tracks."""
    return tracked.join(configs.filter(F.col(enabled)).select(config), config, "left_semi").select(*group).distinct()


def change_starts(as_of: str, days: Sequence[int] = (7, 30)) -> dict[str, Column]:
    """By the names of the counts of price changes, the instants so many days before as_of."""
    return {f"price_change_count_{d}d": X.as_of(as_of) - F.expr(f"INTERVAL {d} DAYS") for d in days}


def price_changes(events: DataFrame, key: str, price: str, ts: str, tie: str, as_of: str, days: Sequence[int] = (7, 30)) -> DataFrame:
    """Per key, how often the price changed in the last so many days before the instant."""
    at = X.as_of(as_of)
    rows = with_previous(events.filter(F.col(ts) <= at).select(key, price, ts, tie), key, [ts, tie], price, "prev")
    moved = F.col("prev").isNotNull() & (F.col(price) != F.col("prev"))
    return rows.groupBy(key).agg(*[F.count_if(moved & (F.col(ts) >= since)).alias(name) for name, since in change_starts(as_of, days).items()])


def volatility_features(
    obs: DataFrame, events: DataFrame | None, history: DataFrame, bench: DataFrame, state_runs: DataFrame, source_runs: DataFrame, as_of: str, *,
    key: str = "vin17", listing: str = "listing_id", event_key: str = "vin", price: str = "price", ts: str = "fetched_at", tie: str = "artifact_id", event_ts: str = "event_at", event_tie: str = "event_id",
    source: str = "source", main: str = "detail", side: str = "srp", state: str = "listing_state", fingerprint: str = "fingerprint", dealer: str = "customer_id", group: Sequence[str] = ("make", "model"), spread: bool = False,
) -> DataFrame:
    """One row a key, of its open run, as of an instant.

    obs and events are cut at the instant here; without events, history has the counts of price changes
    (price_history makes them of change_starts), which saves the events a second shuffle and sort. history, bench and the runs should have been made from
    inputs cut at it (cut_at does that), else they look ahead. Runs with their metadata, which three parts
    of the result read, are written to the checkpoint folder first. What a key's runs give is one aggregate,
    after one shuffle by key. spread: for dealers or groups whose distinct run lengths are too many for a task.
    """
    at = X.as_of(as_of)
    seen = obs.filter(F.col(ts) <= at)
    meta = seen.filter((F.col(source) == main) & F.col(key).isNotNull()).groupBy(key, listing).agg(*[X.latest(c, ts, tie).alias(c) for c in (dealer, *group)])
    rows = written(state_runs.join(meta, [key, listing], "left"), "runs")
    opened = F.struct(F.col("run_started_at"), F.col("n_observations"), *[F.col(c) for c in (listing, dealer, *group)])
    keys = with_previous(rows.filter(F.col(key).isNotNull()), key, ["run_started_at", fingerprint], state, "prev").groupBy(key).agg(
        (F.count("*") - 1).alias("total_state_changes"), F.count_distinct(listing).alias("listing_id_change_count"), F.min("run_started_at").alias("first_seen_at"), F.max("run_ended_at").alias("latest_fetched_at"),
        F.count_if(F.col(state) != F.col("prev")).alias("listing_state_change_count"), F.max(F.when(F.col("is_open_run"), opened)).alias("open"),
    ).filter("open is not null").select("*", "open.*").drop("open")
    closed = rows.filter(~F.col("is_open_run"))

    def lengths(by: Sequence[str], name: str) -> DataFrame:
        some = closed.filter(" and ".join(f"{k} is not null" for k in by)).select(*by, "run_duration_hours")
        out = with_quantiles(some, by, "run_duration_hours", [0.5], [F.avg("run_duration_hours").alias(f"{name}_avg_run_length_hours")], spread)
        return out.select(*by, f"{name}_avg_run_length_hours", F.col("q")[0].alias(f"{name}_median_run_length_hours"))

    counted = list(change_starts(as_of)) if events is None else []
    prices = history.select(F.col(event_key).alias(key), "current_price", *counted)
    if events is not None:
        prices = prices.join(price_changes(events, event_key, price, event_ts, event_tie, as_of).withColumnRenamed(event_key, key), key, "full")
    seen_side = seen.filter(F.col(source) == side).groupBy(listing).agg(F.max(ts).alias("recent_srp_seen_at"))
    everywhere = source_runs.filter("is_open_run").select(listing, F.col("run_started_at").alias("all_source_run_started_at"), *[F.col(c).alias(f"all_source_{c}") for c in source_runs.columns if c.startswith("n_")], *[F.col(c).alias(f"__{c}") for c in source_runs.columns if c.endswith("_seen")])
    out = keys.join(prices, key, "left")
    out = out.join(bench.select(*group, "national_median_price"), list(group), "left").join(lengths([dealer], "dealer"), dealer, "left").join(lengths(list(group), "make_model"), list(group), "left")
    out = out.join(seen_side, listing, "left").join(everywhere, listing, "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    others = [c for c in out.columns if c.startswith("__") and c != f"__{main}_seen"]
    other_seen = F.lit(False)
    for c in others:
        other_seen = other_seen | F.coalesce(F.col(c), F.lit(False))
    return out.select(
        key, listing, "latest_fetched_at", "first_seen_at", "total_state_changes", "listing_id_change_count",
        X.day_diff("run_started_at", at).alias("days_since_last_state_change"),
        F.col("n_observations").alias("unchanged_observation_streak"),
        "listing_state_change_count", "current_price", count("price_change_count_7d"), count("price_change_count_30d"),
        F.when(F.col("national_median_price") > 0, F.col("current_price").cast("double") / F.col("national_median_price")).alias("price_vs_make_model_median"),
        X.day_diff("first_seen_at", at).alias("listing_days_on_market"),
        "dealer_avg_run_length_hours", "dealer_median_run_length_hours", "make_model_avg_run_length_hours", "make_model_median_run_length_hours",
        "recent_srp_seen_at", X.day_diff("recent_srp_seen_at", at).alias("days_since_srp_seen"),
        "all_source_run_started_at", X.day_diff("all_source_run_started_at", at).alias("days_since_last_all_source_change"),
        *[count(c) for c in out.columns if c.startswith("all_source_n_")],
        other_seen.alias("all_source_non_detail_refresh_seen"),
    )


def cut_at(df: DataFrame, ts: str, as_of: str) -> DataFrame:
    """Rows not later than the instant: what a backtest may see."""
    return df.filter(F.col(ts) <= X.as_of(as_of))


def newest_state(obs: DataFrame, key: str, state: str, source: str, ts: str, tie: str) -> DataFrame:
    """(key, state, source) of the newest row of every key."""
    return obs.filter(F.col(key).isNotNull()).groupBy(key).agg(X.latest_row([state, source], ts, tie).alias("r")).select(key, F.col(f"r.c_{state}").alias("newest_state"), F.col(f"r.c_{source}").alias("newest_source"))


def vehicle_snapshot(latest: DataFrame, history: DataFrame, newest: DataFrame | None, active: DataFrame | None, as_of: str, *, key: str = "vin17", history_key: str = "vin", group: Sequence[str] = ("make", "model"), main: str = "detail", fresh: str = "7 DAYS") -> DataFrame:
    """Current state of every key: the main source's own state if its row is the newest, else by price age.

    newest has newest_state and newest_source by key; it is None where history has these columns itself.
    """
    h = history.withColumnRenamed(history_key, "__k").withColumnRenamed("current_price", "price")
    out = latest.join(h, F.col(key) == F.col("__k"), "left").drop("__k")
    out = out if newest is None else out.join(newest, key, "left")
    if active is not None:
        a = active.select(*[F.col(g).alias(f"__{g}") for g in group])
        on = [F.lower(F.col(g)) == F.col(f"__{g}") for g in group]
        out = out.join(a, on, "left_semi")
    by_price = F.when(F.col("last_seen_at") >= X.as_of(as_of) - F.expr(f"INTERVAL {fresh}"), "active").otherwise("unlisted")
    state = F.coalesce(F.when(F.col("newest_source") == main, F.col("newest_state")), by_price)
    return out.withColumn("current_state", state).withColumn("days_on_market", X.day_diff("first_seen_at", X.as_of(as_of))).drop("newest_state", "newest_source")


#: Points of the score: cap, divisor and weight of each part.
TIERS = ((70, "excellent"), (50, "good"), (30, "fair"))


def deal_scores(snapshot: DataFrame, bench: DataFrame, dealers: DataFrame | None = None, *, key: str = "vin17", price: str = "price", list_price: str = "msrp", group: Sequence[str] = ("make", "model"), dealer: str = "customer_id", null_list_points: float = 35.0) -> DataFrame:
    """Active priced keys with a score of 0 to 100 and a tier.

    A null or zero list price gives null_list_points: 35 is what the models compute, as least() passes
    over nulls; 0 is what a reader would expect. The price percentile is taken among all priced keys.
    """
    priced = snapshot.filter(F.col(price) > 0)
    ranked = percent_rank(priced, group, price, "__pctl")
    depth = snapshot.filter((F.col("current_state") == "active") & F.col(dealer).isNotNull()).groupBy(dealer, *group).agg(F.count("*").alias("dealer_inventory_count"))
    v = ranked.filter(F.col("current_state") == "active").join(bench, list(group), "left").join(depth, [dealer, *group], "left")
    if dealers is not None:
        v = v.join(dealers, dealer, "left")
    p, m = F.col(price).cast("double"), F.col(list_price).cast("double")
    off = F.when(m > 0, (m - p) / m)
    share = lambda c, most: F.least(F.coalesce(F.col(c), F.lit(0)), F.lit(most)) / F.lit(float(most))
    discount = F.when(m.isNull() | (m == 0), F.lit(null_list_points)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(35.0), (m - p) / m * 350)))
    points = discount + (1 - F.coalesce("__pctl", F.lit(0.75))) * 30 + share("days_on_market", 90) * 15 + share("price_drop_count", 3) * 10 + share("dealer_inventory_count", 10) * 5 + share("national_listing_count", 500) * 5
    out = v.withColumn("deal_score", F.round(points.cast("decimal(18,3)"), 1).cast("double"))
    tier = F.lit("weak")
    for least, name in reversed(TIERS):
        tier = F.when(F.col("deal_score") >= least, name).otherwise(tier)
    first = F.col("first_price").cast("double")
    out = out.withColumn("msrp_discount_pct", F.round(F.when(p > 0, off) * 100, 2)).withColumn("msrp_discount_amt", F.when((m > 0) & (p > 0), F.col(list_price) - F.col(price)))
    out = out.withColumn("total_price_drop_pct", F.round(F.when((first > 0) & (p > 0), (first - p) / first * 100), 2))
    out = out.withColumn("national_price_percentile", F.coalesce("__pctl", F.lit(0.75))).withColumn("dealer_inventory_count", F.coalesce("dealer_inventory_count", F.lit(0)).cast("long"))
    return out.withColumn("deal_tier", tier).drop("__pctl")


def block_rate(events: DataFrame, ts: str = "event_at", kind: str = "event_type", listing: str = "listing_id", attempts: str = "num_of_attempts", new: str = "blocked", again: str = "incremented") -> DataFrame:
    """Block events by hour."""
    rows = events.filter(F.col(kind).isin(new, again))
    return rows.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour")).agg(
        F.count_if(F.col(kind) == new).alias("new_blocks"),
        F.count_if(F.col(kind) == again).alias("repeated_blocks"),
        F.count("*").alias("total_blocks"),
        F.count_distinct(listing).alias("unique_listings"),
        F.max(attempts).alias("max_attempts"),
    )


ATTEMPT_BUCKETS = ((1, 1, "1"), (2, 2, "2"), (3, 4, "3-4"), (5, 10, "5-10"))


def cooldown_cohorts(events: DataFrame, listing: str = "listing_id", ts: str = "event_at", tie: str = "event_id", kind: str = "event_type", attempts: str = "num_of_attempts", cleared: str = "cleared") -> DataFrame:
    """Listings by attempts of their latest event, cleared ones left out; null attempts count as many."""
    last = events.groupBy(listing).agg(X.latest_row([kind, attempts], ts, tie).alias("r"), F.max(ts).alias("last_event_at"))
    rows = last.filter(X.distinct_from(f"r.c_{kind}", F.lit(cleared))).withColumn("attempts_bucket", X.bucket(f"r.c_{attempts}", ATTEMPT_BUCKETS, "11+"))
    return rows.groupBy("attempts_bucket").agg(F.count("*").alias("listing_count"), F.min("last_event_at").alias("oldest_event_at"), F.max("last_event_at").alias("newest_event_at"))


def batch_outcomes(obs: DataFrame, ts: str, source: str, main: str, artifact: str, vin: str, state: str | None = None, unlisted: str = "unlisted") -> DataFrame:
    """Main-source work by day: rows, distinct artifacts and VINs, and how many artifacts gave a VIN."""
    rows = obs.filter(F.col(source) == main).groupBy(F.to_date(ts).alias("day"))
    got = F.count_distinct(F.when(F.col(vin).isNotNull(), F.col(artifact)))
    aggs = [F.count("*").alias("observations"), F.count_distinct(artifact).alias("artifacts"), F.count_distinct(vin).alias("vins"), X.percent(got, F.count_distinct(artifact)).alias("extraction_yield_pct")]
    if state:
        aggs.append(F.count_if(F.col(state) == unlisted).alias("unlisted"))
    return rows.agg(*aggs)


def inventory_coverage(latest: DataFrame, group: Sequence[str], source: str, main: str = "detail") -> DataFrame:
    """By group: keys, those whose latest row is of the main source, the others, and the share."""
    own = F.count_if(F.col(source) == main)
    return latest.groupBy(*group).agg(F.count("*").alias("total_vins"), own.alias("detail_vins"), F.count_if(X.distinct_from(source, F.lit(main))).alias("non_detail_vins"), X.percent(own, F.count("*")).alias("detail_coverage_pct"))


def price_freshness(snapshot: DataFrame, as_of: str, group: Sequence[str], observed: str = "price_observed_at", state: str | None = "current_state") -> DataFrame:
    """Active keys of each group by the calendar age of their price."""
    age = X.day_diff(observed, X.as_of(as_of))
    rows = snapshot.filter(F.col(state) == "active") if state else snapshot
    return rows.groupBy(*group).agg(
        F.count("*").alias("total_vins"),
        F.count_if(age < 1).alias("fresh_lt_1d"),
        F.count_if(age.between(1, 3)).alias("fresh_1_3d"),
        F.count_if(age.between(4, 7)).alias("fresh_4_7d"),
        F.count_if(age.between(8, 14)).alias("fresh_8_14d"),
        F.count_if(age.isNull() | (age > 14)).alias("stale_gt_14d"),
        X.percent(F.count_if(age <= 7), F.count("*")).alias("fresh_lt_7d_pct"),
    )


def scrape_volume(obs: DataFrame, ts: str, source: str, artifact: str, listing: str, valid: Column, main: str = "detail") -> DataFrame:
    """By hour and source: distinct artifacts and listings, rows, valid rows; yield for the main source."""
    good = F.count_if(valid)
    out = obs.groupBy(F.date_trunc("hour", F.col(ts)).alias("hour"), F.col(source).alias("source")).agg(
        F.count_distinct(artifact).alias("artifact_count"), F.count("*").alias("observation_count"), F.count_distinct(listing).alias("unique_listings"), good.alias("valid_vins")
    )
    return volume_facts(out, main)


def volume_facts(out: DataFrame, main: str = "detail") -> DataFrame:
    """The yield of the main source and the key of counts by hour and source."""
    out = out.withColumn("extraction_yield_pct", F.when(F.col("source") == main, X.percent("valid_vins", "observation_count")))
    return out.withColumn("volume_key", F.md5(F.concat_ws("|", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"), "source")))


def staleness(state: DataFrame, as_of: str, *, listing: str = "listing_id", dealer: str = "customer_id", seen: str = "last_seen_at", detailed: str = "last_detail_scraped_at", full_after: str = "7 DAYS", price_after: str = "24 HOURS") -> DataFrame:
    """Age and staleness of every row of the current state; missing details outrank an old price."""
    at = X.as_of(as_of)
    old = F.col(detailed).isNull() | (F.col(detailed) < at - F.expr(f"INTERVAL {full_after}"))
    out = state.withColumn("age_hours", X.hours_between(seen, at)).withColumn("is_full_details_stale", F.col(dealer).isNull() & old)
    out = out.withColumn("is_price_stale", F.col(seen) < at - F.expr(f"INTERVAL {price_after}"))
    return out.withColumn("stale_reason", F.when(F.col("is_full_details_stale"), "dealer_unenriched").when(F.col("is_price_stale"), "price_only").otherwise("not_stale"))


def backoff(cooldown: DataFrame, *, attempts: str = "num_of_attempts", last: str = "last_attempted_at", base_hours: int = 12, blocked_at: int = 5) -> DataFrame:
    """When each may be tried again: base hours doubled with every attempt after the first; blocked at some."""
    wait = (F.pow(F.lit(2.0), F.col(attempts) - 1) * (base_hours * 3600)).cast("long")
    out = cooldown.withColumn("fully_blocked", F.col(attempts) >= blocked_at)
    return out.withColumn("next_eligible_at", F.timestamp_seconds(F.unix_micros(F.col(last).cast("timestamp")) / F.lit(1e6) + wait))


def refresh_queue(stale: DataFrame, cooldown: DataFrame, as_of: str, *, listing: str = "listing_id", vin: str = "vin", dealer: str = "customer_id", seen: str = "last_seen_at", force_hours: float = 36, blocked_at: int = 5) -> DataFrame:
    """The best pool of every stale listing that isn't backing off.

    Pool 1 has one listing a dealer (missing details first, then the longest unseen); the others are in
    pool 2 if unseen for over force_hours, else in pool 3, whose reason ends in -extra. A listing is in
    at most one best pool, so the pools need no union.
    """
    rows = stale.filter(F.col("is_price_stale") | F.col("is_full_details_stale"))
    order = W.partitionBy(F.coalesce(F.col(dealer).cast("string"), F.col(vin).cast("string"))).orderBy(F.when(F.col("is_full_details_stale"), 0).otherwise(1), F.col(seen), F.col(listing))
    rows = rows.withColumn("__n", F.row_number().over(order)).withColumn("priority", F.when(F.col("__n") == 1, 1).when(F.col("age_hours") > force_hours, 2).otherwise(3))
    reason = F.when(F.col("priority") == 1, F.col("stale_reason")).when(F.col("priority") == 2, F.lit("force_stale_36h")).otherwise(F.concat("stale_reason", F.lit("-extra")))
    wait = backoff(cooldown, blocked_at=blocked_at).filter(F.col("fully_blocked") | ~(F.col("next_eligible_at") < X.as_of(as_of)) | F.col("next_eligible_at").isNull())
    return rows.withColumn("stale_reason", reason).join(wait.select(listing), listing, "left_anti").select(listing, vin, dealer, "stale_reason", "priority")


def pools(*frames: DataFrame) -> DataFrame:
    """Several priority pools in one frame, first pool first in `priority`."""
    out = None
    for k, f in enumerate(frames, 1):
        f = f.withColumn("priority", F.lit(k))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def claim_batch(queue: DataFrame, running: DataFrame, key: str, priority: str, n: int) -> DataFrame:
    """The next n by priority and key that aren't running."""
    return queue.join(running.select(key).distinct(), key, "left_anti").orderBy(priority, key).limit(n)


def hourly_join(volume: DataFrame, blocks: DataFrame, hour: str = "hour", count: str = "observation_count", blocked: str = "total_blocks") -> DataFrame:
    """Volume by hour with the hour's blocks, 0 where there were none, and their share to 3 places."""
    v = volume.groupBy(hour).agg(F.sum(count).alias("observations"))
    out = v.join(blocks.groupBy(hour).agg(F.sum(blocked).alias("blocks")), hour, "left").withColumn("blocks", F.coalesce("blocks", F.lit(0)))
    return out.withColumn("block_rate_pct", X.percent("blocks", F.col("blocks") + F.col("observations"), 3))
