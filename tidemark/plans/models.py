"""Queries: staging, domain models, current state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators import marts, runs, staging, state
from tidemark.plans import bindings as B
from tidemark.plans.registry import EVENTS_END, ORDERS_END, SHIP_END, query
from tidemark.sources.scratch import written

# staging


@query("stg_clean_key", "SELECT doc_id, CASE WHEN length(md5(text)[1:17]) = 17 AND regexp_full_match(upper(md5(text)[1:17]), '[A-Z0-9]{17}') AND doc_id % 3 <> 0 THEN upper(md5(text)[1:17]) END AS vin17 FROM documents")
def stg_clean_key(t):
    vin = F.when(F.col("doc_id") % 3 == 0, F.lit("not a key")).otherwise(F.substring(F.md5("text"), 1, 17))
    return staging.observations(t.documents.withColumn("vin", vin), renames={}).select("doc_id", "vin17")


@query("stg_observations", B.with_sql(B.OBS) + "SELECT artifact_id, vin17, source AS event_source, fetched_at, price AS model_price FROM obs")
def stg_observations(t):
    return staging.project(B.observations(t), {"artifact_id": "artifact_id", "vin17": "vin17", "event_source": "source", "fetched_at": "fetched_at", "model_price": "price"})


@query("stg_price_events", "SELECT CAST(user_id AS VARCHAR) AS user_id, event_id, event_type, value FROM events WHERE user_id IS NOT NULL AND event_type <> 'signup' AND value > 0")
def stg_price_events(t):
    return staging.price_events(t.events, "user_id", "value", "event_type", "signup").select("user_id", "event_id", "event_type", "value")


@query("stg_cooldown_events", B.with_sql(B.COOLDOWN) + "SELECT event_id, listing_id, event_type, num_of_attempts, event_at FROM cool")
def stg_cooldown_events(t):
    return staging.cooldown_events(B.cooldown_log(t))


@query("stg_search_configs", "SELECT event_id, json_extract_string(props, '$.k') AS first_make, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS radius FROM events")
def stg_search_configs(t):
    return staging.search_configs(t.events, "props", {"radius": "$.k"}, {"first_make": "$.k"}).select("event_id", "first_make", "radius")


@query("stg_dealers", B.with_sql(B.SALES) + "SELECT customer_id, arg_max(listing_state, (ts, tie)) AS last_state, arg_max(price, (ts, tie)) AS last_price FROM sales GROUP BY customer_id")
def stg_dealers(t):
    return B.staged_dealers(t)


# models

LATEST = "latest AS (SELECT * FROM obs WHERE vin17 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY vin17 ORDER BY CASE source WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 3 END, fetched_at DESC, artifact_id DESC) = 1)"


def latest(t):
    return runs.latest_observation(B.observations(t), "vin17", "source", B.PRIORITY, "fetched_at", "artifact_id")


@query("m1_active_make_models", "SELECT DISTINCT p_brand, p_type FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')")
def m1(t):
    tracked = t.part.withColumnRenamed("p_partkey", "search_key")
    configs = t.lineitem.select(F.col("l_partkey").alias("search_key"), (F.col("l_returnflag") == "R").alias("enabled"))
    return marts.active_models(tracked, configs, group=["p_brand", "p_type"])


query("m2_latest_observation", B.with_sql(B.OBS, LATEST) + "SELECT * FROM latest")(latest)


@query("m3_price_history", B.with_sql(B.ORDER_EVENTS, B.history_sql("oe")) + "SELECT * FROM history")
def m3(t):
    return runs.price_history(B.order_events(t), "vin", "price", "ts", "tie")


STATUS_EVENTS = "oe AS (SELECT o_orderstatus AS vin, CAST(round(o_totalprice * 100) AS BIGINT) AS price, o_orderdate AS ts, o_orderkey AS tie FROM orders)"


@query("m3_hot_history", B.with_sql(STATUS_EVENTS, B.history_sql("oe")) + "SELECT * FROM history")
def m3_hot(t):
    """Three keys have all rows; they are split over tasks."""
    rows = t.orders.select(F.col("o_orderstatus").alias("vin"), B.cents("o_totalprice").alias("price"), F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("tie"))
    return runs.price_history(rows, "vin", "price", "ts", "tie", spread=True)


@query("m4_benchmarks", B.sales_with(B.BENCH) + "SELECT * REPLACE (CAST(national_avg_discount_pct AS DOUBLE) AS national_avg_discount_pct) FROM bench")
def m4(t):
    return B.part_benchmarks(t).withColumn("national_avg_discount_pct", F.col("national_avg_discount_pct").cast("double"))


FP = "md5(concat_ws('|', coalesce(CAST(vin17 AS VARCHAR), ''), coalesce(source, ''), coalesce(CAST(price AS VARCHAR), ''), coalesce(CAST(k AS VARCHAR), '')))"
FIELDS = ["vin17", "source", "price", "k"]


@query("m5_state_fingerprints", B.with_sql(B.OBS) + f"SELECT artifact_id, fetched_at, {FP} AS fingerprint, vin17, source FROM obs WHERE source = 'purchase' AND vin17 IS NOT NULL QUALIFY row_number() OVER (PARTITION BY artifact_id ORDER BY fetched_at DESC, fingerprint DESC) = 1")
def m5(t):
    rows = B.observations(t).filter("source = 'purchase' and vin17 is not null")
    return runs.fingerprints(rows, ["artifact_id"], FIELDS, ["fetched_at"], ["vin17", "source"])


@query("m6_observation_fingerprints", B.with_sql(B.OBS) + f"SELECT md5(concat_ws('|', CAST(vin17 AS VARCHAR), CAST(listing_id AS VARCHAR))) AS observation_id, vin17, listing_id, fetched_at, artifact_id, {FP} AS fingerprint, price FROM obs QUALIFY row_number() OVER (PARTITION BY vin17, listing_id ORDER BY fetched_at DESC, artifact_id DESC, fingerprint DESC) = 1")
def m6(t):
    return runs.fingerprints(B.observations(t), ["vin17", "listing_id"], FIELDS, ["fetched_at", "artifact_id"], ["price"], ids=["vin17", "listing_id"])


def runs_sql(source: str, entity: str, order: str, states: list[str], select: str, name: str = "runs") -> str:
    same = " OR ".join(f"{s} IS DISTINCT FROM lag({s}) OVER w" for s in states)
    hours = lambda a, b: f"datediff('hour', date_trunc('hour', {a}), date_trunc('hour', {b}))"
    r = [f"{name}{k}" for k in range(4)]
    return f"""{r[0]} AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR {same} THEN 1 ELSE 0 END AS new FROM {source} WINDOW w AS (PARTITION BY {entity} ORDER BY {order})),
{r[1]} AS (SELECT *, sum(new) OVER (PARTITION BY {entity} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM {r[0]}),
{r[2]} AS (SELECT {entity}, run, {select} FROM {r[1]} GROUP BY {entity}, run),
{r[3]} AS (SELECT *, lead(run_started_at) OVER (PARTITION BY {entity} ORDER BY run) AS next_run_started_at FROM {r[2]}),
{name} AS (SELECT * EXCLUDE (run), {hours("run_started_at", "run_ended_at")} AS run_duration_hours, {hours("run_started_at", "next_run_started_at")} AS hours_until_change, next_run_started_at IS NULL AS is_open_run FROM {r[3]})"""


@query("m7_state_runs", B.with_sql(B.ORDER_EVENTS, runs_sql("oe", "vin", "ts, tie", ["state"], "min(ts) AS run_started_at, max(ts) AS run_ended_at, count(*) AS n_observations, any_value(state) AS state, arg_min(queue, (ts, tie)) AS queue")) + "SELECT * FROM runs")
def m7(t):
    return runs.runs(B.order_events(t), "vin", ["ts", "tie"], "state", first=["queue"])


TYPED = "typed AS (SELECT event_type, ts, event_id, CASE WHEN value > 20 THEN 'high' ELSE 'low' END AS state FROM events)"


@query("m7_hot_runs", B.with_sql(TYPED, runs_sql("typed", "event_type", "ts, event_id", ["state"], "min(ts) AS run_started_at, max(ts) AS run_ended_at, count(*) AS n_observations, any_value(state) AS state")) + "SELECT * FROM runs")
def m7_hot(t):
    """Runs of a few entities that have all rows between them."""
    rows = t.events.select("event_type", "ts", "event_id", F.when(F.col("value") > 20, "high").otherwise("low").alias("state"))
    return runs.runs(rows, "event_type", ["ts", "event_id"], "state", spread=True)


OBS_RUNS = runs_sql("obs2", "vin17", "fetched_at, artifact_id", ["state"], "min(fetched_at) AS run_started_at, max(fetched_at) AS run_ended_at, count(*) AS n_observations, any_value(state) AS state, max(listing_id) AS listing_id, "
    "count(*) FILTER (source = 'purchase') AS n_purchase, bool_or(source = 'purchase') AS purchase_seen, count(*) FILTER (source = 'click') AS n_click, bool_or(source = 'click') AS click_seen, count(DISTINCT artifact_id) AS artifacts")  # fmt: skip


def two_states(t):
    return B.observations(t).withColumn("state", F.when(F.col("price") > 2000, "high").otherwise("low"))


OBS2 = "obs2 AS (SELECT *, CASE WHEN price > 2000 THEN 'high' ELSE 'low' END AS state FROM obs)"


@query("m8_observation_runs", B.with_sql(B.OBS, OBS2, OBS_RUNS) + "SELECT * FROM runs")
def m8(t):
    return runs.runs(two_states(t), "vin17", ["fetched_at", "artifact_id"], "state", sources={"purchase": F.col("source") == "purchase", "click": F.col("source") == "click"}, distinct={"artifacts": "artifact_id"}, any_of=["listing_id"])


M9_AT = "2000-06-30 00:00:00"
RUN = "min(ts) AS run_started_at, max(ts) AS run_ended_at, count(*) AS n_observations, any_value(listing_state) AS listing_state"
M9 = B.with_sql(
    B.SALES, B.PARTS, f"seen AS (SELECT vin, vin AS vin17, vin AS listing_id, ts, tie, price, customer_id, listing_state, source, make, model FROM sales JOIN parts ON vin17 = vin WHERE ts <= TIMESTAMP '{M9_AT}')",
    B.history_sql("seen"), B.BENCH, "det AS (SELECT * FROM seen WHERE source = 'detail')",
    runs_sql("det", "vin17", "ts, tie", ["listing_state"], RUN, "own"),
    runs_sql("seen", "listing_id", "ts, tie", ["listing_state"], RUN + ", count(*) FILTER (source = 'detail') AS n_detail, count(*) FILTER (source = 'srp') AS n_srp, bool_or(source = 'srp') AS srp_seen", "alls"),
    "meta AS (SELECT vin17 AS mv, arg_max(customer_id, (ts, tie)) AS customer_id, any_value(make) AS make, any_value(model) AS model FROM det GROUP BY 1)",
    "rm AS (SELECT * FROM own LEFT JOIN meta ON mv = vin17)",
    "vs AS (SELECT vin17 AS k1, count(*) - 1 AS total_state_changes, min(run_started_at) AS first_seen_at, max(run_ended_at) AS latest_fetched_at FROM rm GROUP BY 1)",
    "tr AS (SELECT vin17 AS k8, count(*) FILTER (listing_state <> before) AS turned FROM (SELECT *, lag(listing_state) OVER (PARTITION BY vin17 ORDER BY run_started_at, md5(listing_state)) AS before FROM rm) GROUP BY 1)",
    "ch AS (SELECT vin AS k2, count(*) FILTER (d7 AND m) AS c7, count(*) FILTER (d30 AND m) AS c30 FROM (SELECT vin, prev IS NOT NULL AND price <> prev AS m, ts >= TIMESTAMP '" + M9_AT + "' - INTERVAL 7 DAY AS d7, ts >= TIMESTAMP '" + M9_AT + "' - INTERVAL 30 DAY AS d30 FROM history_lag) GROUP BY 1)",
    "ds AS (SELECT customer_id AS k3, avg(run_duration_hours) AS da, median(run_duration_hours) AS dm FROM rm WHERE NOT is_open_run AND customer_id IS NOT NULL GROUP BY 1)",
    "mm AS (SELECT make AS k4, model AS k5, avg(run_duration_hours) AS ma, median(run_duration_hours) AS md FROM rm WHERE NOT is_open_run GROUP BY 1, 2)",
    "sl AS (SELECT listing_id AS k6, max(ts) AS recent FROM seen WHERE source = 'srp' GROUP BY 1)",
    "oa AS (SELECT listing_id AS k7, run_started_at AS rs, n_observations AS n, n_detail, n_srp, srp_seen FROM alls WHERE is_open_run)",
)
DAYS = f"TIMESTAMP '{M9_AT}'"
M9 += f"""SELECT rm.vin17, rm.vin17 AS listing_id, latest_fetched_at, vs.first_seen_at, total_state_changes, 1 AS listing_id_change_count, datediff('day', run_started_at, {DAYS}) AS days_since_last_state_change, rm.n_observations AS unchanged_observation_streak,
  coalesce(turned, 0) AS listing_state_change_count, current_price, coalesce(c7, 0) AS price_change_count_7d, coalesce(c30, 0) AS price_change_count_30d, CASE WHEN national_median_price > 0 THEN CAST(current_price AS DOUBLE) / national_median_price END AS price_vs_make_model_median,
  datediff('day', vs.first_seen_at, {DAYS}) AS listing_days_on_market, da AS dealer_avg_run_length_hours, dm AS dealer_median_run_length_hours, ma AS make_model_avg_run_length_hours, md AS make_model_median_run_length_hours, recent AS recent_srp_seen_at, datediff('day', recent, {DAYS}) AS days_since_srp_seen,
  rs AS all_source_run_started_at, datediff('day', rs, {DAYS}) AS days_since_last_all_source_change, coalesce(oa.n, 0) AS all_source_n_observations, coalesce(n_detail, 0) AS all_source_n_detail, coalesce(n_srp, 0) AS all_source_n_srp, coalesce(srp_seen, false) AS all_source_non_detail_refresh_seen
FROM rm JOIN vs ON k1 = rm.vin17 LEFT JOIN tr ON k8 = rm.vin17 LEFT JOIN ch ON k2 = rm.vin17 LEFT JOIN history h ON h.vin = rm.vin17 LEFT JOIN bench b ON b.make = rm.make AND b.model = rm.model LEFT JOIN ds ON k3 = customer_id LEFT JOIN mm ON k4 = rm.make AND k5 = rm.model LEFT JOIN sl ON k6 = rm.vin17 LEFT JOIN oa ON k7 = rm.vin17 WHERE is_open_run"""


@query("m9_volatility_features", M9)
def m9(t):
    """Parts as listings: runs of their state, all inputs cut at the instant."""
    at = M9_AT
    obs = marts.cut_at(B.sales(t), "ts", at).withColumnRenamed("vin", "vin17").withColumn("listing_id", F.col("vin17") * 1)
    obs = written(obs.join(B.parts(t).select("vin17", "make", "model"), "vin17").withColumn("fingerprint", X.fingerprint(["listing_state"])), "observations")
    events = obs.select(F.col("vin17").alias("vin"), "price", "ts", "tie")
    history = written(runs.price_history(events, "vin", "price", "ts", "tie", changes=marts.change_starts(at)), "history")
    bench = runs.benchmarks(B.parts(t), history, "vin17", "vin", ["make", "model"], "msrp", "decimal(12,2)")
    state_runs = runs.runs(obs.filter("source = 'detail'"), "vin17", ["ts", "tie"], ["fingerprint", "listing_state"], first=["listing_id"])
    source_runs = runs.runs(obs, "listing_id", ["ts", "tie"], "listing_state", sources={"detail": F.col("source") == "detail", "srp": F.col("source") == "srp"})
    return marts.volatility_features(obs, None, history, bench, state_runs, source_runs, at, ts="ts", tie="tie", event_ts="ts", event_tie="tie")


SNAP_COLUMNS = "vin17, make, model, msrp, customer_id, price, first_price, min_price, max_price, total_price_observations, price_drop_count, price_increase_count, first_seen_at, last_seen_at, current_state, days_on_market"


@query("m10_vehicle_snapshot", B.sales_with(B.SNAPSHOT) + f"SELECT {SNAP_COLUMNS} FROM snapshot")
def m10(t):
    return B.part_snapshot(t).select(*SNAP_COLUMNS.split(", "))


@query("m11_deal_scores", B.sales_with(B.BENCH, B.SNAPSHOT, B.DEALS) + f"SELECT {', '.join(B.DEAL_COLUMNS)} FROM deals")
def m11(t):
    return B.part_deals(t).select(*B.DEAL_COLUMNS)


BLOCKS = "blocks AS (SELECT date_trunc('hour', event_at) AS hour, count(*) FILTER (event_type = 'blocked') AS new_blocks, count(*) FILTER (event_type = 'incremented') AS repeated_blocks, count(*) AS total_blocks, count(DISTINCT listing_id) AS unique_listings, max(num_of_attempts) AS max_attempts FROM cool WHERE event_type IN ('blocked', 'incremented') GROUP BY 1)"


@query("m12_block_rate", B.with_sql(B.COOLDOWN, BLOCKS) + "SELECT * FROM blocks")
def m12(t):
    return marts.block_rate(B.cooldown_log(t))


COHORTS = """cohorts AS (SELECT CASE WHEN a = 1 THEN '1' WHEN a = 2 THEN '2' WHEN a BETWEEN 3 AND 4 THEN '3-4' WHEN a BETWEEN 5 AND 10 THEN '5-10' ELSE '11+' END AS attempts_bucket, count(*) AS listing_count, min(t) AS oldest_event_at, max(t) AS newest_event_at
  FROM (SELECT listing_id, arg_max(event_type, (event_at, event_id)) AS e, arg_max(num_of_attempts, (event_at, event_id)) AS a, max(event_at) AS t FROM cool GROUP BY 1) WHERE e IS DISTINCT FROM 'cleared' GROUP BY 1)"""


@query("m13_cooldown_cohorts", B.with_sql(B.COOLDOWN, COHORTS) + "SELECT * FROM cohorts")
def m13(t):
    return marts.cooldown_cohorts(B.cooldown_log(t))


OUTCOMES = "SELECT CAST(fetched_at AS DATE) AS day, count(*) AS observations, count(DISTINCT artifact_id) AS artifacts, count(DISTINCT vin17) AS vins, round(count(DISTINCT CASE WHEN vin17 % 7 <> 0 THEN artifact_id END) * 100.0 / count(DISTINCT artifact_id), 1) AS extraction_yield_pct, count(*) FILTER (k > 50) AS unlisted FROM (SELECT * REPLACE (CASE WHEN vin17 % 7 <> 0 THEN vin17 END AS vin17) FROM obs) WHERE source = 'purchase' GROUP BY 1"


def batch(t):
    obs = B.observations(t).withColumn("vin17", F.when(F.col("vin17") % 7 != 0, F.col("vin17"))).withColumn("s", F.when(F.col("k") > 50, "unlisted").otherwise("active"))
    return marts.batch_outcomes(obs, "fetched_at", "source", "purchase", "artifact_id", "vin17", "s")


query("m14_batch_outcomes", B.with_sql(B.OBS) + OUTCOMES)(batch)

COVER = "cover AS (SELECT vin17 % 10 AS grp, count(*) AS total_vins, count(*) FILTER (source = 'purchase') AS detail_vins, count(*) FILTER (source IS DISTINCT FROM 'purchase') AS non_detail_vins, round(count(*) FILTER (source = 'purchase') * 100.0 / count(*), 1) AS detail_coverage_pct FROM newest_rows GROUP BY 1)"
NEWEST = "newest_rows AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY vin17 ORDER BY fetched_at DESC, artifact_id DESC) = 1)"


def cover(t):
    rows = runs.top_per_key(B.observations(t), "vin17", runs.desc(["fetched_at", "artifact_id"])).withColumn("grp", F.col("vin17") % 10)
    return marts.inventory_coverage(rows, ["grp"], "source", "purchase")


query("m15_inventory_coverage", B.with_sql(B.OBS, NEWEST, COVER) + "SELECT * FROM cover")(cover)

FRESH = f"""fresh AS (SELECT make, count(*) AS total_vins, count(*) FILTER (a < 1) AS fresh_lt_1d, count(*) FILTER (a BETWEEN 1 AND 3) AS fresh_1_3d, count(*) FILTER (a BETWEEN 4 AND 7) AS fresh_4_7d, count(*) FILTER (a BETWEEN 8 AND 14) AS fresh_8_14d,
  count(*) FILTER (a IS NULL OR a > 14) AS stale_gt_14d, round(count(*) FILTER (a <= 7) * 100.0 / count(*), 1) AS fresh_lt_7d_pct FROM (SELECT *, datediff('day', price_observed_at, TIMESTAMP '{SHIP_END}') AS a FROM snapshot WHERE current_state = 'active') GROUP BY make)"""


def fresh(t):
    return marts.price_freshness(B.part_snapshot(t), SHIP_END, ["make"])


query("m16_price_freshness", B.sales_with(B.SNAPSHOT, FRESH) + "SELECT * FROM fresh")(fresh)

VOLUME = """v0 AS (SELECT date_trunc('hour', fetched_at) AS hour, source, count(DISTINCT artifact_id) AS artifact_count, count(*) AS observation_count, count(DISTINCT listing_id) AS unique_listings, count(*) FILTER (k > 10) AS valid_vins FROM obs GROUP BY 1, 2),
volume AS (SELECT *, CASE WHEN source = 'purchase' THEN round(valid_vins * 100.0 / nullif(observation_count, 0), 1) END AS extraction_yield_pct, md5(strftime(hour, '%Y-%m-%d %H:%M:%S') || '|' || source) AS volume_key FROM v0)"""


def volume(t):
    return marts.scrape_volume(B.observations(t), "fetched_at", "source", "artifact_id", "listing_id", F.col("k") > 10, "purchase")


query("m17_scrape_volume", B.with_sql(B.OBS, VOLUME) + "SELECT * FROM volume")(volume)

# current state

STATE = """st AS (SELECT vin17 AS listing_id, max(fetched_at) AS last_seen_at, arg_max(artifact_id, (fetched_at, artifact_id)) AS artifact_id, arg_max(price, (fetched_at, artifact_id)) AS price,
  max(vin17 % 20) FILTER (k > 60) AS customer_id, max(fetched_at) FILTER (source = 'purchase') AS last_detail_scraped_at, vin17 AS vin FROM obs GROUP BY vin17)"""


def current(t):
    rows = B.observations(t).select(F.col("vin17").alias("listing_id"), F.col("vin17").alias("vin"), F.col("fetched_at").alias("last_seen_at"), "artifact_id", "price", F.when(F.col("k") > 60, F.col("vin17") % 20).alias("customer_id"), F.when(F.col("source") == "purchase", F.col("fetched_at")).alias("last_detail_scraped_at"))
    return state.fold(rows, "listing_id", ["last_seen_at", "artifact_id"], ["price"], ["vin", "customer_id", "last_detail_scraped_at"])


query("cs1_price_state", B.with_sql(B.OBS, STATE) + "SELECT listing_id, last_seen_at, artifact_id, price, vin, customer_id, last_detail_scraped_at FROM st")(current)

AT = "2024-01-30 18:00:00"
STALE = f"""stale AS (SELECT *, epoch(TIMESTAMP '{AT}' - last_seen_at) / 3600.0 AS age_hours, (customer_id IS NULL AND (last_detail_scraped_at IS NULL OR last_detail_scraped_at < TIMESTAMP '{AT}' - INTERVAL 2 DAY)) AS is_full_details_stale,
  last_seen_at < TIMESTAMP '{AT}' - INTERVAL 4 HOUR AS is_price_stale, CASE WHEN customer_id IS NULL AND (last_detail_scraped_at IS NULL OR last_detail_scraped_at < TIMESTAMP '{AT}' - INTERVAL 2 DAY) THEN 'dealer_unenriched' WHEN last_seen_at < TIMESTAMP '{AT}' - INTERVAL 4 HOUR THEN 'price_only' ELSE 'not_stale' END AS stale_reason FROM st2)"""
ST2 = "st2 AS (SELECT * REPLACE (CASE WHEN listing_id % 3 <> 0 THEN customer_id END AS customer_id) FROM st)"


def stale(t):
    rows = current(t).withColumn("customer_id", F.when(F.col("listing_id") % 3 != 0, F.col("customer_id")))
    return marts.staleness(rows, AT, full_after="2 DAYS", price_after="4 HOURS")


@query("m18_vehicle_staleness", B.with_sql(B.OBS, STATE, ST2, STALE) + "SELECT listing_id, round(age_hours, 6) AS age_hours, is_full_details_stale, is_price_stale, stale_reason FROM stale")
def m18(t):
    return stale(t).select("listing_id", F.round("age_hours", 6).alias("age_hours"), "is_full_details_stale", "is_price_stale", "stale_reason")


COUNTER = """c0 AS (SELECT *, event_type = 'cleared' AS clr, count(*) FILTER (event_type = 'cleared') OVER (PARTITION BY listing_id ORDER BY event_at, event_id) AS lf FROM cool),
c1 AS (SELECT listing_id, lf, min(event_at) FILTER (NOT clr) AS first_attempted_at, max(event_at) FILTER (NOT clr) AS last_attempted_at, count(*) FILTER (NOT clr) AS num_of_attempts FROM c0 GROUP BY 1, 2),
attempts AS (SELECT * EXCLUDE (lf) FROM c1 QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY lf DESC) = 1),
blocked AS (SELECT * FROM attempts WHERE num_of_attempts > 0)"""


def blocked(t):
    return state.attempt_counter(B.cooldown_log(t), "listing_id", "event_at", "event_id", F.col("event_type") == "cleared")


query("cs5_cooldown_counter", B.with_sql(B.COOLDOWN, COUNTER) + "SELECT * FROM blocked")(blocked)


@query("m19_refresh_queue", B.with_sql(B.OBS, STATE, ST2, STALE, B.COOLDOWN, COUNTER) + f"""
, q AS (SELECT *, row_number() OVER (PARTITION BY coalesce(CAST(customer_id AS VARCHAR), CAST(vin AS VARCHAR)) ORDER BY CASE WHEN is_full_details_stale THEN 0 ELSE 1 END, last_seen_at, listing_id) AS n FROM stale WHERE is_price_stale OR is_full_details_stale),
p AS (SELECT listing_id, vin, customer_id, stale_reason, 1 AS priority FROM q WHERE n = 1 UNION ALL SELECT listing_id, vin, customer_id, 'force_stale_36h', 2 FROM q WHERE age_hours > 12 AND n > 1 UNION ALL SELECT listing_id, vin, customer_id, stale_reason || '-extra', 3 FROM q WHERE n > 1)
SELECT p.* FROM p LEFT JOIN blocked b USING (listing_id) WHERE b.listing_id IS NULL OR (b.num_of_attempts < 3 AND b.last_attempted_at + INTERVAL 1 HOUR * CAST(12 * power(2, b.num_of_attempts - 1) AS INT) < TIMESTAMP '{AT}')
QUALIFY row_number() OVER (PARTITION BY p.listing_id ORDER BY priority) = 1""")  # fmt: skip
def m19(t):
    return marts.refresh_queue(stale(t), blocked(t), AT, force_hours=12, blocked_at=3)


@query("m20_backoff", B.with_sql(B.COOLDOWN, COUNTER) + "SELECT listing_id, num_of_attempts, num_of_attempts >= 3 AS fully_blocked, last_attempted_at + INTERVAL 1 HOUR * CAST(12 * power(2, num_of_attempts - 1) AS INT) AS next_eligible_at FROM blocked")
def m20(t):
    return marts.backoff(blocked(t), blocked_at=3).select("listing_id", "num_of_attempts", "fully_blocked", "next_eligible_at")


@query("m21_claim_batch", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) ORDER BY o_orderpriority, o_orderkey LIMIT 100")
def m21(t):
    running = t.orders.join(t.customer.filter("c_acctbal < 0"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")
    return marts.claim_batch(t.orders.select("o_orderkey", "o_orderpriority"), running, "o_orderkey", "o_orderpriority", 100)


@query("cs2_present", B.with_sql(B.ORDER_EVENTS) + "SELECT vin, max(ts) AS ts, arg_max(tie, (ts, tie)) AS tie, arg_max(price, (ts, tie)) AS price FROM oe o WHERE (ts, tie) > coalesce((SELECT max((ts, tie)) FROM oe d WHERE d.vin = o.vin AND d.state = 'P'), (TIMESTAMP '1900-01-01', -1::BIGINT)) GROUP BY vin")
def cs2(t):
    return state.fold(B.order_events(t), "vin", ["ts", "tie"], ["price"], deleted=F.col("state") == "P")


@query("cs3_newest_mapping", B.with_sql(B.SALES) + "SELECT vin, arg_min(customer_id, customer_id) AS customer_id, any_value(ts) AS ts FROM sales s WHERE ts = (SELECT max(ts) FROM sales x WHERE x.vin = s.vin) GROUP BY vin")
def cs3(t):
    return state.newest_mapping(B.sales(t), "vin", "customer_id", "ts")


@query("cs4_relistings", B.with_sql(B.SALES) + "SELECT vin, customer_id, ts, CASE WHEN p IS NULL THEN 'mapped' ELSE 'remapped' END AS event_type, p AS previous FROM (SELECT *, lag(customer_id) OVER (PARTITION BY vin ORDER BY ts, tie) AS p FROM sales) WHERE p IS NULL OR p <> customer_id")
def cs4(t):
    return state.relistings(B.sales(t), "vin", "customer_id", "ts", "tie")


@query("cs6_newly_present", "SELECT DISTINCT lower(p_brand) AS p_brand, lower(p_type) AS p_type, 'added' AS event_type FROM part WHERE (lower(p_brand), lower(p_type)) NOT IN (SELECT lower(p_brand), lower(p_type) FROM part WHERE p_partkey < 100)")
def cs6(t):
    low = t.part.filter("p_partkey < 100").select(F.lower("p_brand").alias("p_brand"), F.lower("p_type").alias("p_type"))
    return state.newly_present(t.part, low.distinct(), ["p_brand", "p_type"])


@query("cs7_resolved_keys", "SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(CASE WHEN l_linenumber > 2 THEN l_partkey END, p_partkey) AS l_partkey FROM lineitem LEFT JOIN (SELECT l_suppkey AS k, max(l_partkey) AS p_partkey FROM lineitem GROUP BY 1) ON k = l_suppkey")
def cs7(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.when(F.col("l_linenumber") > 2, F.col("l_partkey")).alias("l_partkey"))
    mapping = t.lineitem.groupBy("l_suppkey").agg(F.max("l_partkey").alias("l_partkey"))
    return state.resolve(rows, mapping, "l_suppkey", "l_partkey")


@query("cs8_evicted_cooldowns", B.with_sql(B.COOLDOWN, COUNTER) + f"SELECT listing_id, 'cleared' AS event_type, TIMESTAMP '{EVENTS_END}' AS event_at FROM blocked WHERE listing_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-30')")
def cs8(t):
    alive = t.events.filter("event_type = 'purchase' and ts >= timestamp'2024-01-30'").select(F.col("user_id").alias("listing_id"))
    return state.clearing_events(blocked(t), "listing_id", EVENTS_END, alive)


@query("cs9_reconciled", B.with_sql(B.COOLDOWN) + f"SELECT listing_id, 'cleared' AS event_type, TIMESTAMP '{EVENTS_END}' AS event_at FROM (SELECT listing_id, arg_max(event_type, (event_at, event_id)) AS e FROM cool GROUP BY 1) WHERE e IN ('blocked', 'incremented') AND listing_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-30') AND listing_id NOT IN (SELECT user_id FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-30')")
def cs9(t):
    of = lambda kind: t.events.filter((F.col("event_type") == kind) & (F.col("ts") >= F.lit("2024-01-30").cast("timestamp"))).select(F.col("user_id").alias("listing_id"))
    return state.clearing_events(state.open_cooldowns(B.cooldown_log(t), "listing_id", "event_at", "event_id", "event_type"), "listing_id", EVENTS_END, of("purchase"), of("click"))


@query("cs10_stuck_work", f"SELECT o_orderkey, coalesce(m, o_orderdate) AS working_since FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS m FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P' AND coalesce(m, o_orderdate) < TIMESTAMP '{ORDERS_END}' - INTERVAL 700 DAY")
def cs10(t):
    queue = t.orders.withColumnRenamed("o_orderkey", "k")
    events = t.lineitem.select(F.col("l_orderkey").alias("k"), "l_shipdate", F.when(F.col("l_linestatus") == "O", "P").alias("status"))
    return state.stuck(queue, events, "k", "o_orderstatus", "o_orderdate", "l_shipdate", "status", ORDERS_END, working="P", after="700 DAYS").select(F.col("k").alias("o_orderkey"), "working_since")


@query("cs11_cleanup_candidates", f"SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '{ORDERS_END}' - INTERVAL 1000 DAY) ORDER BY o_orderdate, o_orderkey LIMIT 500")
def cs11(t):
    return state.cleanup_candidates(t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate"), "o_orderkey", "o_orderstatus", "o_orderdate", ORDERS_END, 500, ("F",), "P", "1000 DAYS")


@query("cs11_expired_claims", f"SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '{ORDERS_END}' - INTERVAL 2000 DAY")
def cs11b(t):
    return state.expired(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", ORDERS_END, "2000 DAYS").select("o_orderkey")


@query("cs12_fanned_out", "SELECT o_orderkey, CAST(NULL AS INT) AS l_linenumber, o_custkey FROM orders UNION ALL SELECT l_orderkey, l_linenumber, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_linenumber > 1")
def cs12(t):
    nested = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_linenumber") > 1, F.col("l_linenumber")).alias("l_linenumber"))).alias("more"))
    pages = t.orders.join(nested, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.struct("o_orderkey", F.lit(None).cast("int").alias("l_linenumber"), "o_custkey").alias("primary"), "more")
    return state.fan_out(pages, "primary", "more", ["o_custkey"], ["l_linenumber"])


@query("cs13_backlog", "SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS first_in_flight, (SELECT count(*) FROM lineitem WHERE l_linestatus = 'O') AS second_in_flight, least((SELECT min(o_orderdate) FROM orders WHERE o_orderstatus = 'P'), (SELECT min(l_shipdate) FROM lineitem WHERE l_linestatus = 'O')) AS oldest_started_at")
def cs13(t):
    return state.backlog(t.orders.filter("o_orderstatus = 'P'"), t.lineitem.filter("l_linestatus = 'O'"), "o_orderdate", "l_shipdate")
