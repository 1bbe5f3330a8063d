"""The given tables in the roles of the models' inputs, with the same roles as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import exprs as X
from tidemark.operators import marts, runs, staging
from tidemark.plans.registry import SHIP_END, Tables
from tidemark.sources.scratch import written

PRIORITY = ("purchase", "click")


def cents(c: str):
    return F.round(F.col(c) * 100).cast("long")


def order_events(t: Tables) -> DataFrame:
    """Orders as price events of customers."""
    return t.orders.select(F.col("o_custkey").alias("vin"), cents("o_totalprice").alias("price"), F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("tie"), F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("queue"))


ORDER_EVENTS = "oe AS (SELECT o_custkey AS vin, CAST(round(o_totalprice * 100) AS BIGINT) AS price, o_orderdate AS ts, o_orderkey AS tie, o_orderstatus AS state, o_orderpriority AS queue FROM orders)"


def sales(t: Tables) -> DataFrame:
    """Line items as price events of parts, one row for each order line and supplier."""
    li = t.lineitem
    tie = (F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100000 + F.col("l_suppkey")
    unit = F.round(F.col("l_extendedprice") / F.col("l_quantity") * 100).cast("long")
    gone, side = F.coalesce(F.col("l_linestatus") != "O", F.lit(True)), F.coalesce(F.col("l_returnflag") != "N", F.lit(True))
    rows = li.select(F.col("l_partkey").alias("vin"), F.col("l_shipdate").alias("ts"), tie.alias("tie"), unit.alias("price"), F.col("l_suppkey").alias("customer_id"), gone.alias("gone"), side.alias("side"))
    # the greatest of two words is a flag's maximum: buffers of fixed width are hashed, strings would be sorted
    rows = rows.groupBy("vin", "ts", "tie").agg(*[F.max(c).alias(c) for c in ("price", "customer_id", "gone", "side")])
    return rows.select("vin", "ts", "tie", "price", "customer_id", F.when(F.col("gone"), "unlisted").otherwise("active").alias("listing_state"), F.when(F.col("side"), "srp").otherwise("detail").alias("source"))


SALES = """sales AS (SELECT l_partkey AS vin, l_shipdate AS ts, (l_orderkey * 10 + l_linenumber) * 100000 + l_suppkey AS tie,
  max(CAST(round(l_extendedprice / l_quantity * 100) AS BIGINT)) AS price, max(l_suppkey) AS customer_id,
  max(CASE WHEN l_linestatus = 'O' THEN 'active' ELSE 'unlisted' END) AS listing_state, max(CASE WHEN l_returnflag = 'N' THEN 'detail' ELSE 'srp' END) AS source
  FROM lineitem GROUP BY 1, 2, 3)"""


def history_sql(source: str, name: str = "history") -> str:
    return f"""{name}_lag AS (SELECT *, lag(price) OVER (PARTITION BY vin ORDER BY ts, tie) AS prev FROM {source}),
{name} AS (SELECT vin, arg_max(price, (ts, tie)) AS current_price, max(ts) AS price_observed_at, arg_min(price, (ts, tie)) AS first_price, min(price) AS min_price, max(price) AS max_price,
  count(*) AS total_price_observations, count(*) FILTER (price < prev) AS price_drop_count, count(*) FILTER (price > prev) AS price_increase_count, min(ts) AS first_seen_at, max(ts) AS last_seen_at
  FROM {name}_lag GROUP BY vin)"""


def sales_history(t: Tables) -> DataFrame:
    return runs.price_history(sales(t), "vin", "price", "ts", "tie")


def parts(t: Tables) -> DataFrame:
    """Parts as the latest observation of each key."""
    return t.part.select(F.col("p_partkey").alias("vin17"), F.col("p_brand").alias("make"), F.col("p_type").alias("model"), cents("p_retailprice").alias("msrp"))


PARTS = "parts AS (SELECT p_partkey AS vin17, p_brand AS make, p_type AS model, CAST(round(p_retailprice * 100) AS BIGINT) AS msrp FROM part)"


def part_benchmarks(t: Tables) -> DataFrame:
    return runs.benchmarks(parts(t), sales_history(t), "vin17", "vin", ["make", "model"], "msrp", "decimal(12,2)")


BENCH = """bench AS (SELECT make, model, count(*) AS national_listing_count, CAST(round_even(avg(current_price), 0) AS INT) AS national_avg_price,
  CAST(round_even(round(quantile_cont(CAST(current_price AS DOUBLE), 0.1), 6), 0) AS INT) AS national_p10_price, CAST(round_even(round(quantile_cont(CAST(current_price AS DOUBLE), 0.25), 6), 0) AS INT) AS national_p25_price,
  CAST(round_even(round(quantile_cont(CAST(current_price AS DOUBLE), 0.5), 6), 0) AS INT) AS national_median_price, CAST(round_even(round(quantile_cont(CAST(current_price AS DOUBLE), 0.75), 6), 0) AS INT) AS national_p75_price,
  CAST(round_even(round(quantile_cont(CAST(current_price AS DOUBLE), 0.9), 6), 0) AS INT) AS national_p90_price,
  CAST(avg(CASE WHEN msrp > 0 THEN CAST(msrp - current_price AS DOUBLE) / msrp * 100 END) AS DECIMAL(12, 2)) AS national_avg_discount_pct
  FROM parts JOIN history ON vin17 = vin WHERE current_price > 0 GROUP BY make, model)"""


def part_snapshot(t: Tables) -> DataFrame:
    """Parts with prices, state and dealer, all models being active: one scan of the line items."""
    h = runs.price_history(sales(t), "vin", "price", "ts", "tie", newest=["listing_state", "source", "customer_id"])
    h = h.withColumnsRenamed({"newest_listing_state": "newest_state", "newest_customer_id": "customer_id"})
    return marts.vehicle_snapshot(parts(t), h, None, None, SHIP_END, fresh="90 DAYS")


SNAPSHOT = f"""newest AS (SELECT vin AS nv, arg_max(listing_state, (ts, tie)) AS ns, arg_max(source, (ts, tie)) AS nsrc, arg_max(customer_id, (ts, tie)) AS customer_id FROM sales GROUP BY vin),
snapshot AS (SELECT vin17, make, model, msrp, customer_id, current_price AS price, price_observed_at, first_price, min_price, max_price, total_price_observations, price_drop_count, price_increase_count, first_seen_at, last_seen_at,
  coalesce(CASE WHEN nsrc = 'detail' THEN ns END, CASE WHEN last_seen_at >= TIMESTAMP '{SHIP_END}' - INTERVAL 90 DAY THEN 'active' ELSE 'unlisted' END) AS current_state,
  datediff('day', first_seen_at, TIMESTAMP '{SHIP_END}') AS days_on_market
  FROM parts LEFT JOIN history ON vin17 = vin LEFT JOIN newest ON vin17 = nv)"""


def dealer_names(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").alias("customer_id"), F.col("s_name").alias("dealer_name"))


def part_deals(t: Tables) -> DataFrame:
    snapshot = written(part_snapshot(t), "snapshot")
    history = snapshot.select(F.col("vin17").alias("vin"), F.col("price").alias("current_price"))
    bench = runs.benchmarks(parts(t), history, "vin17", "vin", ["make", "model"], "msrp", "decimal(12,2)")
    return marts.deal_scores(snapshot, bench, dealer_names(t))


DEALS = """ranked AS (SELECT *, percent_rank() OVER (PARTITION BY make, model ORDER BY price) AS pctl FROM snapshot WHERE price > 0),
depth AS (SELECT customer_id, make, model, count(*) AS n FROM snapshot WHERE current_state = 'active' AND customer_id IS NOT NULL GROUP BY ALL),
scored AS (SELECT r.vin17, r.make, r.model, r.msrp, r.customer_id, s.s_name AS dealer_name, r.price, r.first_price, r.price_drop_count, r.days_on_market, r.first_seen_at, r.pctl AS national_price_percentile,
  coalesce(d.n, 0) AS dealer_inventory_count, b.national_listing_count, b.national_median_price,
  CAST(round(CAST(CASE WHEN r.msrp IS NULL OR r.msrp = 0 THEN 35 ELSE greatest(0, least(35, CAST(r.msrp - r.price AS DOUBLE) / r.msrp * 350)) END + (1 - r.pctl) * 30
    + CAST(least(coalesce(r.days_on_market, 0), 90) AS DOUBLE) / 90 * 15 + CAST(least(coalesce(r.price_drop_count, 0), 3) AS DOUBLE) / 3 * 10
    + CAST(least(coalesce(d.n, 0), 10) AS DOUBLE) / 10 * 5 + CAST(least(coalesce(b.national_listing_count, 0), 500) AS DOUBLE) / 500 * 5 AS DECIMAL(18, 3)), 1) AS DOUBLE) AS deal_score
  FROM ranked r LEFT JOIN bench b ON b.make = r.make AND b.model = r.model LEFT JOIN depth d ON d.customer_id = r.customer_id AND d.make = r.make AND d.model = r.model
  LEFT JOIN supplier s ON s.s_suppkey = r.customer_id WHERE r.current_state = 'active'),
deals AS (SELECT *, CASE WHEN deal_score >= 70 THEN 'excellent' WHEN deal_score >= 50 THEN 'good' WHEN deal_score >= 30 THEN 'fair' ELSE 'weak' END AS deal_tier FROM scored)"""

DEAL_COLUMNS = ["vin17", "make", "model", "msrp", "customer_id", "dealer_name", "price", "first_price", "price_drop_count", "days_on_market", "national_price_percentile", "dealer_inventory_count", "national_listing_count", "deal_score", "deal_tier"]


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def sales_with(*more: str) -> str:
    """The chain of relations that the part models need, in order."""
    return with_sql(SALES, history_sql("sales"), PARTS, *more)


def observations(t: Tables) -> DataFrame:
    """Events as observations of users."""
    return t.events.select(F.col("event_id").alias("artifact_id"), F.col("user_id").alias("vin17"), (F.col("user_id") * 10 + F.col("event_id") % 2).alias("listing_id"), F.col("event_type").alias("source"), F.col("ts").alias("fetched_at"), cents("value").alias("price"), X.json_text("props", "$.k").try_cast("int").alias("k"))


OBS = "obs AS (SELECT event_id AS artifact_id, user_id AS vin17, user_id * 10 + event_id % 2 AS listing_id, event_type AS source, ts AS fetched_at, CAST(round(value * 100) AS BIGINT) AS price, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)"


def cooldown_log(t: Tables) -> DataFrame:
    """Errors as block events with a running attempt count, signups as clearing events."""
    w = F.col("event_type").isin("error", "signup")
    rows = t.events.filter(w).select("event_id", F.col("user_id").alias("listing_id"), F.col("ts").alias("event_at"), "event_type")
    order = W.partitionBy("listing_id").orderBy("event_at", "event_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    bad = F.col("event_type") == "error"
    rows = rows.withColumn("life", F.count_if(~bad).over(order))
    within = W.partitionBy("listing_id", "life").orderBy("event_at", "event_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("n", F.count_if(bad).over(within).cast("int"))
    return rows.select("event_id", "listing_id", "event_at", F.when(~bad, "cleared").when(F.col("n") == 1, "blocked").otherwise("incremented").alias("event_type"), F.col("n").alias("num_of_attempts"))


COOLDOWN = """cl0 AS (SELECT event_id, user_id AS listing_id, ts AS event_at, event_type, count(*) FILTER (event_type = 'signup') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS life FROM events WHERE event_type IN ('error', 'signup')),
cl1 AS (SELECT *, CAST(count(*) FILTER (event_type = 'error') OVER (PARTITION BY listing_id, life ORDER BY event_at, event_id) AS INT) AS n FROM cl0),
cool AS (SELECT event_id, listing_id, event_at, CASE WHEN event_type = 'signup' THEN 'cleared' WHEN n = 1 THEN 'blocked' ELSE 'incremented' END AS event_type, n AS num_of_attempts FROM cl1)"""


def staged_dealers(t: Tables) -> DataFrame:
    return staging.dealers(sales(t), "customer_id", {"last_state": "listing_state", "last_price": "price"}, "ts", "tie")
