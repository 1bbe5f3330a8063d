"""Queries: joins and predicates, selectors and cohorts, incremental maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators import audits, incremental, marts, runs, selectors, staging
from tidemark.plans import bindings as B
from tidemark.plans import models as M
from tidemark.plans.registry import EVENTS_END, query
from tidemark.sources import indexed, readers
from tidemark.sources.scratch import dealt, new_table

# sources, predicates, joins


@query("src5_bounded_scan", "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'")
def src5(t):
    return readers.between(t.events, "ts", "2024-01-10", "2024-01-12").select("event_id", "ts")


@query("src6_lookback_scan", "SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-12' - INTERVAL 2 DAY AND TIMESTAMP '2024-01-12'")
def src6(t):
    return readers.lookback(t.events, "ts", "2024-01-12", "2 DAYS").select("event_id")


@query("src7_pages", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def src7(t):
    return t.pages.select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


@query("prd1_null_safe", B.with_sql(B.OBS) + "SELECT artifact_id FROM obs WHERE CASE WHEN k % 5 <> 0 THEN source END IS DISTINCT FROM 'click'")
def prd1(t):
    return B.observations(t).filter(X.distinct_from(F.when(F.col("k") % 5 != 0, F.col("source")), F.lit("click"))).select("artifact_id")


@query("prd2_key_match", "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND CASE WHEN c_acctbal > 5000 THEN 'F' END IS NOT DISTINCT FROM CASE WHEN o_orderstatus = 'F' THEN 'F' END)")
def prd2(t):
    o = t.orders.select("o_orderkey", F.col("o_custkey").alias("c"), F.when(F.col("o_orderstatus") == "F", "F").alias("s"))
    k = t.customer.select(F.col("c_custkey").alias("c"), F.when(F.col("c_acctbal") > 5000, "F").alias("s"))
    return staging.key_match(o, k, ["c", "s"]).select("o_orderkey")


@query("prd3_among", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def prd3(t):
    return staging.among(t.orders, "o_custkey", t.customer.filter("c_mktsegment = 'MACHINERY'").select("c_custkey")).select("o_orderkey")


@query("prd4_optional_filters", "SELECT p_partkey FROM part WHERE p_brand IN ('Brand#2', 'Brand#7')")
def prd4(t):
    return staging.optional_filters(t.part, p_brand=["Brand#2", "Brand#7"], p_type=None).select("p_partkey")


@query("prd5_ilike", "SELECT p_partkey FROM part WHERE p_name ILIKE '%RED%'")
def prd5(t):
    return staging.ilike(t.part, "p_name", "%RED%").select("p_partkey")


@query("prd6_buckets", "SELECT CASE WHEN l_quantity BETWEEN 1 AND 5 THEN '1-5' WHEN l_quantity BETWEEN 6 AND 20 THEN '6-20' ELSE '21+' END AS b, count(*) AS n FROM lineitem GROUP BY 1")
def prd6(t):
    return t.lineitem.groupBy(X.bucket("l_quantity", ((1, 5, "1-5"), (6, 20, "6-20")), "21+").alias("b")).agg(F.count("*").alias("n"))


@query("prd7_since", f"SELECT event_id FROM events WHERE ts >= TIMESTAMP '{EVENTS_END}' - INTERVAL 7 DAY")
def prd7(t):
    return staging.since(t.events, "ts", EVENTS_END, "7 DAYS").select("event_id")


@query("jn3_dimension_chain", "SELECT o_orderkey, c_mktsegment, n_name, r_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def jn3(t):
    o = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return o.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select("o_orderkey", "c_mktsegment", "n_name", "r_name")


@query("jn6_anti", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def jn6(t):
    return t.customer.join(t.orders.filter("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("jn9_followed_by", "SELECT DISTINCT a.o_custkey FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey AND b.o_orderdate > a.o_orderdate WHERE a.o_orderstatus = 'F' AND b.o_orderstatus = 'P'")
def jn9(t):
    return staging.followed_by(t.orders, "o_custkey", "o_orderdate", F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P").select("o_custkey")


@query("jn10_prefix_match", "SELECT DISTINCT p.p_partkey FROM part p JOIN (SELECT DISTINCT p_brand, split_part(p_name, ' ', 1) AS w FROM part) x ON x.p_brand = p.p_brand AND (p.p_name = x.w OR starts_with(p.p_name, x.w || ' '))")
def jn10(t):
    x = t.part.select(F.col("p_brand").alias("b"), F.split("p_name", " ")[0].alias("w"))
    return staging.prefix_match(t.part, x, "p_brand", "p_name", "b", "w").select("p_partkey").distinct()


@query("jn11_elsewhere", "SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL AND l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1)")
def jn11(t):
    li = dealt(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), "l_partkey")
    return staging.elsewhere(li, li, "l_partkey", "l_suppkey").distinct()


@query("jn12_latest_event", "SELECT o_orderkey, coalesce((SELECT max(l_shipdate) FROM lineitem WHERE l_orderkey = o_orderkey), o_orderdate) AS last_event_at FROM orders")
def jn12(t):
    events = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    return staging.with_latest_event(t.orders, events, "o_orderkey", "l_shipdate", "o_orderdate").select("o_orderkey", "last_event_at")


@query("jn13_difference", "SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'")
def jn13(t):
    of = lambda where: t.orders.filter(where).select("o_custkey")
    return staging.difference(of("o_orderstatus = 'F'"), of("o_orderstatus = 'P'"), of("o_orderpriority = '5-LOW'"))


HOURLY = "hv AS (SELECT hour, sum(observation_count) AS observations FROM volume GROUP BY 1), joined AS (SELECT hv.hour, CAST(observations AS BIGINT) AS observations, coalesce(total_blocks, 0) AS blocks, round(coalesce(total_blocks, 0) * 100.0 / nullif(coalesce(total_blocks, 0) + observations, 0), 3) AS block_rate_pct FROM hv LEFT JOIN blocks ON blocks.hour = hv.hour)"


@query("jn14_hourly_join", B.with_sql(B.OBS, M.VOLUME, B.COOLDOWN, M.BLOCKS, HOURLY) + "SELECT * FROM joined")
def jn14(t):
    return marts.hourly_join(M.volume(t), M.m12(t))


@query("so2_set_operations", "SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P' UNION SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'")
def so2(t):
    return staging.union_keys(t.orders.filter("o_orderstatus = 'P'").select("o_custkey"), t.orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey"))


@query("so1_pools", "SELECT o_orderkey, 1 AS priority FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT o_orderkey, 2 FROM orders WHERE o_orderstatus = 'F'")
def so1(t):
    return marts.pools(t.orders.filter("o_orderstatus = 'P'").select("o_orderkey"), t.orders.filter("o_orderstatus = 'F'").select("o_orderkey"))


@query("sl6_hash_order", "SELECT c_custkey, c_name FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 50")
def sl6(t):
    return staging.hash_order(t.customer, "c_custkey", 50).select("c_custkey", "c_name")


@query("sl7_page", "SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey OFFSET 100 LIMIT 25")
def sl7(t):
    return staging.page_of(t.customer, [F.desc("c_acctbal"), "c_custkey"], 100, 25).select("c_custkey")


@query("sl8_systematic_sample", "SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem QUALIFY (row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_suppkey) - 1) % 10 = 0")
def sl8(t):
    columns = ["l_orderkey", "l_linenumber", "l_suppkey"]
    return staging.every_nth(t.lineitem.select(*columns), columns, 10)


@query("wn10_novelty", "SELECT user_id, d AS step, n AS new, avg(n) OVER w AS avg_new, count(n) OVER w = 5 AND avg(n) OVER w < 2.0 AS should_stop FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2) WINDOW w AS (PARTITION BY user_id ORDER BY d ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")
def wn10(t):
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("step")).agg(F.count("*").alias("new"))
    return runs.novelty(daily, "user_id", "step", "new", least=2.0)


@query("wn11_top_per_group", "SELECT p_brand, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) <= 5")
def wn11(t):
    return runs.top_per_key(t.part, "p_brand", [F.desc("p_retailprice"), F.col("p_partkey")], 5).select("p_brand", "p_partkey")


# selectors

FPK = "md5(concat_ws('|', coalesce(source, ''), coalesce(CAST(k % 3 AS VARCHAR), '')))"


def steps(t, changed):
    rows = B.observations(t).withColumn("k3", F.col("k") % 3)
    return selectors.state_steps(rows, "vin17", ["fetched_at", "artifact_id"], ["source", "k3"], changed).select("vin17", "artifact_id", "fetched_at", "fingerprint")


def step_sql(op: str) -> str:
    return B.with_sql(B.OBS) + f"SELECT vin17, artifact_id, fetched_at, f AS fingerprint FROM (SELECT *, {FPK} AS f, lag({FPK}) OVER (PARTITION BY vin17 ORDER BY fetched_at, artifact_id) AS p FROM obs) WHERE f {op} p"


query("se1_stable_state", step_sql("="))(lambda t: steps(t, False))
query("se2_state_change", step_sql("<>"))(lambda t: steps(t, True))


@query("se3_relisted", B.with_sql(B.SALES) + "SELECT vin, count(DISTINCT customer_id) AS places FROM sales WHERE vin IS NOT NULL GROUP BY vin HAVING count(DISTINCT customer_id) > 1")
def se3(t):
    return selectors.relisted(B.sales(t), "vin", "customer_id")


@query("se4_active_to_unlisted", B.with_sql(B.SALES) + "SELECT vin, min(ts) FILTER (listing_state = 'active') AS first_before, max(ts) FILTER (listing_state = 'unlisted') AS last_after FROM sales GROUP BY vin HAVING max(ts) FILTER (listing_state = 'unlisted') > min(ts) FILTER (listing_state = 'active')")
def se4(t):
    return selectors.active_to_unlisted(B.sales(t), "vin", "ts", "listing_state")


STEPS = "steps AS (SELECT * FROM (SELECT vin, tie, ts, price, lag(price) OVER (PARTITION BY vin ORDER BY ts, tie) AS prev_price FROM oe WHERE price IS NOT NULL) WHERE price <> prev_price)"


def price_steps(t, up):
    return selectors.price_steps(B.order_events(t), "vin", "price", "ts", "tie", up).select("vin", "tie", "ts", "price", "prev_price")


query("se5_price_drop", B.with_sql(B.ORDER_EVENTS, STEPS) + "SELECT * FROM steps WHERE price < prev_price")(lambda t: price_steps(t, False))
query("se6_price_increase", B.with_sql(B.ORDER_EVENTS, STEPS) + "SELECT * FROM steps WHERE price > prev_price")(lambda t: price_steps(t, True))


@query("se7_price_changed_7d", B.with_sql(B.ORDER_EVENTS, STEPS) + "SELECT vin, tie, ts FROM steps WHERE ts >= (SELECT max(ts) FROM oe WHERE price IS NOT NULL) - INTERVAL 7 DAY")
def se7(t):
    return selectors.price_changed(B.order_events(t), "vin", "price", "ts", "tie").select("vin", "tie", "ts")


@query("se8_price_changed_30d_only", B.with_sql(B.ORDER_EVENTS, STEPS) + "SELECT vin, tie, ts FROM steps WHERE ts >= (SELECT max(ts) FROM oe WHERE price IS NOT NULL) - INTERVAL 30 DAY AND ts < (SELECT max(ts) FROM oe WHERE price IS NOT NULL) - INTERVAL 7 DAY")
def se8(t):
    return selectors.price_changed(B.order_events(t), "vin", "price", "ts", "tie", only_older_than=7, days=30).select("vin", "tie", "ts")


@query("se9_no_price_history", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def se9(t):
    return selectors.without_history(t.customer, t.orders.filter("o_totalprice > 450000"), "c_custkey", "o_custkey", "o_totalprice")


def best_sql(condition: str) -> str:
    """Rows with a make are usable; sources and the best row are taken from them alone."""
    return f"""usable AS (SELECT * FROM obs WHERE make IS NOT NULL),
vin_sources AS (SELECT vin17, bool_or(source = 'purchase') AS has_purchase, bool_or(source = 'click') AS has_click FROM usable GROUP BY vin17),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vin17 ORDER BY CASE source WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 3 END, fetched_at DESC, artifact_id DESC) AS rn FROM usable)
SELECT r.vin17, r.artifact_id, r.source, r.fetched_at FROM ranked r JOIN vin_sources v USING (vin17) WHERE r.rn = 1 AND {condition}"""


def best(rows, **kw):
    return selectors.best_source(rows, "vin17", "source", B.PRIORITY, "fetched_at", "artifact_id", required="make", **kw)


def made(t, rows):
    """Observations with the make that their page shows: the rest of rows whose k is small show none."""
    return rows.withColumn("make", F.when(F.col("k") > 10, F.concat(F.lit("make "), F.col("k").cast("string"))))


def by_day(t):
    """Observations keyed by user and day: over all events each user has a purchase."""
    return B.observations(t).withColumn("vin17", F.concat_ws(" ", "vin17", F.to_date("fetched_at")))


MADE = "obs AS (SELECT * {replace}, CASE WHEN k > 10 THEN 'make ' || k END AS make FROM obs0)"
BY_DAY = MADE.format(replace="REPLACE (vin17 || ' ' || CAST(CAST(fetched_at AS DATE) AS VARCHAR) AS vin17)")
OBS0 = B.OBS.replace("obs AS", "obs0 AS", 1)
query("se10_detail_beats_srp", B.with_sql(OBS0, MADE.format(replace="")).rstrip() + ", " + best_sql("r.source = 'purchase' AND v.has_purchase AND v.has_click"))(lambda t: best(made(t, B.observations(t)), wanted="purchase", also="click"))
query("se11_srp_fallback", B.with_sql(OBS0, BY_DAY).rstrip() + ", " + best_sql("r.source = 'click' AND NOT v.has_purchase"))(lambda t: best(made(t, by_day(t)), wanted="click", never="purchase"))
query("se12_seen_by", B.with_sql(B.OBS) + "SELECT DISTINCT vin17 FROM obs WHERE source = 'signup'")(lambda t: selectors.seen_by(B.observations(t), "vin17", "source", "signup"))


@query("se13_invalid_key", "SELECT doc_id FROM documents WHERE text IS NULL OR NOT (length(left(text, 17)) = 17 AND regexp_full_match(upper(left(text, 17)), '[A-Z0-9]{17}'))")
def se13(t):
    return selectors.invalid_key(t.documents.withColumn("v", F.substring("text", 1, 17)), "v").select("doc_id")


query("se14_dense_groups", "SELECT p_brand, p_type, count(*) AS row_count FROM part GROUP BY 1, 2 HAVING count(*) >= 15")(lambda t: selectors.density(t.part, ["p_brand", "p_type"], least=15))
query("se15_sparse_groups", "SELECT p_brand, p_type, count(*) AS row_count FROM part GROUP BY 1, 2 HAVING count(*) BETWEEN 1 AND 12")(lambda t: selectors.density(t.part, ["p_brand", "p_type"], least=1, most=12))
for number, low, high in ((16, 1, 1), (17, 2, None), (18, 3, 4), (19, 5, 10), (20, 11, None)):
    query(f"se{number}_cooldown_{low}_{high or 'up'}", B.with_sql(B.COOLDOWN) + f"SELECT * FROM cool WHERE num_of_attempts >= {low}" + (f" AND num_of_attempts <= {high}" if high else ""))(lambda t, low=low, high=high: selectors.attempts_between(B.cooldown_log(t), "num_of_attempts", low, high))


@query("se21_fresh_recent", "WITH a AS (SELECT o_custkey, min(o_orderdate) AS first_seen_at, max(o_orderdate) AS last_seen_at FROM orders GROUP BY 1) SELECT *, (SELECT max(last_seen_at) FROM a) AS window_anchor FROM a WHERE (SELECT max(last_seen_at) FROM a) - first_seen_at <= INTERVAL 2300 DAY AND (SELECT max(last_seen_at) FROM a) - last_seen_at <= INTERVAL 90 DAY")
def se21(t):
    return selectors.fresh_recent(t.orders, "o_custkey", "o_orderdate", first_within=2300, last_within=90)


@query("se22_stale", "SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS o_orderkey, f AS first_seen_at, max(o_orderdate) AS last_seen_at, any_value(w) AS window_end FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS l, min(o_orderdate) OVER (PARTITION BY o_custkey) AS f, max(o_orderdate) OVER () AS w FROM orders) WHERE o_orderdate = l AND w - l >= INTERVAL 300 DAY GROUP BY o_custkey, f")
def se22(t):
    return selectors.stale(t.orders, "o_custkey", "o_orderdate", "o_orderkey", [], days=300)


# cohorts


@query("co1_candidates", "SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > 45 ORDER BY 1 LIMIT 100")
def co1(t):
    return selectors.candidates(t.lineitem.filter("l_quantity > 45"), "l_partkey", 100)


@query("co2_allocation", "WITH p AS (SELECT o_custkey FROM orders WHERE o_totalprice > 495000 UNION SELECT o_custkey FROM orders WHERE o_totalprice < 2000) SELECT o_custkey FROM (SELECT o_custkey, 0 AS s, '' AS m FROM p UNION ALL SELECT DISTINCT o_custkey, 1, md5(CAST(o_custkey AS VARCHAR)) FROM orders WHERE o_custkey NOT IN (SELECT * FROM p)) ORDER BY s, m, o_custkey LIMIT 800")
def co2(t):
    of = lambda where: t.orders.filter(where).select("o_custkey")
    return selectors.allocate([of("o_totalprice > 495000"), of("o_totalprice < 2000")], t.orders, "o_custkey", 800)


@query("co3_seeds", "SELECT p_brand, p_partkey FROM part WHERE p_brand IN (SELECT p_brand FROM part GROUP BY 1 HAVING count(*) >= 80) QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) <= 50")
def co3(t):
    return selectors.seeds(t.part, selectors.density(t.part, ["p_brand"], least=80), ["p_brand"], [F.col("p_partkey")]).select("p_brand", "p_partkey")


#: Customers stand for VINs, order days for listings; an order in parts maps its customer and day to the day a year before.
EDGES = """pairs AS (SELECT DISTINCT o_custkey AS vin, CAST(o_orderdate AS DATE) AS listing FROM orders), remaps AS (SELECT DISTINCT o_custkey AS vin, CAST(o_orderdate AS DATE) AS listing, CAST(o_orderdate AS DATE) - 364 AS previous FROM orders WHERE o_orderstatus = 'P'),
edges AS (SELECT 'vin' AS fk, CAST(vin AS VARCHAR) AS f, 'listing' AS tk, CAST(listing AS VARCHAR) AS t FROM pairs UNION ALL SELECT 'listing', CAST(listing AS VARCHAR), 'vin', CAST(vin AS VARCHAR) FROM pairs
  UNION ALL SELECT 'vin', CAST(vin AS VARCHAR), 'listing', CAST(previous AS VARCHAR) FROM remaps UNION ALL SELECT 'listing', CAST(listing AS VARCHAR), 'listing', CAST(previous AS VARCHAR) FROM remaps),
core(kind, id) AS (SELECT 'vin', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < -900 UNION SELECT 'listing', CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders WHERE o_totalprice > 499000 UNION SELECT e.tk, e.t FROM core JOIN edges e ON e.fk = core.kind AND e.f = core.id)
"""


def entities(t):
    """The closed core of EDGES, to the fixpoint."""
    day = F.col("o_orderdate").cast("date")
    pairs = t.orders.select(F.col("o_custkey").alias("vin"), day.alias("listing")).distinct()
    remaps = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("vin"), day.alias("from"), F.date_sub(day, 364).alias("to")).distinct()
    steps = [[("vin", "listing", pairs)], [("listing", "vin", pairs)], [("vin", "listing", remaps.select("vin", F.col("to").alias("listing"))), ("listing", "listing", remaps.select("from", "to"))]]
    seeds = {"vin": t.customer.filter("c_acctbal < -900").select(F.col("c_custkey").alias("vin")), "listing": t.orders.filter("o_totalprice > 499000").select(day.alias("listing"))}
    return selectors.entity_closure(steps, seeds, None)


@query("co4_closure", f"WITH RECURSIVE {EDGES} SELECT kind, id FROM core")
def co4(t):
    """VINs and listings, from seeds of both kinds, over links and previous listings."""
    found = entities(t)
    return found["vin"].select(F.lit("vin").alias("kind"), F.col("vin").cast("string").alias("id")).union(found["listing"].select(F.lit("listing"), F.col("listing").cast("string")))


@query("co4_artifacts", f"WITH RECURSIVE {EDGES} SELECT o_orderkey FROM orders WHERE o_totalprice > 490000 OR (o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-04-01' AND (CAST(o_custkey AS VARCHAR) IN (SELECT id FROM core WHERE kind = 'vin') OR CAST(CAST(o_orderdate AS DATE) AS VARCHAR) IN (SELECT id FROM core WHERE kind = 'listing')))")
def co4_artifacts(t):
    """Orders of the closed core in one quarter, and the dearest of any time; they lead no further."""
    rows = t.orders.select("o_orderkey", "o_orderdate", F.col("o_custkey").alias("vin"), F.col("o_orderdate").cast("date").alias("listing"))
    return selectors.attached([(rows, "o_orderdate")], entities(t), "o_orderkey", "1995-01-01", "1995-04-01", t.orders.filter("o_totalprice > 490000"))


@query("co5_membership", "SELECT DISTINCT o_orderkey, o_custkey FROM orders WHERE (o_custkey < 50 AND o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01') OR o_orderkey % 1000 = 7")
def co5(t):
    members = t.customer.filter("c_custkey < 50").select(F.col("c_custkey").alias("o_custkey"))
    exact = t.orders.filter("o_orderkey % 1000 = 7").select("o_orderkey")
    return selectors.membership(t.orders, None, members, "o_orderdate", "1998-01-01", "1999-01-01", listing="o_custkey", exact=exact, exact_on=["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("co6_source_audit", "SELECT 'events' AS table_name, count(*) AS rows, min(ts) AS min_ts, max(ts) AS max_ts, count(DISTINCT user_id) AS vins, count(DISTINCT event_type) AS listings FROM events UNION ALL SELECT 'orders', count(*), min(o_orderdate), max(o_orderdate), count(DISTINCT o_custkey), NULL FROM orders")
def co6(t):
    return selectors.source_audit({"events": (t.events, "ts", "user_id", "event_type"), "orders": (t.orders, "o_orderdate", "o_custkey", None)})


SELECTED = [
    selectors.Selector("relisted", "vin", lambda x: selectors.relisted(x["sales"], "vin", "customer_id"), 20),
    selectors.Selector("price_drop", "vin", lambda x: selectors.price_steps(x["sales"], "vin", "price", "ts", "tie", False), 20),
    selectors.Selector("never", "vin", lambda x: x["sales"].filter("price < 0"), 1),
]


def found(t):
    return selectors.summary(SELECTED, {"sales": B.sales(t)})


FOUND = """rel AS (SELECT vin FROM sales GROUP BY vin HAVING count(DISTINCT customer_id) > 1), dr AS (SELECT vin FROM (SELECT vin, price, lag(price) OVER (PARTITION BY vin ORDER BY ts, tie) AS p FROM sales) WHERE price < p),
found AS (SELECT 'relisted' AS selector, (SELECT count(*) FROM rel) AS candidate_rows, (SELECT count(DISTINCT vin) FROM rel) AS distinct_entities, 20 AS minimum UNION ALL SELECT 'price_drop', (SELECT count(*) FROM dr), (SELECT count(DISTINCT vin) FROM dr), 20 UNION ALL SELECT 'never', 0, 0, 1)"""


@query("co0_selector_summary", B.with_sql(B.SALES, FOUND) + "SELECT selector, candidate_rows, distinct_entities, distinct_entities >= minimum AS passed FROM found")
def co0(t):
    return found(t).drop("sample")


@query("co7_coverage", B.with_sql(B.SALES, FOUND) + "SELECT selector, minimum, distinct_entities AS found, distinct_entities >= minimum AS covered FROM found")
def co7(t):
    required = found(t).select("selector", F.when(F.col("selector") == "never", 1).otherwise(20).alias("minimum"))
    return selectors.coverage(found(t), required)


@query("co8_relative_window", "SELECT CAST(date_trunc('week', o_orderdate) - INTERVAL 3 MONTH AS TIMESTAMP) AS start_at, CAST(date_trunc('week', o_orderdate) AS TIMESTAMP) AS end_at, count(*) AS n FROM orders GROUP BY 1, 2")
def co8(t):
    start, end = selectors.relative_window(F.col("o_orderdate"), 3)
    return t.orders.groupBy(start.alias("start_at"), end.alias("end_at")).agg(F.count("*").alias("n"))


# incremental maintenance: a base build, a second wave, and what a full rebuild gives

CUT = "2024-01-20 00:00:00"


INC1 = B.with_sql(B.OBS) + f"SELECT artifact_id, fetched_at, {M.FP} AS fingerprint FROM obs QUALIFY row_number() OVER (PARTITION BY artifact_id ORDER BY fetched_at DESC, fingerprint DESC) = 1"
INC2 = B.with_sql(B.ORDER_EVENTS, B.history_sql("oe")) + "SELECT * FROM history"
INC3 = B.with_sql(B.ORDER_EVENTS, M.runs_sql("oe", "vin", "ts, tie", ["state"], "min(ts) AS run_started_at, max(ts) AS run_ended_at, count(*) AS n_observations, any_value(state) AS state")) + "SELECT * FROM runs"


@query("inc1_rescan", INC1)
def inc1(t):
    make = lambda rows: runs.fingerprints(rows, ["artifact_id"], M.FIELDS, ["fetched_at"])
    obs = B.observations(t)
    return incremental.rescan(obs, make(readers.between(obs, "fetched_at", end=CUT)), "fetched_at", "3 DAYS", "artifact_id", make)


@query("inc2_affected_history", INC2)
def inc2(t):
    make = lambda rows: runs.price_history(rows, "vin", "price", "ts", "tie")
    oe = B.order_events(t)
    return incremental.affected(oe, make(readers.between(oe, "ts", end="2001-01-01")), "ts", "3 DAYS", "vin", make, "last_seen_at")


@query("inc3_entity_runs", INC3)
def inc3(t):
    make = lambda rows: runs.runs(rows, "vin", ["ts", "tie"], "state")
    oe = B.order_events(t)
    return incremental.affected(oe, make(readers.between(oe, "ts", end="2001-01-01")), "ts", "3 DAYS", "vin", make, "run_ended_at")


# the same on tables at rest: the base is a table with a key index, the second wave one commit


@query("inc1_at_rest", INC1)
def inc1_at_rest(t):
    make = lambda rows: runs.fingerprints(rows, ["artifact_id"], M.FIELDS, ["fetched_at"])
    obs, path = B.observations(t), new_table(t.spark, "fingerprints")
    indexed.create(make(readers.between(obs, "fetched_at", end=CUT)), path, "artifact_id")
    incremental.rescan_at_rest(obs, path, "fetched_at", "3 DAYS", make)
    return indexed.read(t.spark, path)


@query("inc2_at_rest", INC2)
def inc2_at_rest(t):
    make = lambda rows: runs.price_history(rows, "vin", "price", "ts", "tie")
    oe, path = B.order_events(t), new_table(t.spark, "history")
    indexed.create(make(readers.between(oe, "ts", end="2001-01-01")), path, "vin")
    incremental.affected_at_rest(oe, path, "ts", "3 DAYS", "vin", make, "last_seen_at")
    return indexed.read(t.spark, path)


@query("inc3_at_rest", INC3)
def inc3_at_rest(t):
    make = lambda rows: runs.runs(rows, "vin", ["ts", "tie"], "state")
    oe, path = B.order_events(t), new_table(t.spark, "runs")
    indexed.create(make(readers.between(oe, "ts", end="2001-01-01")), path, "vin")
    incremental.affected_at_rest(oe, path, "ts", "3 DAYS", "vin", make, "run_ended_at")
    return indexed.read(t.spark, path)


@query("inc4_time_window", B.with_sql(B.OBS, M.VOLUME) + "SELECT * FROM volume")
def inc4(t):
    make = lambda rows: marts.scrape_volume(rows, "fetched_at", "source", "artifact_id", "listing_id", F.col("k") > 10, "purchase")
    obs = B.observations(t)
    return incremental.time_window(obs, make(readers.between(obs, "fetched_at", end=CUT)), "fetched_at", "hour", "72 HOURS", make, "hour", ["hour", "source"])


# audits


@query("dq1_checks", "SELECT 'not_null' AS check_name, 'c_name' AS column_name, 0 AS failures, true AS passed UNION ALL SELECT 'unique', 'c_nationkey', count(c_nationkey) - count(DISTINCT c_nationkey), false FROM customer UNION ALL SELECT 'accepted_values', 'c_mktsegment', count(*) FILTER (c_mktsegment NOT IN ('MACHINERY', 'HOUSEHOLD')), false FROM customer")
def dq1(t):
    return audits.checks(t.customer, ["c_name"], ["c_nationkey"], {"c_mktsegment": ["MACHINERY", "HOUSEHOLD"]})


@query("dq2_invalid_vins", "SELECT doc_id FROM documents WHERE text IS NULL OR NOT (length(left(text, 17)) = 17 AND regexp_full_match(left(text, 17), '[A-Z0-9]{17}'))")
def dq2(t):
    return audits.invalid_vins(t.documents.withColumn("v", F.substring("text", 1, 17)), "v").select("doc_id")


@query("dq3_invalid_vins_nullable", "SELECT doc_id FROM documents WHERE doc_id % 2 = 0 AND NOT (length(left(text, 17)) = 17 AND regexp_full_match(left(text, 17), '[A-Z0-9]{17}'))")
def dq3(t):
    return audits.invalid_vins(t.documents.withColumn("v", F.when(F.col("doc_id") % 2 == 0, F.substring("text", 1, 17))), "v", nullable=True).select("doc_id")


@query("dq4_table_audit", "SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_grain, count(*) FILTER (n > 1) AS duplicate_groups, 0 AS null_l_suppkey, 0 AS negative_l_tax, min(lo) AS min_ts, max(hi) AS max_ts FROM (SELECT count(*) AS n, min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def dq4(t):
    return audits.table_audit(t.lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_suppkey"], ["l_tax"])


@query("dq5_grain_specs", "SELECT 'orders' AS table_name, count(*) AS rows, count(DISTINCT o_orderkey) AS distinct_grain, 0 AS duplicate_groups, true AS holds FROM orders UNION ALL SELECT 'lineitem', CAST(sum(n) AS BIGINT), count(*), count(*) FILTER (n > 1), count(*) FILTER (n > 1) = 0 FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def dq5(t):
    return audits.grain_specs({"orders": (t.orders, ["o_orderkey"]), "lineitem": (t.lineitem, ["l_orderkey", "l_linenumber"])})


@query("dq6_row_parity", "SELECT c_custkey, CASE WHEN c_custkey % 100 = 7 THEN 'only_a' ELSE 'differs' END AS parity FROM customer WHERE c_custkey % 100 = 7 OR c_custkey % 50 = 3")
def dq6(t):
    b = t.customer.filter("c_custkey % 100 <> 7").withColumn("c_nationkey", F.when(F.col("c_custkey") % 50 == 3, F.lit(None)).otherwise(F.col("c_nationkey")))
    return audits.row_parity(t.customer, b, ["c_custkey"]).select("c_custkey", "parity")


@query("dq6_build_parity")
def dq6b(t):
    return audits.build_parity(t.orders, t.orders.filter("o_orderkey <> 5"), ["o_orderkey"], "o_orderdate")


@query("dq7_ties", "SELECT o_custkey, count(DISTINCT o_totalprice) AS tied_values FROM orders o WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders x WHERE x.o_custkey = o.o_custkey) GROUP BY 1 HAVING count(DISTINCT o_totalprice) > 1")
def dq7(t):
    return audits.ties(t.orders, ["o_custkey"], ["o_orderdate"], "o_totalprice")


@query("dq8_hourly_parity")
def dq8(t):
    return audits.row_parity(M.volume(t), inc4(t), ["hour", "source"]).agg(F.count("*").alias("differences"))


@query("dq9_reconcile", "SELECT coalesce(a.k, b.k) AS event_type, coalesce(x, 0) AS old_rows, coalesce(y, 0) AS new_rows, coalesce(y, 0) - coalesce(x, 0) AS difference FROM (SELECT event_type AS k, count(*) AS x FROM events GROUP BY 1) a FULL JOIN (SELECT event_type AS k, count(*) AS y FROM events WHERE value > 10 GROUP BY 1) b ON a.k = b.k")
def dq9(t):
    return audits.reconcile(t.events, t.events.filter("value > 10"), "event_type")


@query("dq_coverage", "SELECT 'quality' AS column_name, count(quality) AS present, round(count(quality) * 100.0 / count(*), 1) AS coverage_pct FROM documents LEFT JOIN labels USING (doc_id)")
def dq_coverage(t):
    return audits.coverage(t.documents.join(t.labels, "doc_id", "left"), ["quality"])


