"""Queries: single joins, aggregates, windows, sorts and functions; sources, sinks, layout jobs, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from tidemark import schema
from tidemark.functions import exprs as X
from tidemark.operators import marts, ranks, runs, state
from tidemark.plans import bindings as B
from tidemark.plans import models as M
from tidemark.plans.boards import folder
from tidemark.plans.registry import query
from tidemark.sources import layout, readers, sinks
from tidemark.sources.scratch import dealt, written
from tidemark.streaming import streams

# sources and sinks


@query("src1_union_by_name", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, o_custkey, NULL FROM orders WHERE o_orderstatus = 'F'")
def src1(t):
    path = folder(t, "versions")
    t.orders.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_custkey", "o_orderstatus").write.parquet(path)
    t.orders.filter("o_orderstatus = 'F'").select("o_custkey", "o_orderkey").write.mode("append").parquet(path)
    return readers.parquet(t.spark, path, T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())]))


@query("src2_event_log", B.with_sql(B.COOLDOWN) + "SELECT event_id, CAST(listing_id AS VARCHAR) AS listing_id, event_type, num_of_attempts, event_at, year(event_at) AS year, month(event_at) AS month FROM cool")
def src2(t):
    """Written and read back as a registered log under a base folder, with its declared types."""
    base = folder(t, "lake")
    sinks.append_events(B.cooldown_log(t).withColumn("listing_id", F.col("listing_id").cast("string")), schema.resolve("blocked_cooldown_events", base))
    return readers.logical(t.spark, "blocked_cooldown_events", base)


@query("snk1_observation_sink", B.with_sql(B.OBS) + "SELECT artifact_id, source, fetched_at, year(fetched_at) AS obs_year, month(fetched_at) AS obs_month, day(fetched_at) AS obs_day, k AS price FROM obs")
def snk1(t):
    path = folder(t, "observations")
    rows = B.observations(t).select("artifact_id", "source", "fetched_at", F.col("k").cast("string").alias("price"))
    sinks.append_observations(sinks.to_integers(rows, ["price"]), path, now="2024-02-01")
    return readers.parquet(t.spark, path).drop("written_at")


@query("snk4_content_hash")
def snk4b(t):
    return sinks.content_hash(t.lineitem)


@query("snk6_reconstructed", "SELECT l_orderkey * 10 + l_linenumber AS artifact_id, o_orderkey AS listing_id FROM (SELECT l_orderkey, max((l_shipdate, l_linenumber)) AS m FROM lineitem GROUP BY 1) JOIN (SELECT l_orderkey AS k, l_shipdate AS d, l_linenumber FROM lineitem GROUP BY ALL) ON k = l_orderkey AND (d, l_linenumber) = m JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P'")
def snk6(t):
    """Order lines as deletions, orders as mappings and pages; orders in progress are stored already."""
    line = t.lineitem.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("artifact_id"), F.col("l_orderkey").alias("listing_id"), F.col("l_linenumber").alias("event_id"), F.col("l_shipdate").alias("event_at")).distinct()
    price = line.select("*", F.lit("m").alias("make"), F.lit("o").alias("model"), F.lit("deleted").alias("event_type"))
    mapping = t.orders.select(F.col("o_orderkey").alias("listing_id"), F.col("o_custkey").alias("vin"), F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("event_at"))
    queue = line.select("artifact_id", "event_id", "event_at", F.col("event_at").alias("fetched_at"))
    stored = line.join(t.orders.filter("o_orderstatus = 'P'"), F.col("listing_id") == F.col("o_orderkey"), "left_semi").select("artifact_id", "listing_id", F.lit("unlisted").alias("listing_state"))
    return sinks.reconstruct_unlisted(queue, mapping, price, stored).select("artifact_id", "listing_id")


@query("lay1_compaction", "SELECT o_orderkey, year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders")
def lay1(t):
    """All orders, every closed month that is due."""
    path = folder(t, "small-files")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    rows.repartition(4).write.partitionBy("year", "month").parquet(path)
    layout.compact_due(t.spark, path, "year", "month", "2002-01-01", ["o_orderkey"], most=1_000_000)
    return t.spark.read.parquet(path)


@query("lay2_month_rewrite", "SELECT o_orderkey, o_orderdate, year(o_orderdate) AS year, month(o_orderdate) AS month FROM orders")
def lay2(t):
    path = folder(t, "months")
    layout.rewrite_months(t.orders.select("o_orderkey", "o_orderdate"), path, "o_orderdate", ["o_orderkey"])
    return t.spark.read.parquet(f"{path}/table")


@query("lay3_layout_audit", "SELECT 'year=' || year(o_orderdate) || '/' AS partition, 1 AS files, count(*) AS rows, min(o_orderdate) AS min_ts, max(o_orderdate) AS max_ts, true AS expected_path FROM orders GROUP BY year(o_orderdate)")
def lay3(t):
    path = folder(t, "audited")
    t.orders.select("o_orderkey", "o_orderdate", F.year("o_orderdate").alias("year")).repartition("year").write.partitionBy("year").parquet(path)
    return layout.audit(t.spark, path, "o_orderdate").select("partition", "files", "rows", "min_ts", "max_ts", "expected_path")


# joins

query("jn1_inner", "SELECT o_orderkey, c_name FROM orders JOIN customer ON c_custkey = o_custkey")(lambda t: t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name"))
query("jn2_expression_keys", "SELECT p_partkey, s_suppkey FROM part JOIN supplier ON lower(p_brand) = 'brand#' || CAST(s_suppkey AS VARCHAR)")(lambda t: t.part.join(t.supplier, F.lower("p_brand") == F.concat(F.lit("brand#"), F.col("s_suppkey").cast("string"))).select("p_partkey", "s_suppkey"))


@query("jn4_using", "SELECT l_orderkey, l_linenumber, max(l_tax) AS t, max(n) AS n FROM lineitem JOIN (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) USING (l_orderkey, l_linenumber) GROUP BY 1, 2")
def jn4(t):
    lines = dealt(t.lineitem.select("l_orderkey", "l_linenumber", "l_tax"), "l_orderkey", "l_linenumber")
    n = lines.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    return lines.join(n, ["l_orderkey", "l_linenumber"]).groupBy("l_orderkey", "l_linenumber").agg(F.max("l_tax").alias("t"), F.max("n").alias("n"))


query("jn5_one_row_cross", "SELECT o_orderkey, datediff('day', o_orderdate, (SELECT max(o_orderdate) FROM orders)) AS age_days FROM orders")(lambda t: t.orders.crossJoin(F.broadcast(t.orders.agg(F.max("o_orderdate").alias("m")))).select("o_orderkey", X.day_diff("o_orderdate", "m").alias("age_days")))
query("jn7_not_exists", "SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 48)")(lambda t: t.part.join(t.lineitem.filter("l_quantity > 48"), F.col("p_partkey") == F.col("l_partkey"), "left_anti").select("p_partkey"))
query("jn8_affected_keys", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01')")(lambda t: t.orders.join(t.orders.filter("o_orderdate >= timestamp'2001-07-01'").select("o_custkey").distinct(), "o_custkey", "left_semi").select("o_orderkey"))

# aggregates


@query("ag1_8_group_by", "SELECT l_returnflag, count(*) AS n, min(l_shipdate) AS lo, max(l_shipdate) AS hi, round(avg(l_quantity), 6) AS mean, sum(CAST(l_quantity AS BIGINT))::BIGINT AS total, count(*) FILTER (l_tax > 0.05) AS taxed, count(DISTINCT CASE WHEN l_tax > 0.05 THEN l_suppkey END) AS taxed_suppliers, round(avg(CASE WHEN l_linestatus = 'O' THEN l_quantity END), 6) AS open_mean, bool_or(l_quantity > 49) AS any_large, min(l_linestatus) AS some_status FROM lineitem GROUP BY 1")
def ag(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"), F.round(F.avg("l_quantity"), 6).alias("mean"), F.sum(F.col("l_quantity").cast("long")).alias("total"),
        F.count_if(F.col("l_tax") > 0.05).alias("taxed"), F.count_distinct(F.when(F.col("l_tax") > 0.05, F.col("l_suppkey"))).alias("taxed_suppliers"),
        F.round(F.avg(F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))), 6).alias("open_mean"), F.bool_or(F.col("l_quantity") > 49).alias("any_large"), F.min("l_linestatus").alias("some_status"),
    )


query("ag4_arg_max_ignores_null", "SELECT user_id, arg_max(CASE WHEN event_type <> 'error' THEN event_type END, ts) AS last_good, arg_min(CASE WHEN event_type <> 'error' THEN event_type END, ts) AS first_good FROM events GROUP BY 1")(lambda t: t.events.groupBy("user_id").agg(X.latest(F.when(F.col("event_type") != "error", F.col("event_type")), "ts", "event_id").alias("last_good"), X.earliest(F.when(F.col("event_type") != "error", F.col("event_type")), "ts", "event_id").alias("first_good")))
@query("ag5_grouped_quantiles", "SELECT l_returnflag, l_linestatus, count(l_extendedprice) AS n, " + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 6) AS q{k}" for k, p in enumerate((0.01, 0.25, 0.5, 0.99))) + " FROM lineitem GROUP BY 1, 2")
def ag5_grouped(t):
    """A few groups of very many rows: their values are sorted in ranges, not held by a task."""
    q = ranks.grouped_quantiles(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", [0.01, 0.25, 0.5, 0.99])
    return q.select("l_returnflag", "l_linestatus", "n", *[F.round(F.col("q")[k], 6).alias(f"q{k}") for k in range(4)])


query("ag5_6_percentile_median", "SELECT p_type, round(quantile_cont(p_retailprice, 0.9), 6) AS p90, round(median(p_retailprice), 6) AS mid FROM part GROUP BY 1")(lambda t: t.part.groupBy("p_type").agg(F.round(F.percentile("p_retailprice", 0.9), 6).alias("p90"), F.round(F.median("p_retailprice"), 6).alias("mid")))
query("ag9_distinct", "SELECT DISTINCT p_brand, p_type FROM part")(lambda t: t.part.select("p_brand", "p_type").dropDuplicates())
query("ag10_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12")(lambda t: t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n > 12"))
query("ag12_bounded_sample", "SELECT p_brand, list_slice(list_sort(list(DISTINCT p_partkey)), 1, 5) AS some FROM part GROUP BY 1")(lambda t: runs.least_values(t.part, "p_brand", "p_partkey", 5, "some"))
query("ag13_percent", "SELECT event_type, round(count(*) FILTER (value > 20) * 100.0 / nullif(count(*) FILTER (value > 0), 0), 1) AS pct FROM events GROUP BY 1")(lambda t: t.events.groupBy("event_type").agg(X.percent(F.count_if(F.col("value") > 20), F.count_if(F.col("value") > 0)).alias("pct")))
query("ag14_15_global_and_truncated", "SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS week, count(*) AS n, (SELECT count(*) FROM events) AS total FROM events GROUP BY 1")(lambda t: t.events.groupBy(F.date_trunc("week", "ts").alias("week")).agg(F.count("*").alias("n")).crossJoin(t.events.agg(F.count("*").alias("total"))))

# windows and sorts

@query("wn1_9_windows", "SELECT o_orderkey, row_number() OVER w AS rn, lag(o_orderstatus) OVER w AS before, lead(o_orderdate) OVER w AS next_at, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running, md5(o_orderstatus) = lag(md5(o_orderstatus)) OVER w AS same FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def wn(t):
    o = t.orders.withColumn("h", F.md5("o_orderstatus"))
    by = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return o.select("o_orderkey", F.row_number().over(by).alias("rn"), F.lag("o_orderstatus").over(by).alias("before"), F.lead("o_orderdate").over(by).alias("next_at"), F.sum(B.cents("o_totalprice")).over(by.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("running"), (F.col("h") == F.lag("h").over(by)).alias("same"))


query("wn5_percent_rank", "SELECT p_partkey, percent_rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice) AS pr FROM part")(lambda t: t.part.select("p_partkey", F.percent_rank().over(W.partitionBy("p_brand").orderBy("p_retailprice")).alias("pr")))
query("wn6_anchor", "SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 1 DAY")(lambda t: t.events.crossJoin(F.broadcast(t.events.agg(F.max("ts").alias("a")))).filter(F.col("ts") >= F.col("a") - F.expr("INTERVAL 1 DAY")).select("event_id"))
query("wn8_distinct_on", "SELECT DISTINCT ON (user_id) user_id, event_id FROM events ORDER BY user_id, ts DESC, event_id DESC")(lambda t: runs.top_per_key(t.events, "user_id", runs.desc(["ts", "event_id"])).select("user_id", "event_id"))
query("sl1_5_sorts", "SELECT s_suppkey, s_nationkey FROM supplier ORDER BY CASE WHEN s_nationkey % 2 = 0 THEN 0 ELSE 1 END, s_acctbal DESC, s_suppkey LIMIT 20")(lambda t: t.supplier.orderBy(F.when(F.col("s_nationkey") % 2 == 0, 0).otherwise(1), F.desc("s_acctbal"), "s_suppkey").limit(20).select("s_suppkey", "s_nationkey"))
query("sl4_nulls_last", "SELECT event_id FROM events ORDER BY CASE WHEN event_type = 'click' THEN value END ASC NULLS LAST, event_id LIMIT 30")(lambda t: t.events.orderBy(F.when(F.col("event_type") == "click", F.col("value")).asc_nulls_last(), "event_id").limit(30).select("event_id"))


# functions


@query("fn_date_time", "SELECT event_id, datediff('hour', date_trunc('hour', ts), date_trunc('hour', ts + INTERVAL 90 MINUTE)) AS hours, datediff('day', ts, ts + INTERVAL 1800 MINUTE) AS days, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, CAST(ts AS DATE) AS d, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds FROM events")
def fn_date(t):
    later = lambda m: F.col("ts") + F.expr(f"INTERVAL {m} MINUTES")
    return t.events.select("event_id", X.hour_diff("ts", later(90)).alias("hours"), X.day_diff("ts", later(1800)).alias("days"), F.date_trunc("day", "ts").alias("day"), F.to_date("ts").alias("d"), F.unix_timestamp("ts").alias("seconds"))


query("fn_text_hash", "SELECT p_partkey, upper(p_name) AS u, length(p_name) AS n, starts_with(p_name, 'red') AS red, regexp_matches(p_name, '^[a-m].* ring$') AS early, TRY_CAST(nullif(regexp_replace(p_brand, '[^0-9]', '', 'g'), '') AS INT) AS brand, md5(p_name) AS m, sha256(p_name) AS s FROM part")(lambda t: t.part.select("p_partkey", F.upper("p_name").alias("u"), F.length("p_name").alias("n"), F.col("p_name").startswith("red").alias("red"), X.regex_matches("p_name", "^[a-m].* ring$").alias("early"), X.digits_to_int("p_brand").alias("brand"), F.md5("p_name").alias("m"), X.fingerprint(["p_name"], 256).alias("s")))
query("fn_math", "SELECT l_orderkey, l_linenumber, l_suppkey, greatest(l_tax, l_discount, 0.05) AS g, least(l_tax, NULL, 0.03) AS l, CAST(round_even(l_quantity / 4, 0) AS INT) AS half_even, round(l_quantity / 8, 0) AS half_up, nullif(l_linenumber, 1) AS n, power(2, l_linenumber) AS p FROM lineitem")(lambda t: t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", F.greatest("l_tax", "l_discount", F.lit(0.05)).alias("g"), F.least("l_tax", F.lit(None), F.lit(0.03)).alias("l"), X.to_int_half_even(F.col("l_quantity") / 4).alias("half_even"), F.round(F.col("l_quantity") / 8, 0).alias("half_up"), F.nullif("l_linenumber", F.lit(1)).alias("n"), F.pow(F.lit(2.0), "l_linenumber").alias("p")))
query("fn_json_array", "SELECT event_id, json_extract_string(props, '$.k') AS k, list_contains([10, 20, 30], CAST(json_extract_string(props, '$.k') AS INT)) AS round_k FROM events")(lambda t: t.events.select("event_id", X.json_text("props", "$.k").alias("k"), F.array_contains(F.array(F.lit(10), F.lit(20), F.lit(30)), X.json_text("props", "$.k").try_cast("int")).alias("round_k")))


# streams over the events file; each writes a table and reads it back


def stream_of(t):
    path = f"{t.base.rstrip('/')}/events.parquet"
    return streams.timestamps(t.spark.readStream.schema(t.spark.read.parquet(path).schema).parquet(path + "*"))


# a live table and page files


@query("src3_live_table", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_acctbal > 1000 AND c_mktsegment <> 'BUILDING'")
def src3(t):
    """Customers in an embedded database, read in partitions; the filter is the database's."""
    url = f"jdbc:derby:memory:{uuid.uuid4().hex}"
    live = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    kinds = "c_custkey BIGINT, c_name VARCHAR(64), c_mktsegment VARCHAR(32)"
    t.customer.repartition(1).write.format("jdbc").option("url", url + ";create=true").option("dbtable", "customer").option("createTableColumnTypes", kinds).options(**live).save()
    rows = readers.jdbc(t.spark, url, "customer", "c_custkey", partitions=4, **live)
    return rows.filter("c_acctbal > 1000 and c_mktsegment <> 'BUILDING'").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")


def page_files(t):
    """The pages as files of a page store: fetched on days of two months, by the protocol of their url."""
    path = folder(t, "store")
    day = F.expr("timestamp'2024-01-20' + make_interval(0, 0, 0, cast(page_id % 30 as int))")
    sinks.write_pages(t.pages.select("page_id", day.alias("at"), F.split("url", "://")[0].alias("kind"), "html"), path, "at", "kind", "page_id", "html")
    return f"{path}/html"


PAGE_FILES = "SELECT page_id, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, split_part(url, '://', 1) AS artifact_type, length(html) AS n_chars, md5(html) AS body_md5 FROM (SELECT *, TIMESTAMP '2024-01-20' + to_days(CAST(page_id % 30 AS INT)) AS d FROM pages)"


def page_rows(pages):
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "year", "month", "artifact_type", F.length("html").cast("long").alias("n_chars"), F.md5("html").alias("body_md5"))


@query("src7_page_files", PAGE_FILES)
def src7_files(t):
    return page_rows(readers.pages(t.spark, page_files(t)))


@query("src7_page_folders", PAGE_FILES + " WHERE month(d) = 2 AND split_part(url, '://', 1) = 'https'")
def src7_folders(t):
    """Files in other folders are not opened."""
    return page_rows(readers.pages(t.spark, page_files(t), "month = 2 and artifact_type = 'https'"))


@query("st1_append_stream", "SELECT event_id, event_type FROM events")
def st1(t):
    out = folder(t, "appended")
    streams.append_stream(stream_of(t).select("event_id", "event_type"), out, folder(t, "ck"), ["event_type"]).start().awaitTermination()
    return t.spark.read.parquet(out)


@query("st3_block_stream", "SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, count(*) FILTER (event_type = 'error') AS new_blocks, count(*) FILTER (event_type = 'click') AS repeated_blocks, count(*) AS total_blocks FROM events WHERE event_type IN ('error', 'click') GROUP BY 1")
def st3(t):
    out = folder(t, "blocks")
    keep = lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(out)
    streams.upsert_stream(streams.hourly_blocks(stream_of(t), "ts", "event_type", "error", "click"), folder(t, "ck"), keep).start().awaitTermination()
    return runs.top_per_key(t.spark.read.parquet(out), "hour", [F.desc("batch")]).drop("batch")


@query("st4_first_wins_stream", "SELECT DISTINCT user_id, event_type FROM events")
def st4(t):
    out = folder(t, "first")
    rows = streams.first_wins(stream_of(t), ["user_id", "event_type"], "ts", "60 days").select("user_id", "event_type")
    rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", folder(t, "ck")).trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(out)


@query("st6_change_events", "SELECT CAST(user_id AS VARCHAR) AS key, ts, p AS before, event_type AS after, 'changed' AS kind FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events) WHERE p <> event_type")
def st6(t):
    """Changes of each user's event type, from the events as a stream."""
    out, name = folder(t, "changes"), "spark.sql.streaming.stateStore.providerClass"
    before = t.spark.conf.get(name)
    t.spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        rows = streams.change_events(stream_of(t), "user_id", "ts", "event_type")
        rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", folder(t, "ck")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        t.spark.conf.set(name, before)
    return t.spark.read.parquet(out)


def in_waves(t, rows, ts, make, waves=3):
    """rows as a log that grows by as many appends, in order of time; the stream of make() is started anew after each. Where its states are."""
    from tidemark.streaming import folds

    log, out, checkpoint = folder(t, "log"), folder(t, "states"), folder(t, "ck")
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    rows = written(rows, "waves")
    ends = rows.agg(F.percentile_approx(micros, [k / waves for k in range(1, waves)], 10_000)).first()[0] or []
    with folds.state_store(t.spark):
        for k in range(len(ends) + 1):
            wave = rows.filter((micros > ends[k - 1] if k else F.lit(True)) & (micros <= ends[k] if k < len(ends) else F.lit(True)))
            wave.write.mode("append").parquet(log)
            folds.kept(make(streams.source(t.spark, log, rows.schema)), out, checkpoint).start().awaitTermination()
    return out


@query("st5_fold_stream", B.with_sql(B.OBS, M.VOLUME) + "SELECT * FROM volume")
def st5(t):
    """Hourly volume with exact distinct counts, kept in state; no delivered row is read again."""
    from tidemark.streaming import folds

    rows = B.observations(t).select("fetched_at", "source", "artifact_id", "listing_id", "k")
    out = in_waves(t, rows, "fetched_at", lambda s: folds.hourly_distincts(s, "fetched_at", "source", "artifact_id", "listing_id", F.col("k") > 10, parts=1))
    return folds.volume(folds.current(t.spark, out, ["hour", "source", "kind", "part"]), "purchase")


def folded(t, rows, ts, key, make):
    from tidemark.streaming import folds

    return folds.current(t.spark, in_waves(t, rows, ts, lambda s: make(folds, s)), key)


@query("st5_price_state", B.with_sql(B.ORDER_EVENTS) + "SELECT vin, max(ts) AS ts, arg_max(tie, (ts, tie)) AS tie, arg_max(price, (ts, tie)) AS price, arg_max(state, (ts, tie)) AS state FROM oe GROUP BY vin")
def st5_price_state(t):
    return folded(t, B.order_events(t), "ts", "vin", lambda f, s: f.fold(s, "vin", ["ts", "tie"], ["price"], ["state"]))


@query("st5_present", B.with_sql(B.ORDER_EVENTS) + "SELECT vin, max(ts) AS ts, arg_max(tie, (ts, tie)) AS tie, arg_max(price, (ts, tie)) AS price FROM oe o WHERE (ts, tie) > coalesce((SELECT max((ts, tie)) FROM oe d WHERE d.vin = o.vin AND d.state = 'P'), (TIMESTAMP '1900-01-01', -1::BIGINT)) GROUP BY vin")
def st5_present(t):
    return folded(t, B.order_events(t), "ts", "vin", lambda f, s: f.fold(s, "vin", ["ts", "tie"], ["price"], deleted=F.col("state") == "P"))


@query("st5_newest_mapping", B.with_sql(B.SALES) + "SELECT vin, arg_min(customer_id, customer_id) AS customer_id, any_value(ts) AS ts FROM sales s WHERE ts = (SELECT max(ts) FROM sales x WHERE x.vin = s.vin) GROUP BY vin")
def st5_newest_mapping(t):
    return folded(t, B.sales(t), "ts", "vin", lambda f, s: f.newest_mapping(s, "vin", "customer_id", "ts"))


@query("st5_relistings", B.with_sql(B.SALES) + "SELECT vin, customer_id, ts, CASE WHEN p IS NULL THEN 'mapped' ELSE 'remapped' END AS event_type, p AS previous FROM (SELECT *, lag(customer_id) OVER (PARTITION BY vin ORDER BY ts, tie) AS p FROM sales) WHERE p IS NULL OR p <> customer_id")
def st5_relistings(t):
    from tidemark.streaming import folds

    return t.spark.read.parquet(in_waves(t, B.sales(t), "ts", lambda s: folds.relistings(s, "vin", "customer_id", "ts", "tie"))).drop("batch")


@query("st5_attempts", B.with_sql(B.COOLDOWN, M.COUNTER) + "SELECT * FROM blocked")
def st5_attempts(t):
    return folded(t, B.cooldown_log(t).select("listing_id", "event_at", "event_id", "event_type"), "event_at", "listing_id", lambda f, s: f.attempt_counter(s, "listing_id", "event_at", "event_id", F.col("event_type") == "cleared"))


@query("cs1_merge", B.with_sql(B.ORDER_EVENTS) + "SELECT vin, max(ts) AS ts, arg_max(tie, (ts, tie)) AS tie, arg_max(price, (ts, tie)) AS price, arg_max(state, (ts, tie)) AS state FROM oe GROUP BY vin")
def cs1_merge(t):
    """A state of the first years merged with a later batch equals the fold of all."""
    oe = B.order_events(t)
    part = lambda **kw: state.fold(readers.between(oe, "ts", **kw), "vin", ["ts", "tie"], ["price"], ["state"])
    return state.merge(part(end="2000-01-01"), part(start="2000-01-01"), "vin", ["ts", "tie", "price"], ["state"], newer="ts")
