"""Incremental maintenance, sinks, layout jobs and streams on small tables."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import incremental, marts, runs
from tidemark.sources import layout, readers, sinks
from tidemark.streaming import streams


def obs(spark, *data):
    return spark.createDataFrame(list(data), "vin string, s string, ts string, id int").withColumn("ts", F.col("ts").cast("timestamp"))


def make(df):
    return runs.runs(df, "vin", ["ts", "id"], "s")


def step(source, target):
    return incremental.affected(source, target, "ts", "3 DAYS", "vin", make, "run_ended_at")


BASE = [("a", "A", "2026-01-01", 1), ("a", "A", "2026-01-08", 2), ("a", "B", "2026-01-09", 3), ("b", "M", "2026-01-01", 4), ("old", "Z", "2025-01-01", 5)]


def test_late_row_splits_a_run_and_equals_a_rebuild(spark):
    base = make(obs(spark, *BASE))
    second = obs(spark, *BASE, ("a", "C", "2026-01-07 12:00:00", 6))
    got = step(second, base)
    assert rows(got) == rows(make(second))
    assert got.filter("vin = 'a'").count() == 4
    assert rows(step(second, got)) == rows(got)  # a second run changes nothing
    assert rows(got.filter("vin = 'old'")) == rows(base.filter("vin = 'old'"))


def test_correction_joins_runs(spark):
    first = obs(spark, ("m", "M", "2026-01-08", 1), ("m", "N", "2026-01-08 12:00:00", 2), ("m", "M", "2026-01-09", 3))
    fixed = obs(spark, ("m", "M", "2026-01-08", 1), ("m", "M", "2026-01-08 12:00:00", 2), ("m", "M", "2026-01-09", 3))
    assert step(fixed, make(first)).count() == 1


def test_no_target_or_an_empty_one_reads_all(spark):
    source = obs(spark, *BASE)
    assert rows(step(source, None)) == rows(make(source)) == rows(step(source, make(source).limit(0)))


def test_whole_hours_are_computed_anew(spark):
    def volume(df):
        return marts.scrape_volume(df, "ts", "s", "id", "vin", F.lit(True), "A")

    first = obs(spark, ("a", "A", "2026-01-01 10:10:00", 1), ("a", "A", "2026-01-09 10:10:00", 2))
    second = obs(spark, ("a", "A", "2026-01-01 10:10:00", 1), ("a", "A", "2026-01-01 10:20:00", 9), ("a", "A", "2026-01-09 10:10:00", 2), ("b", "A", "2026-01-09 10:40:00", 3), ("b", "A", "2026-01-09 12:40:00", 4))
    got = incremental.time_window(second, volume(first), "ts", "hour", "72 HOURS", volume, "hour", ["hour", "source"])
    assert rows(got.select(F.col("hour").cast("string"), "observation_count")) == [("2026-01-01 10:00:00", 1), ("2026-01-09 10:00:00", 2), ("2026-01-09 12:00:00", 1)]


def test_observation_sink_and_pruned_scan(spark, tmp_path):
    path = str(tmp_path / "obs")
    df = spark.createDataFrame([(1, "detail", "2026-01-05"), (2, "srp", "2026-02-05"), (3, "srp", None)], "artifact_id long, source string, fetched_at string").withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    sinks.append_observations(df, path, now="2026-03-01")
    back = readers.parquet(spark, path)
    assert rows(back, "artifact_id", "obs_year", "obs_month", "obs_day") == [(1, 2026, 1, 5), (2, 2026, 2, 5), (3, 2026, 3, 1)]
    scan = readers.between(back, "fetched_at", "2026-02-01", "2026-03-01", parts=("obs_year", "obs_month"))
    assert rows(scan, "artifact_id") == [(2,)]
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "obs_month" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_events_without_time_go_to_year_0(spark, tmp_path):
    df = spark.createDataFrame([(1, "2026-01-05"), (2, None)], "event_id long, event_at string").withColumn("event_at", F.col("event_at").cast("timestamp"))
    sinks.append_events(df, str(tmp_path / "e"))
    assert rows(spark.read.parquet(str(tmp_path / "e")), "event_id", "year", "month") == [(1, 2026, 1), (2, 0, 0)]


def test_schema_versions_are_read_by_name(spark, tmp_path):
    path = str(tmp_path / "v")
    spark.createDataFrame([(1,)], "event_id long").write.mode("append").parquet(path)
    spark.createDataFrame([("x", 2)], "listing_id string, event_id long").write.mode("append").parquet(path)
    got = readers.parquet(spark, path, schema.EVENTS["blocked_cooldown_events"])
    assert rows(got, "event_id", "listing_id", "num_of_attempts") == [(1, None, None), (2, "x", None)]


def test_integers_from_blank_text(spark):
    df = spark.createDataFrame([("5",), (" ",), (None,), ("x",)], "n string")
    assert [r[0] for r in sinks.to_integers(df, ["n"]).collect()] == [5, None, None, None]


def test_export_is_immutable_and_hashes_ignore_order(spark, tmp_path):
    df = spark.range(10).withColumn("p", F.col("id") % 2)
    sinks.export({"t": (df, ["p"], ["id"])}, str(tmp_path / "g"))
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        sinks.export({"t": (df, ["p"], ["id"])}, str(tmp_path / "g"))
    assert sinks.content_hash(df).first() == sinks.content_hash(df.orderBy(F.desc("id"))).first() != sinks.content_hash(df.limit(9)).first()
    assert sinks.content_hash(df.limit(0)).first()["rows"] == 0


def test_export_hashes_what_it_writes(spark, tmp_path, monkeypatch):
    import hashlib

    path = tmp_path / "g"
    df = spark.range(1000).select("id", F.expr("CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'a/b=c%' WHEN 2 THEN 'é' ELSE '' END").alias("p"), F.timestamp_seconds("id").alias("at"), F.lit(1.5).cast("decimal(9,2)").alias("d"))
    same = spark.range(0, 6, 1, 3).select(F.lit(7).alias("x"))  # three tasks write equal bytes
    made = {r["table_name"]: r for r in sinks.export({"t": (df, ["p"], ["id"]), "same": (same, [], []), "none": (df.limit(0), [], [])}, str(path)).collect()}
    assert (path / "_SUCCESS").exists()
    for name, frame in (("t", df), ("same", same)):
        files = sorted((path / name).rglob("*.parquet"))
        sums = sorted(hashlib.sha256(f.read_bytes()).hexdigest() for f in files)
        assert made[name]["sha256"] == sums and made[name]["files"] == len(files)
        assert made[name]["bytes"] == sum(f.stat().st_size for f in files)
        assert made[name]["rows"] == frame.count()
        assert made[name]["content_hash"] == sinks.content_hash(frame).first()["content_hash"]
    assert rows(sinks.exported(spark, str(path), "t"), "id", "p", "at", "d") == rows(df.withColumn("p", F.nullif("p", F.lit(""))), "id", "p", "at", "d")
    assert sinks.exported(spark, str(path), "same").count() == 6
    assert (made["none"]["rows"], made["none"]["files"], made["none"]["sha256"]) == (0, 0, [])


def test_failed_export_leaves_nothing_readable(spark, tmp_path):
    path = tmp_path / "g"
    bad = spark.range(0, 4000, 1, 4).withColumn("x", F.when(F.col("id") == 3999, F.raise_error(F.lit("stop"))).otherwise(1))
    with pytest.raises(Exception, match="stop"):
        sinks.export({"good": (spark.range(5), [], []), "bad": (bad, [], [])}, str(path))
    assert not (path / "bad").exists() and not (path / "_SUCCESS").exists()
    with pytest.raises(FileNotFoundError):
        sinks.exported(spark, str(path), "good")


def test_publish_checks_its_key(spark, tmp_path):
    path = str(tmp_path / "p")
    with pytest.raises(ValueError, match="1 repeated keys"):
        sinks.publish(spark.createDataFrame([(1,), (1,)], "k int"), path, "1", "k")
    with pytest.raises(ValueError, match="1 null keys"):
        sinks.publish(spark.createDataFrame([(1,), (None,)], "k int"), path, "2", "k")
    assert sinks.snapshots(spark, path) == [] and not list(tmp_path.glob("p/**/*.parquet"))  # nothing to read
    one = sinks.publish(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-03")], "k int, t string"), path, "1", "k", "t")  # the version that failed
    assert (one["rows"], one["max_ts"], one["sequence"], one["parent_id"]) == (2, "2024-01-03", 1, None)
    with pytest.raises(FileExistsError):
        sinks.publish(spark.createDataFrame([(3, "")], "k int, t string"), path, "1", "k")
    two = sinks.publish(spark.createDataFrame([(3, "")], "k int, t string"), path, "2", "k")
    assert (two["sequence"], two["parent_id"]) == (2, one["snapshot_id"]) and [x["version"] for x in sinks.snapshots(spark, path)] == ["1", "2"]
    assert rows(spark.read.parquet(path), "k", "version") == [(1, 1), (2, 1), (3, 2)]
    assert sinks.publish(spark.createDataFrame([], "k int"), path, "3", "k")["rows"] == 0


def test_reconstruct_unlisted(spark):
    def frame(text, *data):
        df = spark.createDataFrame(list(data), text)
        return df.withColumns({c: F.col(c).cast("timestamp") for c in df.columns if c.endswith("_at")})

    queue = frame("event_id int, artifact_id int, event_at string, fetched_at string", (1, 7, "2026-01-01", "2026-01-01 05:00:00"), (2, 8, "2026-01-01", "2026-01-01 06:00:00"))
    mapping = frame("event_id int, listing_id string, vin string, event_at string", (1, "l", "v", "2026-01-01"), (2, "m", "w", "2026-01-01"))
    price = frame("event_id int, listing_id string, artifact_id int, make string, model string, event_type string, event_at string", (1, "l", 7, "a", "b", "deleted", "2026-01-02"), (2, "m", 8, "a", "b", "deleted", "2026-01-02"), (3, "n", 9, "a", "b", "deleted", "2026-01-02"))
    stored = frame("artifact_id int, listing_id string, listing_state string", (8, "m", "unlisted"))
    assert rows(sinks.reconstruct_unlisted(queue, mapping, price, stored), "artifact_id", "vin", "listing_state") == [(7, "v", "unlisted")]


def test_compaction_keeps_rows_and_sorts(spark, tmp_path):
    path = str(tmp_path / "c")
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).withColumn("obs_year", F.lit(2026)).withColumn("obs_month", F.lit(1)).repartition(2).write.mode("append").partitionBy("obs_year", "obs_month").parquet(path)
    states = layout.compaction_states(spark, path, "obs_year", "obs_month", "2026-02-05").collect()
    assert [(r["state"], r["rows"]) for r in states] == [("needs_compaction", 30)]
    assert layout.compaction_states(spark, path, "obs_year", "obs_month", "2026-02-01").count() == 0  # not closed yet
    [(_, before, after)] = layout.compact_due(spark, path, "obs_year", "obs_month", "2026-02-05", ["id", "absent"])
    assert (before, after) == (30, 30)
    assert [r["state"] for r in layout.compaction_states(spark, path, "obs_year", "obs_month", "2026-02-05").collect()] == ["done"]
    assert [r["id"] for r in spark.read.parquet(path).collect()] == list(range(30))
    [r] = layout.audit(spark, path).collect()
    assert (r["files"], r["small_files"], r["rows"], r["expected_path"]) == (1, 1, 30, True)


def test_rewrite_checks_its_baseline(spark, tmp_path):
    df = spark.createDataFrame([(1, "2026-01-05"), (2, None)], "id int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert layout.rewrite_months(df, str(tmp_path / "r"), "ts", ["id"]) == 2
    assert rows(spark.read.parquet(str(tmp_path / "r/table")), "id", "year") == [(1, 2026), (2, 0)]
    with pytest.raises(ValueError, match="wanted"):
        layout.rewrite_months(df, str(tmp_path / "r"), "ts", ["id"], baseline=3)
    assert spark.read.parquet(str(tmp_path / "r/table")).count() == 2
    a, b = spark.range(1), spark.range(1).withColumn("x", F.lit("y"))
    assert layout.schema_fingerprint(a) != layout.schema_fingerprint(b) and len(layout.schema_fingerprint(a)) == 12


def test_append_stream_is_exactly_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    spark.range(5).withColumn("p", F.col("id") % 2).write.parquet(src)
    for _ in range(2):
        s = streams.source(spark, src, spark.read.parquet(src).schema)
        streams.append_stream(s, out, ck, ["p"]).start().awaitTermination()
    assert spark.read.parquet(out).count() == 5


def test_stream_upsert_equals_a_batch_build(spark, tmp_path):
    src, ck = str(tmp_path / "in"), str(tmp_path / "ck")
    state = {"target": None}

    def apply(batch, number):
        seen = spark.read.parquet(src)
        state["target"] = spark.createDataFrame(step(seen, state["target"]).collect(), make(seen).schema)

    waves = (BASE, [("a", "C", "2026-01-07 12:00:00", 6)])
    for wave in waves:
        obs(spark, *wave).coalesce(1).write.mode("append").parquet(src)
        streams.upsert_stream(streams.source(spark, src, spark.read.parquet(src).schema), ck, apply).start().awaitTermination()
    assert rows(state["target"]) == rows(make(spark.read.parquet(src)))


def test_first_wins_stream(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    obs(spark, ("a", "A", "2026-01-01", 1), ("a", "B", "2026-01-02", 2), ("b", "A", "2026-01-01", 3)).coalesce(1).write.parquet(src)
    s = streams.first_wins(streams.source(spark, src, spark.read.parquet(src).schema), ["vin"], "ts")
    s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(out), "vin") == [("a",), ("b",)]


def test_change_events(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    obs(spark, ("a", "A", "2026-01-01", 1), ("a", "B", "2026-01-02", 2), ("a", "B", "2026-01-03", 3), ("b", "A", "2026-01-01", 4)).coalesce(1).write.parquet(src)
    s = streams.change_events(streams.source(spark, src, spark.read.parquet(src).schema), "vin", "ts", "s")
    try:
        s.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    assert rows(spark.read.parquet(out), "key", "before", "after", "kind") == [("a", "A", "B", "changed")]


def test_whole_tables(spark, tmp_path):
    """Queries over whole tables against brute force."""
    from tidemark.operators import selectors
    from tidemark.plans import bindings as B
    from tidemark.plans import catalog, registry

    def given(name, columns, data):
        spark.createDataFrame(data, columns).write.parquet(f"{tmp_path}/{name}.parquet")

    line = [(1, 1, 7, 30), (1, 2, 7, 31), (2, 1, 8, 30), (2, 2, 8, 30), (3, 1, 9, 2), (3, 2, 9, 40), (4, 1, 10, 40), (5, 1, 11, 50), (5, 2, None, 50)]
    line += [(9, k, 100 + k // 2, 1000 + (k + 1) // 2) for k in range(1, 12)]  # a chain: 100, 101, ... 105
    given("lineitem", "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long", line)
    part = [(7, "Brand#11", "red"), (8, "Brand#12", "red hot"), (51, "Brand#12", "red"), (52, "Brand#12", "blue"), (100, "Brand#11", "green tea")]
    given("part", "p_partkey long, p_brand string, p_name string", part)
    events = [(1, 1, "click", "2024-01-01"), (2, 1, "purchase", "2024-01-20"), (3, 2, "click", "2024-01-25"), (4, 3, "purchase", "2024-01-02"), (5, 3, "click", "2024-01-03"), (6, 4, "purchase", "2024-01-04"), (7, 4, "click", "2024-01-04")]
    unusable = {5, 6}  # no make: 3 has no usable click, 4 no usable purchase
    e = spark.createDataFrame([(*r, 1.0, '{"k": 1}' if r[0] in unusable else '{"k": 50}') for r in events], "event_id long, user_id long, event_type string, ts string, value double, props string")
    e.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{tmp_path}/events.parquet")
    orders = [(k, f"{1992 + k % 8}-{1 + k % 12:02d}-05") for k in range(400)]
    o = spark.createDataFrame(orders, "o_orderkey long, day string")
    o.select("o_orderkey", F.col("day").cast("timestamp").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")

    run = lambda name: catalog.QUERIES[name](spark, str(tmp_path))
    assert rows(run("jn11_elsewhere")) == sorted({a for a in line if a[2] and any(b[2] == a[2] and b[3] != a[3] for b in line)}, key=repr)
    starts = lambda p, x: p[1] == x[1] and (p[2] + " ").startswith(x[2].split(" ")[0] + " ")
    assert rows(run("jn10_prefix_match")) == sorted(((p[0],) for p in part if any(starts(p, x) for x in part)), key=repr)
    assert rows(run("se10_detail_beats_srp"), "vin17", "artifact_id") == [(1, 2)]
    assert rows(selectors.best_source(B.observations(registry.Tables(spark, str(tmp_path))).filter("k > 10"), "vin17", "source", B.PRIORITY, "fetched_at", "artifact_id", wanted="click", never="purchase"), "vin17") == [(2,), (4,)]
    assert rows(run("se11_srp_fallback"), "vin17", "artifact_id") == [("1 2024-01-01", 1), ("2 2024-01-25", 3), ("4 2024-01-04", 7)]
    done = run("lay1_compaction")
    assert rows(done) == sorted(((k, int(d[:4]), int(d[5:7])) for k, d in orders), key=repr)
    assert len(done.inputFiles()) == len({d[:7] for _, d in orders}) > 12  # one file a month: none was left


def test_swaps_cut_short_are_mended(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(40).selectExpr("id", "2024 as year", "id % 2 + 1 as month").repartition(3).write.partitionBy("year", "month").parquet(path)
    (tmp_path / "t/_old/year=2024").mkdir(parents=True)
    (tmp_path / "t/year=2024/month=1").rename(tmp_path / "t/_old/year=2024/month=1")  # died between the renames
    done = layout.compact_due(spark, path, "year", "month", "2024-06-01", ["id"])
    assert [d[1:] for d in done] == [(20, 20)] * 2
    assert rows(spark.read.parquet(path), "id") == [(k,) for k in sorted(range(40), key=lambda k: repr((k,)))]
    states = {r["state"] for r in layout.compaction_states(spark, path, "year", "month", "2024-06-01").collect()}
    assert states == {"done"}
    layout.rewrite_months(spark.range(3).selectExpr("id", "timestamp'2024-01-01' as ts"), f"{tmp_path}/m", "ts", ["id"])
    (tmp_path / "m/table").rename(tmp_path / "m/_old")
    layout.rewrite_months(spark.range(5).selectExpr("id", "timestamp'2024-01-01' as ts"), f"{tmp_path}/m", "ts", ["id"])
    assert spark.read.parquet(f"{tmp_path}/m/table").count() == 5
