"""Literal rows in, literal rows out."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.functions import exprs as X
from tidemark.operators import audits, duplicates, marts, pages, runs, selectors, staging, state


def frame(spark, schema, *data):
    df = spark.createDataFrame(list(data), schema)
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c.endswith("_at") or c == "ts" else F.col(c) for c in df.columns])


VIN = "1HGCM82633A004352"


def test_clean_vin(spark):
    df = frame(spark, "n int, v string", (1, None), (2, VIN[:16]), (3, VIN[:16] + "-"), (4, VIN.lower()), (5, VIN + "\n"), (6, VIN))
    assert rows(df.select("n", X.clean_vin("v"))) == [(1, None), (2, None), (3, None), (4, VIN), (5, None), (6, VIN)]


def test_hour_and_day_differences_count_boundaries(spark):
    df = frame(spark, "a_at string, b_at string", ("2026-01-01 01:59:00", "2026-01-01 02:01:00"), ("2026-01-01 23:59:00", "2026-01-02 00:01:00"), ("2026-01-02 02:01:00", "2026-01-02 01:59:00"))
    assert rows(df.select(X.hour_diff("a_at", "b_at"), X.day_diff("a_at", "b_at"))) == [(-1, 0), (1, 0), (1, 1)]


def test_hour_difference_corpus_makes_elapsed_time_fail(spark):
    """Pairs near boundaries in both directions; elapsed hours must be wrong on some of them."""
    from datetime import datetime, timedelta

    base = datetime(2026, 3, 1)
    pairs = [(str(base + timedelta(minutes=m)), str(base + timedelta(minutes=m + d))) for m in (0, 1, 29, 59, 60) for d in (-121, -61, -60, -59, -1, 0, 1, 59, 60, 61, 1439, 1441)]
    df = frame(spark, "a_at string, b_at string", *pairs).select("a_at", "b_at", X.hour_diff("a_at", "b_at").alias("d"), F.expr("timestampdiff(HOUR, a_at, b_at)").alias("naive"))
    got = df.collect()
    want = [int((r["b_at"].replace(minute=0) - r["a_at"].replace(minute=0)).total_seconds() // 3600) for r in got]
    assert [r["d"] for r in got] == want
    assert any(r["naive"] != w for r, w in zip(got, want, strict=True))


def test_rounding_rules(spark):
    df = spark.range(1).select(X.to_int_half_even(F.lit(2.5)), X.to_int_half_even(F.lit(3.5)), F.round(X.to_decimal(F.lit(71.25)), 1).cast("double"), X.percent(F.lit(1), F.lit(0)), X.percent(F.lit(1), F.lit(3)), X.ratio(F.lit(1), F.lit(0)))
    assert rows(df) == [(2, 4, 71.3, None, 33.3, None)]


def test_arg_max_ignores_null_values_and_breaks_ties(spark):
    df = frame(spark, "k int, v string, ts string, id int", (1, "a", "2026-01-01", 1), (1, "b", "2026-01-02", 2), (1, None, "2026-01-03", 3), (1, "c", "2026-01-02", 4), (2, None, "2026-01-01", 1))
    assert rows(df.groupBy("k").agg(X.latest("v", "ts", "id"), X.earliest("v", "ts", "id"))) == [(1, "c", "a"), (2, None, None)]


def test_fingerprint_tells_null_places_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string").select(X.fingerprint(["x", "y"]).alias("f"))
    assert df.distinct().count() == 2


def test_digits_and_regex_end(spark):
    df = spark.createDataFrame([("$12,345",), ("none",), (None,), ("99999999999",)], "t string")
    assert [r[0] for r in df.select(X.digits_to_int("t")).collect()] == [12345, None, None, None]
    assert spark.range(1).select(X.regex_matches(F.lit("ABC\n"), "^[A-Z]{3}$")).first()[0] is False


def history(spark, *prices):
    df = frame(spark, "vin string, price int, ts string, tie int", *[("v", p, f"2026-01-{k + 1:02d}", k) for k, p in enumerate(prices)])
    return runs.price_history(df, "vin", "price", "ts", "tie").first().asDict()


def test_price_history(spark):
    h = history(spark, 100, 120, 90, 90, 110)
    assert (h["price_drop_count"], h["price_increase_count"], h["first_price"], h["current_price"], h["min_price"], h["max_price"], h["total_price_observations"]) == (1, 2, 100, 110, 90, 120, 5)
    h = history(spark, 100)
    assert (h["price_drop_count"], h["price_increase_count"]) == (0, 0)


def test_latest_observation(spark):
    df = frame(spark, "vin string, source string, ts string, id int, make string", ("a", "detail", "2026-01-01", 1, "m"), ("a", "srp", "2026-01-05", 2, "m"), ("b", "srp", "2026-01-01", 3, "m"), ("b", "srp", "2026-01-02", 4, "m"), ("c", "srp", "2026-01-02", 5, None), (None, "srp", "2026-01-02", 6, "m"))
    out = runs.latest_observation(df, "vin", "source", ["detail", "srp"], "ts", "id", "make")
    assert rows(out, "vin", "id") == [("a", 1), ("b", 4)]
    assert out.columns == df.columns


def test_benchmarks(spark):
    latest = frame(spark, "vin17 string, make string, model string, msrp int", *[(v, "m", "o", None) for v in "abc"], ("d", "n", "o", 40000), ("e", None, "o", 1))
    h = frame(spark, "vin string, current_price int", ("a", 20000), ("b", 30000), ("c", 40000), ("d", 30000), ("e", 5))
    out = runs.benchmarks(latest, h, "vin17", "vin", ["make", "model"], "msrp")
    assert [(r["make"], r["national_listing_count"], r["national_median_price"], r["national_avg_price"], r["national_avg_discount_pct"] and float(r["national_avg_discount_pct"])) for r in out.orderBy("make").collect()] == [("m", 3, 30000, 30000, None), ("n", 1, 30000, 30000, 25.0)]


def test_state_runs(spark):
    df = frame(spark, "vin string, s string, ts string, id int", *[("v", s, f"2026-01-0{1 + k // 2} {12 * (k % 2):02d}:00:00", k) for k, s in enumerate("AAABAA")])
    out = runs.runs(df, "vin", ["ts", "id"], "s").orderBy("run_started_at").collect()
    assert [(r["s"], r["n_observations"], r["run_duration_hours"], r["hours_until_change"], r["is_open_run"]) for r in out] == [("A", 3, 24, 36, False), ("B", 1, 0, 12, False), ("A", 2, 12, None, True)]


def test_observation_runs_join_sources(spark):
    df = frame(spark, "listing string, vin string, source string, s string, ts string, id int", ("l", None, "detail", "x", "2026-01-01", 1), ("l", VIN, "srp", "x", "2026-01-02", 2), ("l", None, "carousel", "x", "2026-01-03", 3))
    kinds = {k: F.col("source") == k for k in ("detail", "srp", "carousel")}
    r = runs.runs(df, "listing", ["ts", "id"], "s", sources=kinds, distinct={"artifacts": "id"}, any_of=["vin"]).first()
    assert (r["n_observations"], r["n_detail"], r["n_srp"], r["n_carousel"], r["artifacts"], r["vin"], r["srp_seen"]) == (3, 1, 1, 1, 3, VIN, True)


def test_fingerprint_dedupe_takes_the_later_write(spark):
    df = frame(spark, "artifact int, listing string, ts string, w_at string, price int", (1, "l", "2026-01-01", "2026-01-01", 23000), (1, "l", "2026-01-01", "2026-01-02", 23500))
    out = runs.fingerprints(df, ["artifact", "listing"], ["price"], ["ts", "w_at"], ["price"], ids=["artifact", "listing"])
    assert [r["price"] for r in out.collect()] == [23500]


def features(spark, as_of, *, late, given=True, spread=False):
    obs = [("L1", "detail", "A", "2026-01-01 00:00:00", 1, "active"), ("L1", "detail", "A", "2026-01-01 12:00:00", 2, "active"), ("L2", "detail", "B", "2026-01-02 00:00:00", 3, "active"), ("L2", "detail", "B", "2026-01-03 00:00:00", 4, "active")]
    if late:
        obs += [("L2", "srp", "B", "2026-03-01 00:00:00", 9, "active")]
    df = frame(spark, "vin17 string, listing_id string, source string, fingerprint string, fetched_at string, artifact_id int, listing_state string, customer_id string, make string, model string", *[("v", a, b, c, d, e, f, "d1", "m", "o") for a, b, c, d, e, f in obs])
    events = frame(spark, "vin string, price int, event_at string, event_id int", ("v", 100, "2026-01-01", 1), ("v", 90, "2026-01-25", 2), ("v", 80, "2026-03-01", 3))
    seen = events.filter(F.col("event_at") <= F.lit(as_of).cast("timestamp"))
    h = runs.price_history(seen, "vin", "price", "event_at", "event_id", changes=None if given else marts.change_starts(as_of))
    bench = frame(spark, "make string, model string, national_median_price int", ("m", "o", 75))
    own = df.filter((F.col("source") == "detail") & (F.col("fetched_at") <= F.lit(as_of).cast("timestamp")))
    state_runs = runs.runs(own, "vin17", ["fetched_at", "artifact_id"], ["fingerprint", "listing_state"], first=["listing_id"])
    everything = runs.runs(df.filter(F.col("fetched_at") <= F.lit(as_of).cast("timestamp")), "listing_id", ["fetched_at", "artifact_id"], "fingerprint", sources={"detail": F.col("source") == "detail", "srp": F.col("source") == "srp"})
    return marts.volatility_features(df, events if given else None, h, bench, state_runs, everything, as_of, spread=spread).collect()


def test_volatility_features_by_any_plan(spark):
    at = "2026-03-02 00:00:00"
    want = features(spark, at, late=True)
    assert (want[0]["price_change_count_7d"], want[0]["price_change_count_30d"], want[0]["make_model_median_run_length_hours"]) == (1, 1, 12.0)
    assert features(spark, at, late=True, given=False) == want == features(spark, at, late=True, spread=True)


def test_volatility_features_see_nothing_after_the_instant(spark):
    [r] = features(spark, "2026-01-26 00:00:00", late=True)
    assert (r["total_state_changes"], r["listing_id_change_count"], r["unchanged_observation_streak"], r["price_change_count_7d"], r["price_change_count_30d"], r["days_since_srp_seen"]) == (1, 2, 2, 1, 1, None)
    assert r["current_price"] == 90 and r["price_vs_make_model_median"] == pytest.approx(1.2)
    assert r["dealer_avg_run_length_hours"] == 12.0 and r["all_source_non_detail_refresh_seen"] is False
    assert r.asDict() == features(spark, "2026-01-26 00:00:00", late=False)[0].asDict()


def test_snapshot_state(spark):
    latest = frame(spark, "vin17 string, make string, model string", *[(v, "M", "O") for v in "abc"])
    h = frame(spark, "vin string, current_price int, first_seen_at string, last_seen_at string", ("a", 1, "2026-01-01", "2026-01-01"), ("b", 1, "2026-01-01", "2026-01-30"), ("c", 1, "2026-01-01", "2026-01-02"))
    newest = frame(spark, "vin17 string, newest_state string, newest_source string", ("a", "active", "detail"), ("b", "x", "srp"), ("c", "active", "srp"))
    active = frame(spark, "make string, model string", ("m", "o"))
    assert rows(marts.vehicle_snapshot(latest, h, newest, active, "2026-02-01"), "vin17", "current_state", "days_on_market") == [("a", "active", 31), ("b", "active", 31), ("c", "unlisted", 31)]
    assert marts.vehicle_snapshot(latest, h, newest, active.limit(0), "2026-02-01").count() == 0


@pytest.mark.parametrize(("points", "score"), [(35.0, 42.3), (0.0, 7.3)])
def test_null_list_price_points(spark, points, score):
    snap = frame(spark, "vin17 string, make string, model string, customer_id string, msrp int, price int, first_price int, days_on_market int, price_drop_count int, current_state string", ("a", "m", "o", "d", None, 100, 100, 0, 2, "active"), ("b", "m", "o", "d", 200, 50, 50, 0, 0, "unlisted"))
    bench = frame(spark, "make string, model string, national_listing_count int", ("m", "o", 10))
    r = marts.deal_scores(snap, bench, null_list_points=points).first()
    assert (r["deal_score"], r["national_price_percentile"], r["deal_tier"]) == (score, 1.0, "fair" if score > 30 else "weak")


def test_cohorts(spark):
    df = frame(spark, "listing_id string, event_at string, event_id int, event_type string, num_of_attempts int", ("a", "2026-01-01", 1, "blocked", 4), ("b", "2026-01-01", 2, "incremented", 15), ("c", "2026-01-01", 3, "blocked", 2), ("c", "2026-01-02", 4, "incremented", 7), ("d", "2026-01-01", 5, "blocked", 1), ("d", "2026-01-02", 6, "cleared", 1), ("e", "2026-01-01", 7, "blocked", None))
    assert rows(marts.cooldown_cohorts(df), "attempts_bucket", "listing_count") == [("11+", 2), ("3-4", 1), ("5-10", 1)]


def test_refresh_queue(spark):
    df = frame(spark, "listing_id string, vin string, customer_id string, last_seen_at string, last_detail_scraped_at string", ("a", "1", "d", "2026-01-01", None), ("b", "2", "d", "2026-01-04 12:00:00", None), ("c", "3", "d", "2026-01-03 20:00:00", None), ("e", "5", None, "2026-01-05", None), ("f", "6", None, "2026-01-05 23:00:00", "2026-01-05"))
    cool = frame(spark, "listing_id string, num_of_attempts int, last_attempted_at string", ("e", 5, "2020-01-01"))
    stale = marts.staleness(df, "2026-01-06")
    assert rows(stale, "listing_id", "stale_reason") == [("a", "price_only"), ("b", "price_only"), ("c", "price_only"), ("e", "dealer_unenriched"), ("f", "not_stale")]
    assert rows(marts.refresh_queue(stale, cool, "2026-01-06", force_hours=40), "listing_id", "stale_reason", "priority") == [("a", "price_only", 1), ("b", "price_only-extra", 3), ("c", "force_stale_36h", 2)]


def test_backoff(spark):
    df = frame(spark, "listing_id string, num_of_attempts int, last_attempted_at string", ("a", 1, "2026-01-01"), ("b", 3, "2026-01-01"), ("c", 5, "2026-01-01"))
    got = marts.backoff(df).select("listing_id", "fully_blocked", F.col("next_eligible_at").cast("string")).orderBy("listing_id").collect()
    assert [tuple(r) for r in got] == [("a", False, "2026-01-01 12:00:00"), ("b", False, "2026-01-03 00:00:00"), ("c", True, "2026-01-09 00:00:00")]


def test_fold_and_merge(spark):
    df = frame(spark, "k string, ts string, id int, price int, vin string, gone boolean", ("a", "2026-01-01", 1, 5, "v", False), ("a", "2026-01-02", 2, None, None, False), ("b", "2026-01-01", 3, 1, "w", False), ("b", "2026-01-02", 4, 1, "w", True), ("c", "2026-01-01", 5, 1, "x", True), ("c", "2026-01-02", 6, 7, None, False))
    assert rows(state.fold(df, "k", ["ts", "id"], ["price"], ["vin"], F.col("gone")), "k", "price", "vin") == [("a", None, "v"), ("c", 7, None)]
    have = frame(spark, "k string, at int, p int, v string", ("a", 5, 1, "v"), ("b", 5, 1, "w"))
    new = frame(spark, "k string, at int, p int, v string", ("a", 6, None, None), ("b", 5, 9, "z"), ("c", 1, 2, None))
    assert rows(state.merge(have, new, "k", ["at", "p"], ["v"], newer="at")) == [("a", 6, None, "v"), ("b", 5, 1, "w"), ("c", 1, 2, None)]


def test_relistings_and_closure(spark):
    df = frame(spark, "vin string, listing string, ts string, id int", ("v", "L1", "2026-01-01", 1), ("v", "L1", "2026-01-02", 2), ("v", "L2", "2026-01-03", 3), ("w", "L9", "2026-01-01", 4))
    assert rows(state.relistings(df, "vin", "listing", "ts", "id"), "listing", "event_type", "previous") == [("L1", "mapped", None), ("L2", "remapped", "L1"), ("L9", "mapped", None)]
    vins, listings = selectors.closure(df.filter("listing = 'L1'").select("vin"), df, "vin", "listing")
    assert rows(vins) == [("v",)] and rows(listings) == [("L1",), ("L2",)]


def test_entity_closure(spark):
    """Against a plain fixpoint of sets; edges in their order, passes cut short, artifacts that lead nowhere."""
    r = random.Random(4)
    pairs = {(r.randrange(40), 100 + r.randrange(60)) for _ in range(45)}
    remaps = {(r.randrange(40), 100 + r.randrange(60), 100 + r.randrange(60)) for _ in range(25)}

    def brute(vins, listings, passes):
        for _ in range(passes):
            listings = listings | {b for a, b in pairs if a in vins}
            vins = vins | {a for a, b in pairs if b in listings}
            listings = listings | {p for a, b, p in remaps if a in vins or b in listings}
        return vins, listings

    links = spark.createDataFrame([*pairs, (None, 7), (3, None)], "vin int, listing int")
    maps = spark.createDataFrame(list(remaps), "vin int, listing int, previous int")
    steps = [[("vin", "listing", links)], [("listing", "vin", links)], [("vin", "listing", maps.selectExpr("vin", "previous as listing")), ("listing", "listing", maps.selectExpr("listing as `from`", "previous as `to`"))]]
    vin, listing = min(pairs), max(remaps)
    seeds = {"vin": spark.createDataFrame([(vin[0],), (None,)], "vin int"), "listing": spark.createDataFrame([(listing[1],)] * 2, "listing int")}
    for passes, rounds in ((1, 1), (2, 2), (None, 99)):
        found = selectors.entity_closure(steps, seeds, passes)
        vins, listings = brute({vin[0]}, {listing[1]}, rounds)
        assert {x[0] for x in rows(found["vin"])} == vins and {x[0] for x in rows(found["listing"])} == listings
        assert found["vin"].count() == len(vins)
    obs = spark.createDataFrame([(1, vin[0], None, "2024-01-05"), (2, None, listing[1], "2024-01-05"), (3, vin[0], None, "2023-01-05"), (4, 999, 998, "2024-01-05"), (None, vin[0], None, "2024-01-05")], "artifact int, vin int, listing int, ts string").withColumn("ts", F.to_timestamp("ts"))
    got = selectors.attached([(obs, "ts")], found, "artifact", "2024-01-01", "2024-02-01", spark.createDataFrame([(9,), (1,)], "artifact int"))
    assert rows(got) == [(1,), (2,), (9,)]


def test_price_selectors(spark):
    df = frame(spark, "l string, price int, ts string, id int", ("L1", 20000, "2026-01-01", 1), ("L1", 19000, "2026-01-02", 2), ("L1", 21000, "2026-01-03", 3), ("L16", 1, "2026-06-01", 4), ("L16", 2, "2026-08-01", 5), ("L17", 1, "2026-06-01", 6), ("L17", 2, "2026-07-10", 7))
    key = lambda d: {r["l"] for r in d.collect()}
    step = lambda up: key(selectors.price_steps(df, "l", "price", "ts", "id", up))
    assert step(False) == {"L1"} and step(True) == {"L1", "L16", "L17"}
    week = key(selectors.price_changed(df, "l", "price", "ts", "id", "2026-08-01 12:00:00"))
    month = key(selectors.price_changed(df, "l", "price", "ts", "id", "2026-08-01 12:00:00", only_older_than=7, days=30))
    assert week == {"L16"} and month == {"L17"}


def test_state_selectors(spark):
    df = frame(spark, "vin string, s string, ts string, id int", *[("same", "x", f"2026-01-0{k}", k) for k in (1, 2)], *[("aba", s, f"2026-01-0{k}", k) for k, s in ((3, "a"), (4, "b"), (5, "a"))])
    of = lambda changed: rows(selectors.state_steps(df, "vin", ["ts", "id"], ["s"], changed), "vin", "id")
    assert of(False) == [("same", 2)] and of(True) == [("aba", 4), ("aba", 5)]


def test_membership_takes_exact_rows_from_any_time(spark):
    df = frame(spark, "vin string, listing_id string, ts string, id int", ("v", "l", "2026-01-05", 1), (None, "m", "2026-01-05", 2), ("v", "l", "2026-02-05", 3), (None, "z", "2025-01-01", 4), ("v", "l", "2026-02-01", 5))
    out = selectors.membership(df, df.filter("id = 1").select("vin"), df.filter("id = 2").select("listing_id"), "ts", "2026-01-01", "2026-02-01", exact=df.filter("id = 4").select("vin", "id"), exact_on=["vin", "id"])
    assert rows(out, "id") == [(1,), (2,), (4,)]


def test_summary_and_coverage(spark):
    df = frame(spark, "e string", ("a",), ("a",), ("b",), (None,))
    s = selectors.summary([selectors.Selector("x", "e", lambda t: t["t"], 3)], {"t": df})
    assert [tuple(r) for r in s.collect()] == [("x", 4, 2, ["a", "b"], False)]
    need = frame(spark, "selector string, minimum int", ("x", 2), ("y", 1))
    assert rows(selectors.coverage(s, need), "selector", "found", "covered") == [("x", 2, True), ("y", 0, False)]


def test_parity_finds_each_difference_and_fails_on_empty(spark):
    a = frame(spark, "k int, v string", (1, "a"), (2, None), (3, "c"))
    b = frame(spark, "k int, v string", (1, "a"), (2, "x"), (4, "d"))
    assert [tuple(r) for r in audits.row_parity(a, b, ["k"]).orderBy("k").collect()] == [(2, "differs", ["v"]), (3, "only_a", None), (4, "only_b", None)]
    same = audits.build_parity(a, a, ["k"]).filter("not passed")
    assert same.count() == 0
    assert rows(audits.build_parity(a.limit(0), a.limit(0), ["k"]).filter("not passed"), "check_name") == [("rows",)]


def test_version_diffs(spark):
    df = frame(spark, "k int, n int, body string", (1, 1, "a\nb"), (1, 2, "a\nc\nd"), (1, 3, "a\nc\nd"), (2, 1, "x"), (1, 4, None))
    assert rows(duplicates.version_diffs(df, "k", "n", "body"), "n", "lines_added", "lines_removed", "changed") == [(2, 2, 1, True), (3, 0, 0, False), (4, None, None, False)]


def test_prefix_match_needs_whole_words(spark):
    df = frame(spark, "make string, rest string", ("m", "civic"), ("m", "civic si"), ("m", "civics"), ("n", "civic"))
    t = frame(spark, "make2 string, model string", ("m", "civic"))
    assert rows(staging.prefix_match(df, t, "make", "rest", "make2", "model")) == [("m", "civic si"), ("m", "civic")]


def test_page_states(spark):
    data = '<script id="initial-activity-data" type="application/json">{"listing_id":"L"}</script>'
    pages_of = {
        "<title>Car</title><p>captcha, access denied": "active",
        f"<title>Just a moment</title>{data}": "active",
        '<title>Just a moment</title><script id="initial-activity-data">{}</script>': "blocked",
        '<title>Attention Required!</title><script id="initial-activity-data">{broken</script>': "blocked",
        "<title>Checking your browser</title><p>no longer listed": "blocked",
        "<title>Car</title><svg><title>Just a moment</title></svg>": "active",
        f"<title>Attention required</title>{data}<p>no longer available": "unlisted",
    }
    df = spark.createDataFrame(list(enumerate(pages_of)), "id long, html string")
    assert [r["page_state"] for r in pages.parsed(df, "id", "html").orderBy("id").collect()] == list(pages_of.values())
