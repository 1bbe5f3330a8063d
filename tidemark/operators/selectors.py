"""Selectors over a bounded window, their registry, and the cohort they make up."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.functions import exprs as X
from tidemark.operators.runs import with_previous
from tidemark.operators.staging import followed_by
from tidemark.sources.scratch import ensure_checkpoint_dir


def state_steps(obs: DataFrame, key: str, order: Sequence[str], fields: Sequence[str], changed: bool) -> DataFrame:
    """Rows whose fingerprint equals, or differs from, the one before of the same key."""
    rows = obs.filter(F.col(key).isNotNull()).withColumn("fingerprint", X.fingerprint(fields))
    rows = with_previous(rows, key, order, "fingerprint", "__prev")
    same = F.col("fingerprint") == F.col("__prev")
    return rows.filter(F.col("__prev").isNotNull() & (~same if changed else same)).drop("__prev")


def relisted(obs: DataFrame, key: str, place: str) -> DataFrame:
    """Keys seen at more than one place, with the number of places."""
    return obs.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(place).alias("places")).filter("places > 1")


def active_to_unlisted(obs: DataFrame, key: str, ts: str, state: str, active: str = "active", unlisted: str = "unlisted") -> DataFrame:
    return followed_by(obs, key, ts, F.col(state) == active, F.col(state) == unlisted)


def price_steps(events: DataFrame, key: str, price: str, ts: str, tie: str, up: bool | None = None) -> DataFrame:
    """Priced events whose price differs from the one before (up: rises or drops only)."""
    rows = with_previous(events.filter(F.col(price).isNotNull()), key, [ts, tie], price, "prev_price")
    p, q = F.col(price), F.col("prev_price")
    return rows.filter(p != q if up is None else p > q if up else p < q)


def anchored(df: DataFrame, ts: str, anchor: str | Column | None, name: str = "window_anchor") -> DataFrame:
    """The anchor as a column: the one given, else the newest time (one row, not a global window)."""
    if anchor is not None:
        return df.withColumn(name, X.as_of(anchor))
    return df.crossJoin(F.broadcast(df.agg(F.max(ts).alias(name))))


def price_changed(events: DataFrame, key: str, price: str, ts: str, tie: str, anchor: str | None = None, only_older_than: int | None = None, days: int = 7) -> DataFrame:
    """Changes from `days` before the anchor on; with only_older_than, those before that many days to it.

    The anchor is the one given, else the newest priced event, whether it changes a price or not.
    """
    if anchor is None:
        newest = F.broadcast(events.filter(F.col(price).isNotNull()).agg(F.max(ts).alias("window_anchor")))
        rows = price_steps(events, key, price, ts, tie).crossJoin(newest)
    else:
        rows = anchored(price_steps(events, key, price, ts, tie), ts, anchor)
    got = rows.filter(F.col(ts) >= F.col("window_anchor") - F.expr(f"INTERVAL {days} DAYS"))
    if only_older_than is not None:
        got = got.filter(F.col(ts) < F.col("window_anchor") - F.expr(f"INTERVAL {only_older_than} DAYS"))
    return got


def without_history(obs: DataFrame, events: DataFrame, key: str, event_key: str, price: str) -> DataFrame:
    """Distinct keys without a priced event; a null key stands as a key of its own."""
    priced = events.filter(F.col(price) > 0).select(F.col(event_key).alias(key)).distinct()
    return obs.select(key).distinct().join(priced, key, "left_anti")


def best_source(obs: DataFrame, key: str, source: str, priority: Sequence[str], ts: str, tie: str, wanted: str, also: str | None = None, never: str | None = None, required: str | None = None) -> DataFrame:
    """Keys whose best row is of the wanted source, that have also been seen by `also`, never by `never`.

    Rows without `required` are not usable: they are neither the best nor seen. A null key is none.
    """
    obs = obs.filter(F.col(key).isNotNull())
    if required:
        obs = obs.filter(F.col(required).isNotNull())
    flags = {"__also": also, "__never": never}
    best = F.max(F.struct((-X.rank_by(source, priority)).alias("p"), F.col(ts).alias("t"), F.col(tie).alias("i"), F.col(source).alias("s")))
    rows = obs.groupBy(key).agg(best.alias("b"), *[F.coalesce(F.bool_or(F.col(source) == v), F.lit(False)).alias(n) for n, v in flags.items() if v])
    rows = rows.filter(F.col("b.s") == wanted)
    if also:
        rows = rows.filter("__also")
    if never:
        rows = rows.filter("not __never")
    return rows.select(key, F.col("b.i").alias(tie), F.col("b.s").alias(source), F.col("b.t").alias(ts))


def seen_by(obs: DataFrame, key: str, source: str, wanted: str) -> DataFrame:
    return obs.filter((F.col(source) == wanted) & F.col(key).isNotNull()).select(key).distinct()


def invalid_key(obs: DataFrame, vin: str) -> DataFrame:
    """Rows whose VIN is null or not 17 letters and digits."""
    return obs.filter(X.clean_vin(vin).isNull())


def density(obs: DataFrame, group: Sequence[str], least: int | None = None, most: int | None = None) -> DataFrame:
    """Groups of so many rows."""
    out = obs.dropna(subset=list(group)).groupBy(*group).agg(F.count("*").alias("row_count"))
    if least is not None:
        out = out.filter(F.col("row_count") >= least)
    return out.filter(F.col("row_count") <= most) if most is not None else out


def attempts_between(events: DataFrame, attempts: str, low: int, high: int | None = None) -> DataFrame:
    return events.filter((F.col(attempts) >= low) & (F.lit(True) if high is None else F.col(attempts) <= high))


def spans(obs: DataFrame, key: str, ts: str) -> DataFrame:
    return obs.groupBy(key).agg(F.min(ts).alias("first_seen_at"), F.max(ts).alias("last_seen_at"))


def fresh_recent(obs: DataFrame, key: str, ts: str, anchor: str | None = None, first_within: int = 14, last_within: int = 2) -> DataFrame:
    rows = anchored(spans(obs, key, ts), "last_seen_at", anchor)
    days = lambda n: F.col("window_anchor") - F.expr(f"INTERVAL {n} DAYS")
    return rows.filter((F.col("first_seen_at") >= days(first_within)) & (F.col("last_seen_at") >= days(last_within)))


def stale(obs: DataFrame, key: str, ts: str, tie: str, carry: Sequence[str], end: str | None = None, days: int = 30) -> DataFrame:
    """Keys last seen `days` or more before the window's end, with the row that was seen last.

    Of rows at the same time the smallest tie column counts.
    """
    last = F.min(F.struct((-F.unix_micros(F.col(ts).cast("timestamp"))).alias("t"), F.col(tie).alias(tie), *[F.col(c).alias(c) for c in carry]))
    rows = obs.groupBy(key).agg(last.alias("r"), F.min(ts).alias("first_seen_at"), F.max(ts).alias("last_seen_at"))
    rows = anchored(rows, "last_seen_at", end, "window_end").filter(F.col("last_seen_at") <= F.col("window_end") - F.expr(f"INTERVAL {days} DAYS"))
    return rows.select(key, F.col(f"r.{tie}").alias(tie), *[F.col(f"r.{c}").alias(c) for c in carry], "first_seen_at", "last_seen_at", "window_end")


@dataclass(frozen=True)
class Selector:
    """A named selector: rows(tables) gives candidates, `entity` names what they are counted by."""

    name: str
    entity: str
    rows: Callable[[Mapping[str, DataFrame]], DataFrame]
    least: int = 1


def summary(selectors: Sequence[Selector], tables: Mapping[str, DataFrame], sample: int = 5) -> DataFrame:
    """Per selector: candidate rows, distinct entities, the first entities as a sample, and pass or fail."""
    out = None
    for s in selectors:
        e = s.rows(tables).select(F.col(s.entity).cast("string").alias("e")).groupBy("e").count()
        few = e.filter("e is not null").orderBy("e").limit(sample).agg(F.sort_array(F.collect_list("e")).alias("sample"))
        one = e.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("candidate_rows"), F.count("e").alias("distinct_entities")).crossJoin(few)
        one = one.select(F.lit(s.name).alias("selector"), "candidate_rows", "distinct_entities", "sample", (F.col("distinct_entities") >= s.least).alias("passed"))
        out = one if out is None else out.unionByName(one)
    return out


def coverage(summaries: DataFrame, required: DataFrame) -> DataFrame:
    """Found against required (selector, minimum) entities."""
    rows = required.join(summaries, "selector", "left")
    found = F.coalesce("distinct_entities", F.lit(0))
    return rows.select("selector", "minimum", found.alias("found"), (found >= F.col("minimum")).alias("covered"))


def candidates(rows: DataFrame, entity: str, cap: int) -> DataFrame:
    """Distinct entities in order, at most cap (the export's own bound)."""
    return rows.select(entity).dropna().distinct().orderBy(entity).limit(cap)


def allocate(chosen: Sequence[DataFrame], fill: DataFrame, key: str, target: int) -> DataFrame:
    """Entities that selectors chose, filled up in md5 order to the target."""
    picked = chosen[0].select(key)
    for c in chosen[1:]:
        picked = picked.union(c.select(key))
    picked = picked.distinct()
    more = fill.select(key).dropna().distinct().join(picked, key, "left_anti")
    want = F.lit(0).alias("source"), F.lit("").alias("m")
    both = picked.select(key, *want).union(more.select(key, F.lit(1), F.md5(F.col(key).cast("string"))))
    return both.orderBy("source", "m", key).limit(target).select(key)


def seeds(obs: DataFrame, groups: DataFrame, group: Sequence[str], order: Sequence[Column], n: int = 50) -> DataFrame:
    """At most n rows of each of the given groups."""
    rows = obs.join(groups.select(*group).distinct(), list(group), "left_semi")
    return rows.withColumn("__n", F.row_number().over(W.partitionBy(*group).orderBy(*order))).filter(F.col("__n") <= n).drop("__n")


def closure(keys: DataFrame, links: DataFrame, left: str, right: str, passes: int = 5) -> tuple[DataFrame, DataFrame]:
    """All left and right entities reachable from left keys over links, in at most `passes` rounds."""
    pairs = links.select(left, right).dropna().distinct()
    found = entity_closure([[(left, right, pairs)], [(right, left, pairs)]], {left: keys.select(left)}, passes)
    return found[left], found[right]


def entity_closure(steps: Sequence[Sequence[tuple[str, str, DataFrame]]], seeds: Mapping[str, DataFrame], passes: int | None = 5) -> dict[str, DataFrame]:
    """Kind -> all entities of that kind reachable from the seeds, one column named by the kind.

    An edge is (from kind, to kind, frame); its frame has a column of either kind's name, or "from" and "to"
    for two entities of one kind. A pass takes the steps in order, and the edges of a step together, until
    nothing is new or `passes` are done (None: no limit). Every edge follows only entities that it has not
    followed before. Entities stay distributed; a step brings only whether it found any to the driver,
    and is written to the checkpoint folder to end its lineage. Null ids are no entities.
    """
    kinds = dict.fromkeys([*seeds, *(k for step in steps for a, b, _ in step for k in (a, b))])
    spark = steps[0][0][2].sparkSession
    ensure_checkpoint_dir(spark)
    found: dict[str, list[DataFrame]] = {k: [seeds[k].select(k).dropna().distinct().checkpoint()] if k in seeds else [] for k in kinds}
    done: dict[tuple[int, int], int] = {}
    both = lambda frames: reduce(DataFrame.union, frames)
    for _ in range(passes) if passes else count():
        grown = False
        for i, step in enumerate(steps):
            reached: dict[str, DataFrame] = {}
            for j, (a, b, frame) in enumerate(step):
                fresh = found[a][done.get((i, j), 0) :]
                done[i, j] = len(found[a])
                if fresh:
                    source, target = (a, b) if a != b else ("from", "to")
                    to = frame.join(both(fresh).withColumnRenamed(a, source), source, "left_semi").select(F.col(target).alias(b)).dropna()
                    reached[b] = reached[b].union(to) if b in reached else to
            for kind, rows in reached.items():
                new = rows.distinct()
                if found[kind]:
                    new = new.join(both(found[kind]), kind, "left_anti")
                new = new.checkpoint()
                if not new.isEmpty():
                    found[kind].append(new)
                    grown = True
        if not grown:
            break
    return {k: both(v) if v else seeds_of(steps, k).limit(0) for k, v in found.items()}


def seeds_of(steps: Sequence[Sequence[tuple[str, str, DataFrame]]], kind: str) -> DataFrame:
    """A column of entities of a kind, for its type."""
    a, b, frame = next(e for step in steps for e in step if kind in e[:2])
    return frame.select(F.col(kind if a != b else "from").alias(kind))


def attached(tables: Sequence[tuple[DataFrame, str]], core: Mapping[str, DataFrame], artifact: str, start: str, end: str, roots: DataFrame | None = None) -> DataFrame:
    """Distinct artifacts of rows that name an entity of the core, in a time window, and the roots.

    tables: (frame, its time). What is attached never widens the core.
    """
    out = None if roots is None else roots.select(artifact)
    for frame, ts in tables:
        rows = frame.filter(F.col(artifact).isNotNull() & (F.col(ts) >= F.lit(start).cast("timestamp")) & (F.col(ts) < F.lit(end).cast("timestamp")))
        for kind, entities in core.items():
            if kind in frame.columns:
                hit = rows.join(entities, kind, "left_semi").select(artifact)
                out = hit if out is None else out.union(hit)
    return out.distinct()


def membership(df: DataFrame, vins: DataFrame | None, listings: DataFrame, ts: str, start: str, end: str, vin: str = "vin", listing: str = "listing_id", exact: DataFrame | None = None, exact_on: Sequence[str] = ()) -> DataFrame:
    """Rows of the window whose VIN or listing is a member, and exact rows from any time."""
    inside = (F.col(ts) >= F.lit(start).cast("timestamp")) & (F.col(ts) < F.lit(end).cast("timestamp"))
    out = df.join(listings.select(F.col(listing).alias("__l"), F.lit(True).alias("__hit_l")).distinct(), F.col(listing) == F.col("__l"), "left")
    hit = F.coalesce("__hit_l", F.lit(False))
    if vins is not None:
        out = out.join(vins.select(F.col(vin).alias("__v"), F.lit(True).alias("__hit_v")).distinct(), F.col(vin) == F.col("__v"), "left")
        hit = hit | F.coalesce("__hit_v", F.lit(False))
    hit = hit & inside
    if exact is not None:
        e = exact.select(*[F.col(c).alias(f"__e_{c}") for c in exact_on], F.lit(True).alias("__hit_e")).distinct()
        out = out.join(e, [F.col(c).eqNullSafe(F.col(f"__e_{c}")) for c in exact_on], "left")
        hit = hit | F.coalesce("__hit_e", F.lit(False))
    return out.filter(hit).select(*df.columns).distinct()


def source_audit(tables: Mapping[str, tuple[DataFrame, str, str | None, str | None]]) -> DataFrame:
    """Per table (frame, time, VIN and listing column): rows, time range, distinct VINs and listings."""
    out = None
    for name, (df, ts, vin, listing) in tables.items():
        n = lambda c: F.count_distinct(c) if c else F.lit(None).cast("long")
        one = df.agg(F.count("*").alias("rows"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"), n(vin).alias("vins"), n(listing).alias("listings")).select(F.lit(name).alias("table_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def relative_window(anchor: str | Column, months: int, unit: str = "WEEK") -> tuple[Column, Column]:
    """(start, end): the anchor truncated to its unit, and so many months before, day clamped."""
    end = F.date_trunc(unit, X.as_of(anchor))
    return F.add_months(end, -months).cast("timestamp"), end
