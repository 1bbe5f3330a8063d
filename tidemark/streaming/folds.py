"""Current state as streams: folds with a state a key, and exact distinct counts by hour.

Every fold's state is what the batch form of tidemark.operators.state keeps, merged row by row so that
order of arrival does not matter and repeated rows change nothing. Each micro-batch gives the new state
of the keys that it touched; kept() writes it under the batch's number, so a batch that is run again
overwrites itself, and current() reads each key's last. Spark's checkpoint holds the states: a restart
goes on where it ended. All need the RocksDB state store (state_store()).

A fold's keys are dealt by hash to `groups` groups, and a group's states are a map by key: Python is called
once a group with frames of many keys, and only the states of keys that the batch touches are read and
written. (With a call for each key, 7 ms of a task went to its frames and requests.) A task takes one group's rows of a batch
after another, so groups should be several times the shuffle partitions; a checkpoint goes with their number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import exprs as X
from tidemark.operators import marts

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
GROUPS = 4096


@contextmanager
def state_store(spark: SparkSession):
    """Within it, streams keep their states in RocksDB."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def as_order(c: str, kind: str) -> Column:
    """An order column as what Python can compare exactly."""
    return F.unix_micros(F.col(c).cast("timestamp")) if kind in ("timestamp", "date", "timestamp_ntz") else F.col(c).cast("string" if kind == "string" else "long")


def from_order(c: Column, kind: str) -> Column:
    return F.timestamp_micros(c).cast(kind) if kind in ("timestamp", "date", "timestamp_ntz") else c.cast(kind)


def as_text(c: str, kind: str) -> Column:
    """A key of an atomic type as text, equal for equal keys; from_text() gives it back."""
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("string")
    if kind in ("double", "float"):  # 0.0 and -0.0 are one key
        return (F.col(c) + F.lit(0.0)).cast(kind).cast("string")
    return F.hex(c) if kind == "binary" else F.col(c).cast("string")


def from_text(c: Column, kind: str) -> Column:
    if kind in ("timestamp", "timestamp_ntz"):
        return F.timestamp_micros(c.cast("long")).cast(kind)
    return F.unhex(c) if kind == "binary" else c.cast(kind)


class Fold(StatefulProcessor):
    """The states of a group's keys as a map: merge() takes rows in, emitted() gives a key's rows.

    What a batch touches of a group is in memory until its end, as a key is emitted once.
    """

    def __init__(self, fields: list[tuple[str, str]], ttl_ms: int | None):
        self.fields, self.ttl = T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields)), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.states = handle.getMapState("states", T.StructType([T.StructField("key", T.StringType())]), self.fields, self.ttl)

    def handleInputRows(self, group, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.states.exists()  # else there is nothing to look up
        states: dict[str | None, tuple] = {}
        out: dict[str | None, list[tuple]] = {}
        for pdf in rows:
            for _, key, *r in pdf.itertuples(index=False, name=None):
                key = None if key != key else key
                if key not in states:
                    found = self.states.getValue((key,)) if known else None
                    states[key], out[key] = None if found is None else self.opened(tuple(found)), []
                states[key] = self.merge(states[key], tuple(None if v is None or v is pd.NA or v != v else v for v in r), out[key])
        for key, state in states.items():
            states[key] = self.closed(state)
            self.states.updateValue((key,), states[key])
        yield pd.DataFrame([(key, *x) for key, state in states.items() for x in self.emitted(state, out[key])], columns=self.columns, dtype=object)

    def opened(self, state: tuple) -> tuple:
        """A stored state in the form that merge() takes; closed() is its reverse."""
        return state

    def closed(self, state: tuple) -> tuple:
        return state

    def close(self) -> None:
        pass


class Latest(Fold):
    """The last row's `take`, and each of `keep`'s last value, after the last deletion."""

    def __init__(self, order: list[str], n_take: int, n_keep: int, smaller: bool, columns: list[str], ttl_ms: int | None):
        of = lambda p: [(f"{p}{i}", kind) for i, kind in enumerate(order)]
        fields = of("top") + [(f"take{i}", "string") for i in range(n_take)] + [x for k in range(n_keep) for x in [*of(f"at{k}_"), (f"keep{k}", "string")]] + of("gone")
        super().__init__(fields, ttl_ms)
        self.n, self.take, self.keep, self.smaller, self.columns = len(order), n_take, n_keep, smaller, columns

    def after(self, a: tuple, b: tuple) -> bool:
        """Is order a later than b? No order is earliest; with `smaller`, of equal ones the smaller last part is later."""
        if a[0] is None or b[0] is None:
            return a[0] is not None
        return a[:-1] > b[:-1] or a[:-1] == b[:-1] and (a[-1] < b[-1] if self.smaller else a[-1] > b[-1])

    def merge(self, state: tuple | None, row: tuple, out: list) -> tuple:
        n, t = self.n, self.take
        order, take, keep, deleted = row[:n], row[n : n + t], row[n + t : n + t + self.keep], row[-1]
        nothing = (None,) * n
        state = state or nothing + (None,) * t + (nothing + (None,)) * self.keep + nothing
        top, own, rest, gone = state[:n], state[n : n + t], state[n + t : -n], state[-n:]
        cells = [(rest[k * (n + 1) : k * (n + 1) + n], rest[k * (n + 1) + n]) for k in range(self.keep)]
        if deleted:
            if self.after(order, gone):
                gone = order
                top, own = (top, own) if self.after(top, gone) else (nothing, (None,) * t)
                cells = [c if self.after(c[0], gone) else (nothing, None) for c in cells]
        elif self.after(order, gone):
            if self.after(order, top):
                top, own = order, take
            cells = [(order, v) if v is not None and self.after(order, c[0]) else c for c, v in zip(cells, keep, strict=True)]
        return top + own + tuple(x for c in cells for x in (*c[0], c[1])) + gone

    def emitted(self, state: tuple | None, out: list) -> list[tuple]:
        n, t = self.n, self.take
        rest = state[n + t : -n]
        return [state[: n + t] + tuple(rest[k * (n + 1) + n] for k in range(self.keep)) + (state[0] is None,)]


class Places(Fold):
    """Mapping events as they come; rows older than the key's state are given back as late, for a rebuild of the key."""

    def __init__(self, columns: list[str], tie: str, ttl_ms: int | None):
        super().__init__([("at", "long"), ("tie", tie), ("place", "string")], ttl_ms)
        self.columns = columns

    def handleInputRows(self, group, rows, timerValues):
        return super().handleInputRows(group, iter([pd.concat(list(rows)).sort_values(["ts", "tie"], kind="stable")]), timerValues)

    def merge(self, state: tuple | None, row: tuple, out: list) -> tuple:
        at, tie, place = row
        if state is None or state[2] is None:
            out.append((place, at, "mapped", None))
        elif (at, tie) < tuple(state[:2]):
            out.append((place, at, "late", None))
            return state
        elif state[2] != place and (at, tie) != tuple(state[:2]):
            out.append((place, at, "remapped", state[2]))
        return at, tie, place

    def emitted(self, state: tuple | None, out: list) -> list[tuple]:
        return out


class Attempts(Fold):
    """A key's attempts since it was last cleared; they all are in its state."""

    def __init__(self, columns: list[str], tie: str, ttl_ms: int | None):
        super().__init__([("at", "long"), ("tie", tie), ("ats", "array<long>"), ("ties", f"array<{tie}>")], ttl_ms)
        self.columns = columns

    def merge(self, state: tuple | None, row: tuple, out: list) -> tuple:
        *order, cleared = row
        last, tries = state or (None, set())
        if last is None or tuple(order) > last:
            if cleared:
                last, tries = tuple(order), {x for x in tries if x > tuple(order)}
            else:
                tries.add(tuple(order))
        return last, tries

    def opened(self, state: tuple) -> tuple:
        since, tie, ats, ties = state
        return None if since is None else (since, tie), set(zip(ats, ties, strict=True))

    def closed(self, state: tuple) -> tuple:
        last, tries = state
        ordered = sorted(tries)
        return *(last or (None, None)), [x[0] for x in ordered], [x[1] for x in ordered]

    def emitted(self, state: tuple | None, out: list) -> list[tuple]:
        ats = list(state[2])
        return [(min(ats, default=None), max(ats, default=None), len(ats), not ats)]


def grouped(stream: DataFrame, key: str, columns: Sequence[Column], processor: Fold, out: str, ttl_ms: int | None, groups: int) -> DataFrame:
    """(key, *out) of a processor over groups of keys."""
    kind = dict(stream.dtypes)[key]
    rows = stream.select(as_text(key, kind).alias("key"), *columns)
    rows = rows.select(F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int").alias("group"), "*")
    done = rows.groupBy("group").transformWithStateInPandas(processor, T.StructType.fromDDL(f"key string, {out}"), "update", "processingTime" if ttl_ms else "none")
    return done.select(from_text(F.col("key"), kind).alias("__key"), *[c for c in done.columns if c != "key"])


def fold(stream: DataFrame, key: str, order: Sequence[str], take: Sequence[str], keep: Sequence[str] = (), deleted: Column | None = None, smaller: bool = False, ttl_ms: int | None = None, groups: int = GROUPS) -> DataFrame:
    """state.fold as a stream: key, order, take, keep, and gone for keys that have no state.

    Order columns must not be null. With `smaller`, of equal orders but for the last column the smaller one wins.
    A key that got no row for ttl_ms is forgotten: its next row is its first.
    """
    kinds = dict(stream.dtypes)
    kept = ["string" if kinds[c] == "string" else "long" for c in order]
    columns = [as_order(c, kinds[c]).alias(f"o{i}") for i, c in enumerate(order)] + [F.col(c).cast("string").alias(f"v{i}") for i, c in enumerate((*take, *keep))]
    names = ["key", *[f"o{i}" for i in range(len(order))], *[f"v{i}" for i in range(len(take) + len(keep))], "gone"]
    ddl = ", ".join([*[f"o{i} {x}" for i, x in enumerate(kept)], *[f"v{i} string" for i in range(len(take) + len(keep))], "gone boolean"])
    out = grouped(stream, key, [*columns, F.coalesce(deleted if deleted is not None else F.lit(False), F.lit(False)).alias("deleted")], Latest(kept, len(take), len(keep), smaller, names, ttl_ms), ddl, ttl_ms, groups)
    return out.select(F.col("__key").alias(key), *[from_order(F.col(f"o{i}"), kinds[c]).alias(c) for i, c in enumerate(order)], *[F.col(f"v{i}").cast(kinds[c]).alias(c) for i, c in enumerate((*take, *keep))], "gone")


def newest_mapping(stream: DataFrame, key: str, value: str, ts: str, ttl_ms: int | None = None, groups: int = GROUPS) -> DataFrame:
    """state.newest_mapping as a stream: key, value, ts, gone."""
    return fold(stream, key, [ts, value], [], smaller=True, ttl_ms=ttl_ms, groups=groups).select(key, value, ts, "gone")


def relistings(stream: DataFrame, key: str, place: str, ts: str, tie: str, ttl_ms: int | None = None, groups: int = GROUPS) -> DataFrame:
    """state.relistings as a stream: key, place, ts, event_type, previous.

    A row older than its key's newest comes back with event_type late: the key is to be built anew from the
    log (incremental.affected), as its neighbours' events may change. The newest row again gives nothing.
    """
    kinds = dict(stream.dtypes)
    ddl = "place string, at long, event_type string, previous string"
    kind = "string" if kinds[tie] == "string" else "long"
    out = grouped(stream, key, [as_order(ts, kinds[ts]).alias("ts"), as_order(tie, kinds[tie]).alias("tie"), F.col(place).cast("string").alias("place")], Places(["key", "place", "at", "event_type", "previous"], kind, ttl_ms), ddl, ttl_ms, groups)
    return out.select(F.col("__key").alias(key), F.col("place").cast(kinds[place]).alias(place), from_order(F.col("at"), kinds[ts]).alias(ts), "event_type", F.col("previous").cast(kinds[place]).alias("previous"))


def attempt_counter(stream: DataFrame, key: str, ts: str, tie: str, cleared: Column, ttl_ms: int | None = None, groups: int = GROUPS) -> DataFrame:
    """state.attempt_counter as a stream, with gone for cleared keys."""
    kinds = dict(stream.dtypes)
    names = ["key", "first", "last", "num_of_attempts", "gone"]
    ddl = "first long, last long, num_of_attempts long, gone boolean"
    kind = "string" if kinds[tie] == "string" else "long"
    out = grouped(stream, key, [as_order(ts, kinds[ts]).alias("ts"), as_order(tie, kinds[tie]).alias("tie"), F.coalesce(cleared, F.lit(False)).alias("cleared")], Attempts(names, kind, ttl_ms), ddl, ttl_ms, groups)
    return out.select(F.col("__key").alias(key), from_order(F.col("first"), kinds[ts]).alias("first_attempted_at"), from_order(F.col("last"), kinds[ts]).alias("last_attempted_at"), "num_of_attempts", "gone")


def kept(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writes what a stream emits to path, each micro-batch in a folder of its own that a second try overwrites."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True)


def current(spark: SparkSession, path: str, key: str | Sequence[str]) -> DataFrame:
    """The last state of every key that kept() wrote; keys that are gone are left out."""
    rows = spark.read.parquet(path)
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])
    return last.filter("not gone").drop("gone") if "gone" in rest else last


# exact distinct counts by hour


class HourSets(StatefulProcessor):
    """Of one hour, source, kind and part: the set of ids, rows and valid rows. Cleared by a timer."""

    def __init__(self):
        self.types = [T.StructType.fromDDL(x) for x in ("id string", "one boolean", "n_ids long, n_rows long, n_valid long")]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ids = handle.getMapState("ids", *self.types[:2])
        self.counts = handle.getValueState("counts", self.types[2])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n_ids, n_rows, n_valid = self.counts.get() if self.counts.exists() else (0, 0, 0)
        if not n_rows:
            self.handle.registerTimer(int(pd.Timestamp(key[0]).timestamp() * 1000) + 3_600_000)
        first = not n_rows  # nothing to look up then
        known: set[str] = set()
        for pdf in rows:
            n_rows, n_valid = n_rows + len(pdf), n_valid + int(pdf["valid"].sum())
            for x in pdf["id"].dropna().unique().tolist():
                if x not in known and (first or not self.ids.containsKey((x,))):
                    self.ids.updateValue((x,), (True,))
                    n_ids += 1
                if first:
                    known.add(x)
        self.counts.update((n_ids, n_rows, n_valid))
        yield self.row(key, (n_ids, n_rows, n_valid), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.counts.exists():
            yield self.row(key, self.counts.get(), True)
        self.ids.clear()
        self.counts.clear()

    def row(self, key, counts: tuple, final: bool) -> pd.DataFrame:
        return pd.DataFrame([(*key, *counts, final)], columns=["hour", "source", "kind", "part", "n_ids", "n_rows", "n_valid", "final"])

    def close(self) -> None:
        pass


def hourly_distincts(stream: DataFrame, ts: str, source: str, artifact: str, listing: str, valid: Column, late: str = "72 hours", parts: int = 8) -> DataFrame:
    """Parts of each hour's and source's counts of distinct artifacts and listings; volume() adds them up.

    An id belongs to one of `parts` parts by its hash, so no hour's set is in one task. A touched part gives its
    counts after each micro-batch, and a last time, as final, when the watermark has passed its hour by `late`;
    its set is cleared then. Rows later than that are not counted: the batch form (incremental.time_window)
    computes their hours anew.
    """
    pair = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("id"))
    rows = stream.withWatermark(ts, late).select(ts, F.date_trunc("hour", ts).alias("hour"), F.col(source).cast("string").alias("source"), F.coalesce(valid, F.lit(False)).alias("valid"), F.explode(F.array(pair("artifact", artifact), pair("listing", listing))).alias("x"))
    rows = rows.select(ts, "hour", "source", "x.kind", F.coalesce(F.pmod(F.xxhash64("x.id"), F.lit(parts)), F.lit(0)).cast("int").alias("part"), "x.id", "valid")
    out = "hour timestamp, source string, kind string, part int, n_ids long, n_rows long, n_valid long, final boolean"
    return rows.groupBy("hour", "source", "kind", "part").transformWithStateInPandas(HourSets(), T.StructType.fromDDL(out), "update", "eventTime")


def volume(parts: DataFrame, main: str = "detail") -> DataFrame:
    """marts.scrape_volume from the last counts of all parts."""
    of = lambda kind, c: F.sum(F.when(F.col("kind") == kind, F.col(c))).alias
    out = parts.groupBy("hour", "source").agg(of("artifact", "n_ids")("artifact_count"), of("artifact", "n_rows")("observation_count"), of("listing", "n_ids")("unique_listings"), of("artifact", "n_valid")("valid_vins"))
    return marts.volume_facts(out, main)
