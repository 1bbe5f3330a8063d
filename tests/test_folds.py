"""Stateful folds over several files, restarted, repeated and out of order, against the batch folds."""

import random

import pandas as pd
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import incremental, marts, state
from tidemark.streaming import folds, streams


def log(spark, n=240, seed=1):
    """Events (k, ts, id, place, price, kind) in a random order, with nulls."""
    r = random.Random(seed)
    data = [(r.choice("abcdef"), f"2026-01-{1 + r.randrange(20):02d} {r.randrange(24):02d}:{r.randrange(60):02d}:00", i, r.randrange(3), r.choice([None, r.randrange(1 << 60)]), r.choice(["add", "add", "add", "delete"])) for i in range(n)]
    r.shuffle(data)
    return data, lambda part: spark.createDataFrame(part, "k string, ts string, id long, place int, price long, kind string").withColumn("ts", F.to_timestamp("ts"))


def streamed(spark, tmp_path, waves, make, key="k"):
    """Each wave is a file; the stream is started anew for every second one."""
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    with folds.state_store(spark):
        for i, wave in enumerate(waves):
            wave.coalesce(1).write.mode("append").parquet(src)
            if i % 2 or i == len(waves) - 1:
                folds.kept(make(streams.source(spark, src, spark.read.parquet(src).schema, 1)), out, ck).start().awaitTermination()
    return out


@pytest.mark.parametrize("case", ["fold", "deleted", "mapping", "attempts"])
def test_folds_equal_batch_folds(spark, tmp_path, case):
    data, frame = log(spark)
    whole, gone = frame(data), F.col("kind") == "delete"
    batch, make = {
        "fold": (lambda d: state.fold(d, "k", ["ts", "id"], ["place"], ["price", "kind"]), lambda s: folds.fold(s, "k", ["ts", "id"], ["place"], ["price", "kind"])),
        "deleted": (lambda d: state.fold(d, "k", ["ts", "id"], ["place"], ["price"], gone), lambda s: folds.fold(s, "k", ["ts", "id"], ["place"], ["price"], gone)),
        "mapping": (lambda d: state.newest_mapping(d.withColumn("ts", F.date_trunc("day", "ts")), "k", "place", "ts"), lambda s: folds.newest_mapping(s.withColumn("ts", F.date_trunc("day", "ts")), "k", "place", "ts")),
        "attempts": (lambda d: state.attempt_counter(d, "k", "ts", "id", gone), lambda s: folds.attempt_counter(s, "k", "ts", "id", gone)),
    }[case]
    # the second file is delivered twice
    out = streamed(spark, tmp_path, [frame(data[a:b]) for a, b in ((0, 80), (80, 160), (80, 160), (160, 240))], make)
    want = batch(whole)
    assert rows(folds.current(spark, out, "k").select(*want.columns)) == rows(want) and want.count() > 2
    assert len({r["batch"] for r in spark.read.parquet(out).select("batch").distinct().collect()}) >= 3


def test_a_batch_again_changes_nothing(spark, tmp_path):
    data, frame = log(spark, 60)
    out = streamed(spark, tmp_path, [frame(data)], lambda s: folds.fold(s, "k", ["ts", "id"], ["place"]))
    before = rows(folds.current(spark, out, "k"))
    (tmp_path / "ck/commits/0").unlink()  # died after the write, before the commit
    (tmp_path / "ck/commits/.0.crc").unlink(missing_ok=True)
    with folds.state_store(spark):
        src = str(tmp_path / "in")
        folds.kept(folds.fold(streams.source(spark, src, spark.read.parquet(src).schema), "k", ["ts", "id"], ["place"]), out, str(tmp_path / "ck")).start().awaitTermination()
    assert rows(folds.current(spark, out, "k")) == before and spark.read.parquet(out).select("batch").distinct().count() == 1


def test_relistings_in_order_and_late(spark, tmp_path):
    data, frame = log(spark)
    data.sort(key=lambda r: (r[1], r[2]))
    late = [("a", "2026-01-01 00:00:00", 9999, 7, None, "add")]
    out = streamed(spark, tmp_path, [frame(data[:100]), frame(data[100:]), frame(late)], lambda s: folds.relistings(s, "k", "place", "ts", "id"))
    got = spark.read.parquet(out).drop("batch")
    want = state.relistings(frame(data), "k", "place", "ts", "id")
    assert rows(got.filter("event_type <> 'late'").select(*want.columns)) == rows(want)
    assert rows(got.filter("event_type = 'late'"), "k", "place") == [("a", 7)]


def test_hourly_distincts(spark, tmp_path):
    """Over several micro-batches; an hour that the watermark passed is final and cleared, its late rows go to the batch form."""
    r = random.Random(3)
    hour = lambda h: [(r.randrange(9), r.choice([None, r.randrange(20)]), f"2026-01-{1 + h // 24:02d} {h % 24:02d}:{r.randrange(60):02d}:00", r.choice(["detail", "srp"]), r.random() < 0.5) for _ in range(30)]
    frame = lambda data: spark.createDataFrame(data, "artifact int, listing int, ts string, source string, ok boolean").withColumn("ts", F.to_timestamp("ts"))
    waves = [hour(0) + hour(1), hour(1) + hour(2), hour(0) + hour(3), hour(30), hour(31)]
    make = lambda d: marts.scrape_volume(d, "ts", "source", "artifact", "listing", F.col("ok"))
    out = streamed(spark, tmp_path, [frame(w) for w in waves], lambda s: folds.hourly_distincts(s, "ts", "source", "artifact", "listing", F.col("ok"), "12 hours", 3))
    parts = folds.current(spark, out, ["hour", "source", "kind", "part"])
    want = make(frame(sum(waves, [])))
    assert rows(folds.volume(parts).select(*want.columns)) == rows(want)
    assert {x[0].hour for x in rows(parts.filter("final"), "hour")} == {0, 1, 2, 3} and parts.filter("not final").count() > 0
    # a row for an hour long emitted changes nothing here; the batch form takes it in
    src = str(tmp_path / "in")
    frame([(99, 99, "2026-01-01 00:10:00", "srp", True)]).coalesce(1).write.mode("append").parquet(src)
    with folds.state_store(spark):
        folds.kept(folds.hourly_distincts(streams.source(spark, src, spark.read.parquet(src).schema, 1), "ts", "source", "artifact", "listing", F.col("ok"), "12 hours", 3), out, str(tmp_path / "ck")).start().awaitTermination()
    again = folds.volume(folds.current(spark, out, ["hour", "source", "kind", "part"])).select(*want.columns)
    assert rows(again) == rows(want)
    delivered = spark.read.parquet(src)
    assert rows(incremental.time_window(delivered, again, "ts", "hour", "72 HOURS", make, "hour", ["hour", "source"]).select(*want.columns)) == rows(make(delivered).select(*want.columns))


class Handle:
    """A state server of one map, counting what is asked of it."""

    def __init__(self):
        self.map, self.asked, self.names = {}, 0, []

    def getMapState(self, name, *types):
        self.names.append(name)
        return self

    def exists(self):
        return bool(self.map)

    def getValue(self, key):
        self.asked += 1
        return self.map.get(key)

    def updateValue(self, key, value):
        self.map[key] = value


def test_one_call_serves_many_keys():
    """Frames of all keys of a group give one frame, and a stored state is asked for once a touched key."""
    fold, handle = folds.Attempts(["key", "first", "last", "num_of_attempts", "gone"], "long", None), Handle()
    fold.init(handle)
    frame = lambda a, b, cleared: pd.DataFrame([(0, str(i % 500), i, i, cleared) for i in range(a, b)], columns=["group", "key", "ts", "tie", "cleared"])
    call = lambda *frames: [x for pdf in fold.handleInputRows((0,), iter(frames), None) for x in pdf.itertuples(index=False, name=None)]
    got = call(frame(0, 700, False), frame(700, 1500, False))
    assert sorted(got) == sorted((str(i), i, i + 1000, 3, False) for i in range(500)) and handle.asked == 0 and len(handle.map) == 500
    got = call(frame(1500, 1600, True), frame(1550, 1560, False))  # later than all of these keys; the second is a tie of what cleared
    assert sorted(got) == sorted((str(i), None, None, 0, True) for i in range(100)) and handle.asked == 100
    call(frame(1500, 1501, True))
    assert handle.map["0",] == (1500, 1500, [], []) and handle.asked == 101


@pytest.mark.parametrize("kind,keys", [("bigint", [None, 1 << 60, (1 << 60) + 1]), ("double", [0.0, -0.0, 1e300]), ("timestamp", ["2026-01-01 00:00:00.000001", "2026-01-01 00:00:00.000002"]), ("binary", ["a", "b"])])
def test_keys_of_all_kinds(spark, tmp_path, kind, keys):
    data = [(i, 2 * i) for i in range(12)]
    values = F.array(*[F.lit(k).cast(kind) for k in keys])
    frame = spark.createDataFrame(data, "id long, price long").withColumns({"k": F.element_at(values, (F.col("id") % len(keys) + 1).cast("int")), "ts": F.timestamp_seconds("id")})
    out = streamed(spark, tmp_path, [frame.filter("id < 5"), frame.filter("id >= 5")], lambda s: folds.fold(s, "k", ["ts", "id"], ["price"], groups=2))
    want = state.fold(frame, "k", ["ts", "id"], ["price"])
    got = folds.current(spark, out, "k")
    assert rows(got.select(*want.columns)) == rows(want) and dict(got.dtypes)["k"] == kind
