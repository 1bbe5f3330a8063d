"""Live tables, page files, line diffs and quantiles of hot groups."""

import random
import time
import uuid

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import duplicates, kpi, ranks, runs, scans
from tidemark.sources import readers, sinks


def test_jdbc_reads_ranges_and_pushes_filters(spark):
    url, live = f"jdbc:derby:memory:{uuid.uuid4().hex}", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    data = [(k, f"n{k % 7}") for k in range(-50, 950)] + [(None, "none")]
    spark.createDataFrame(data, "id long, name string").coalesce(1).write.format("jdbc").option("url", url + ";create=true").option("dbtable", "live").option("createTableColumnTypes", "name VARCHAR(20)").options(**live).save()
    whole = readers.jdbc(spark, url, "live", "id", partitions=4, **live)
    assert whole.rdd.getNumPartitions() == 4 and rows(whole) == sorted(data, key=repr)
    narrow = readers.jdbc(spark, url, "live", "id", (0, 100), 3, **live)  # bounds cut ranges, they drop nothing
    assert rows(narrow) == sorted(data, key=repr)
    some = whole.filter("name = 'n3' and id > 10").select("id")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(NAME,n3)".lower() in plan.lower().replace(" ", "") and "greaterthan(id,10)" in plan.lower()
    assert rows(some) == sorted(((k,) for k, n in data if n == "n3" and k > 10), key=repr)
    assert readers.jdbc(spark, url, '(select * from live where "id" > 5000) x', "id", **live).count() == 0


def test_page_files_round_trip(spark, tmp_path):
    data = [(1, "2024-01-05", "detail", "<p>eins é</p>"), (2, "2024-02-05", "results", "x" * 100_000), (3, "2024-02-06", "detail", ""), (4, "2024-02-06", "detail", None)]
    df = spark.createDataFrame(data, "id long, at string, kind string, html string").withColumn("at", F.to_timestamp("at"))
    for _ in range(2):  # again: the same files
        sinks.write_pages(df, f"file://{tmp_path}", "at", "kind", "id", "html")
    path = str(tmp_path / "html")
    got = readers.pages(spark, path)
    assert rows(got, "page_id", "year", "month", "artifact_type", "html") == sorted([(str(k), 2024, int(at[5:7]), kind, html or "") for k, at, kind, html in data], key=repr)
    assert got.filter("size > 0 and modified_at is not null").count() == 4
    bad = tmp_path / "html/year=2024/month=1/artifact_type=detail/9.html.zst"
    bad.write_bytes(b"no zstd")
    with pytest.raises(Exception, match="(?i)zstd|decompress|invalid|unknown"):
        readers.pages(spark, path).collect()
    assert rows(readers.pages(spark, path, "month = 2 and artifact_type = 'detail'"), "page_id") == [("3",), ("4",)]  # the bad file is not opened
    (tmp_path / "html/year=2024/month=3/artifact_type=x").mkdir(parents=True)
    import gzip

    (tmp_path / "html/year=2024/month=3/artifact_type=x/7.html.gz").write_bytes(gzip.compress(b"gz"))
    (tmp_path / "html/year=2024/month=3/artifact_type=x/8.html").write_bytes(b"plain")
    assert rows(readers.pages(spark, path, F.col("month") == 3), "page_id", "html") == [("7", "gz"), ("8", "plain")]


def brute_common(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_line_diffs_are_shortest():
    r = random.Random(1)
    for _ in range(400):
        a, b = ([r.choice("abcdef"[: r.randint(1, 6)]) for _ in range(r.randint(0, 40))] for _ in range(2))
        assert duplicates.common_lines(a, b) == brute_common(a, b)
    for a, b in ((range(20_000), range(20_000, 0, -1)), ([r.randrange(50) for _ in range(20_000)], [r.randrange(50) for _ in range(20_000)]), ([1] * 20_000, [1, 2] * 10_000)):
        start = time.time()
        duplicates.common_lines(list(a), list(b))
        assert time.time() - start < 3


def test_version_diffs_of_hot_keys_and_ties(spark):
    r = random.Random(2)
    data = [(1, k // 2, "\n".join(r.choice("xyz") for _ in range(5))) for k in range(60)] + [(2, 1, None), (2, 2, "a"), (2, 3, None), (2, 4, "a"), (2, 5, "a"), (None, 1, "a"), (None, 2, "b")]
    got = duplicates.version_diffs(spark.createDataFrame(data, "k int, n int, body string"), "k", "n", "body")
    import hashlib

    want = []
    for key in (1, 2, None):
        own = sorted(((n, b is not None, hashlib.sha256((b or "").encode()).hexdigest(), b) for k, n, b in data if k == key), key=lambda x: x[:3])
        for (_, _, _, a), (n, _, _, b) in zip(own, own[1:], strict=False):
            if a is not None:
                c = brute_common(a.split("\n"), b.split("\n")) if b is not None else 0
                added, removed = (len(b.split("\n")) - c, len(a.split("\n")) - c) if b is not None else (None, None)
                want.append((key, n, added, removed, bool(added or removed)))
    assert rows(got) == sorted(want, key=repr)


def test_quantiles_of_a_group_with_all_rows(spark):
    import numpy as np

    r = random.Random(3)
    data = [("hot", r.choice([r.random() * 1000, float(r.randrange(5)), None])) for _ in range(4000)] + [(None, 1.0), (None, 2.0), ("one", 7.0), ("none", None)]
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    points = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows meet in one range
    try:
        got = {x["g"]: (x["n"], x["q"]) for x in ranks.grouped_quantiles(df, ["g"], "v", points).collect()}
        ranges = df.filter("g = 'hot'").groupBy("g", "v").count().repartitionByRange("g", "v").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranges > 2 and set(got) == {"hot", None, "one"}
    for g in got:
        values = [v for k, v in data if k == g and v is not None]
        assert got[g][0] == len(values) and np.allclose(got[g][1], np.quantile(values, points), rtol=1e-12)


def test_spread_quantiles_equal_plain_ones(spark):
    r = random.Random(4)
    df = spark.createDataFrame([(r.choice(["a", "b", None]), r.randrange(50) if r.random() < 0.9 else None) for _ in range(500)] + [("c", None)], "g string, v int")
    plain, spread = (kpi.price_percentiles(df, ["g"], "v", spread=s) for s in (False, True))
    assert rows(plain) == rows(spread)


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_entities_are_split(spark, many_ranges):
    """Half of all rows are one entity's: scans in ranges equal windows."""
    r = random.Random(5)
    data = [("hot" if k % 2 else r.choice(["a", "b", None]), r.randrange(300), k, r.choice(["x", "x", "x", "y", None]), r.choice([None, *range(5)])) for k in range(1200)]
    df = spark.createDataFrame(data, "e string, ts int, id int, s string, price int").withColumn("ts", F.timestamp_seconds(F.col("ts") * 3600)).repartition(3)
    at = scans.ranged(df, "e", ["ts", "id"])
    assert at.filter("e = 'hot'").select("__part").distinct().count() > 1
    plain, spread = (runs.runs(df, "e", ["ts", "id"], ["s"], first=["price"], spread=x) for x in (False, True))
    assert rows(plain, *sorted(plain.columns)) == rows(spread, *sorted(plain.columns)) and plain.count() > 100
    plain, spread = (runs.price_history(df, "e", "price", "ts", "id", ["s"], spread=x) for x in (False, True))
    assert rows(plain, *sorted(plain.columns)) == rows(spread, *sorted(plain.columns))
    assert runs.runs(df.limit(0), "e", ["ts", "id"], "s", spread=True).count() == 0


def test_joins_of_a_large_table_are_dealt_by_its_size(spark, monkeypatch):
    import re

    from tidemark.plans import catalog
    from tidemark.sources import scratch

    monkeypatch.setattr(scratch, "TASK_BYTES", 1000)
    for name in ("jn4_using", "jn11_elsewhere"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        tasks = {int(n) for n in re.findall(r"RepartitionByExpression \[.*?\], (\d+)", plan)}
        assert tasks and min(tasks) > 20
