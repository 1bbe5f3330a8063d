"""Tables at rest with a key index: against replacement in memory, byte by byte, cut short and repeated."""

import hashlib
import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators import incremental
from tidemark.sources import indexed

SMALL = {"file_bytes": 4 << 10}


def base_of(spark, n=3000):
    k = F.when(F.col("id") % 500 == 0, None).when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))  # null keys, a key of a third of all rows
    return spark.range(n).select(k.alias("k"), F.concat(F.lit("v"), F.col("id")).alias("v"), F.lit(None).cast("int").alias("z"))


def sums(path):
    return {p.relative_to(path).as_posix(): hashlib.sha256(p.read_bytes()).hexdigest() for p in Path(path).rglob("data/*/*.parquet")}


def test_only_files_with_the_keys_are_written_again(spark, tmp_path):
    path = str(tmp_path / "t")
    base = base_of(spark)
    assert indexed.create(base, path, "k", **SMALL)["files"] > 3
    before, files = sums(path), set(indexed.manifest(spark, path)["file"])
    batch = spark.createDataFrame([(1, "new", 5), (1, "twice", None), (100_000, "added", 6)], "k long, v string, z int")
    indexed.replace(batch, path, **SMALL)
    assert rows(indexed.read(spark, path)) == rows(incremental.replace(base, batch, "k"))
    assert rows(indexed.read(spark, path, 1)) == rows(base)  # the version before
    after = sums(path)
    assert all(after[f] == h for f, h in before.items())
    assert len(files - set(indexed.manifest(spark, path)["file"])) == 1  # that of key 1


def test_null_and_hot_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    base = base_of(spark)
    indexed.create(base, path, ["k"], **SMALL)
    hot = indexed.holding(spark, path, spark.range(1).select(F.xxhash64(F.lit(7).cast("long")).alias("h")))
    assert len(hot) > 1  # split over files
    batch = spark.createDataFrame([(None, "n", 1), (7, "seven", 2)], "k long, v string, z int")
    indexed.replace(batch, path, **SMALL)
    assert rows(indexed.read(spark, path)) == rows(incremental.replace(base, batch, "k"))


def test_two_key_columns_and_other_column_orders(spark, tmp_path):
    path = str(tmp_path / "t")
    base = base_of(spark, 300).withColumn("k2", F.substring("v", 2, 1))
    indexed.create(base, path, ["k", "k2"], **SMALL)
    batch = spark.createDataFrame([("9", 7, "x", True), (None, 7, "y", True)], "k2 string, k int, v string, more boolean")
    indexed.replace(batch, path, **SMALL)
    want = incremental.replace(base, batch.select(F.col("k").cast("long"), "v", F.lit(None).cast("int").alias("z"), "k2"), ["k", "k2"])
    assert rows(indexed.read(spark, path)) == rows(want)


def test_a_repeated_run_and_an_empty_batch_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    indexed.create(base_of(spark, 300), path, "k")
    batch = spark.createDataFrame([(1, "new", 5), (1, "new", 5)], "k long, v string, z int")
    first = indexed.replace(batch, path)
    assert indexed.replace(batch, path) == first == indexed.replace(batch.limit(0), path)
    assert indexed.replace(batch.limit(1), path)["version"] == 3  # one row of two is not the same


def test_runs_that_died(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    base = base_of(spark, 300)
    indexed.create(base, path, "k")
    batch = spark.createDataFrame([(1, "new", 5)], "k long, v string, z int")
    with monkeypatch.context() as m:
        m.setattr(indexed, "json", SimpleNamespace(loads=json.loads, dumps=lambda *_: 1 / 0))
        with pytest.raises(ZeroDivisionError):
            indexed.replace(batch, path)  # all is written but the commit
    assert rows(indexed.read(spark, path)) == rows(base)
    Path(path, "_log", "0000000003").write_text('{"versi')  # a commit cut short
    assert rows(indexed.read(spark, path)) == rows(base)
    assert indexed.replace(batch, path)["version"] == 4
    want = rows(incremental.replace(base, batch, "k"))
    assert rows(indexed.read(spark, path)) == want
    assert indexed.vacuum(spark, path) > 0
    assert set(sums(path)) == set(indexed.manifest(spark, path)["file"])
    assert rows(indexed.read(spark, path)) == want


def test_a_second_writer_gets_an_error(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    indexed.create(base_of(spark, 30), path, "k")
    with pytest.raises(FileExistsError):
        indexed.create(base_of(spark, 30), path, "k")
    monkeypatch.setattr(indexed, "next_version", lambda *_: 1)
    with pytest.raises(Exception, match="exist"):
        indexed.replace(spark.createDataFrame([(1, "new", 5)], "k long, v string, z int"), path)
    assert indexed.commit_at(spark, path)["version"] == 1


def test_from_nothing_and_compaction(spark, tmp_path):
    path = str(tmp_path / "t")
    base = base_of(spark, 300)
    indexed.create(base.limit(0), path, "k")
    assert rows(indexed.read(spark, path)) == []
    for r in range(3):
        indexed.replace(base.filter(F.coalesce("k", F.lit(0)) % 3 == r), path)
    assert len(indexed.manifest(spark, path)) == 3
    indexed.compact(spark, path)
    assert len(indexed.manifest(spark, path)) == 1
    assert indexed.compact(spark, path) == indexed.commit_at(spark, path)
    assert rows(indexed.read(spark, path)) == rows(base)


def test_files_are_what_a_task_can_sort(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(indexed, "estimate", lambda df: 100 << 20)
    path = f"file://{tmp_path}/t"
    indexed.create(spark.range(4000).selectExpr("id as k", "id * 2 as v"), path, "k")
    files = indexed.manifest(spark, path)
    assert len(files) == 4 and files["rows"].sum() == 4000 and indexed.read(spark, path).distinct().count() == 4000
