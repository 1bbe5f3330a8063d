"""Sinks: partitioned appends, bounded flushes, immutable exports, validated publication, keyed replacement."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator, Mapping, Sequence
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import exports
from tidemark.sources.scratch import ensure_checkpoint_dir


def stamped(obs: DataFrame, now: str | None = None) -> DataFrame:
    """Observations as they are stored: written_at, year, month and day of fetched_at or else written_at,
    blank texts in integer columns null."""
    written = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    out = obs.withColumn("written_at", written)
    at = F.coalesce("fetched_at", "written_at")
    return out.withColumn("obs_year", F.year(at)).withColumn("obs_month", F.month(at)).withColumn("obs_day", F.dayofmonth(at))


def to_integers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text columns as integers; blank or unreadable ones null."""
    return df.withColumns({c: F.trim(F.col(c).cast("string")).try_cast("int") for c in columns})


def append(df: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str] = ()) -> None:
    """Append as zstd Parquet. A partition's rows go to few tasks, so they give few files; a partition of
    very many rows is still split, by the adaptive rebalance."""
    rows = df.hint("rebalance", *partitions)
    if sort:
        rows = rows.sortWithinPartitions(*partitions, *sort)
    rows.write.mode("append").option("compression", "zstd").partitionBy(*partitions).parquet(path)


def append_observations(obs: DataFrame, path: str, now: str | None = None) -> None:
    append(stamped(obs, now), path, ["source", "obs_year", "obs_month"])


def append_events(events: DataFrame, path: str, ts: str = "event_at") -> None:
    """Events by year and month of their time; 0 and 0 if it is null."""
    rows = events.withColumn("year", F.coalesce(F.year(ts), F.lit(0))).withColumn("month", F.coalesce(F.month(ts), F.lit(0)))
    append(rows, path, ["year", "month"])


def flush_bounded(source: DataFrame, key: str, write) -> int | None:
    """Hand write() the rows up to the greatest key there is now, and return that key: what comes later
    waits for the next flush. The caller deletes up to it after success (at least once)."""
    top = source.agg(F.max(key)).first()[0]
    if top is not None:
        write(source.filter(F.col(key) <= top))
    return top


def hashed(df: DataFrame) -> Column:
    """A hash of a frame's rows, as text, that does not depend on their order. An aggregate."""
    return F.coalesce(F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("string")


def content_hash(df: DataFrame) -> DataFrame:
    """(rows, content_hash)."""
    return df.agg(F.count("*").alias("rows"), hashed(df).alias("content_hash"))


def export(tables: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]], path: str) -> DataFrame:
    """Write tables (frame, partition columns, sort columns) to a new generation folder, and a manifest of rows,
    content hash, files, bytes and SHA-256 of each file. An existing folder is refused.

    Files are hashed while they are written (exports.write_table) and rows on their way there, so nothing is read
    again. A generation is whole once it has _SUCCESS, which comes last; rows counted on the way and in the files must
    agree (ValueError, and no _SUCCESS).
    """
    spark = next(iter(tables.values()))[0].sparkSession
    fs, at = store_of(spark, path)
    if fs.exists(at(path)):
        raise FileExistsError(f"{path} already exists")
    facts = []
    for name, (df, parts, sort) in tables.items():
        seen = Observation()
        exports.write_table(df.observe(seen, F.count("*").alias("rows"), hashed(df).alias("content_hash")), path, name, parts, sort)
        facts.append((name, seen.get["rows"], seen.get["content_hash"]))
    sums = exports.listed(spark, path).groupBy("table_name").agg(F.sum("rows").alias("__rows"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.sort_array(F.collect_list("sha256")).alias("sha256"))
    known = spark.createDataFrame(facts, "table_name string, rows long, content_hash string")
    made = known.join(sums, "table_name", "left").fillna(0, ["__rows", "files", "bytes"])
    if lost := [r["table_name"] for r in made.filter("rows <> __rows").collect()]:
        raise ValueError(f"{path}: rows counted and written differ in {', '.join(lost)}")
    manifest = made.select("table_name", "rows", "content_hash", "files", "bytes", F.coalesce("sha256", F.array().cast("array<string>")).alias("sha256"))
    manifest.coalesce(1).write.mode("error").parquet(f"{path}/_manifest")
    fs.create(at(f"{path}/_SUCCESS"), False).close()
    return spark.read.schema(manifest.schema).parquet(f"{path}/_manifest")


def exported(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A table of a generation that is whole; FileNotFoundError if it isn't, or has no such rows."""
    fs, at = store_of(spark, path)
    if not fs.exists(at(f"{path}/_SUCCESS")) or not fs.exists(at(f"{path}/{name}")):
        raise FileNotFoundError(f"{path}/{name}")
    return spark.read.parquet(f"{path}/{name}")


def publish(df: DataFrame, path: str, version: str, key: str, ts: str | None = None) -> dict:
    """Publish a table version once it is checked: key not null and unique, as many rows as were written.

    The version is written and checked in a hidden folder, with its snapshot's facts, and then renamed to
    path/version=<version>, so readers of path see it whole or not at all. Raises ValueError if a check
    fails and FileExistsError if the version is there; neither leaves anything that can be read.
    Returns the snapshot's facts.
    """
    spark = df.sparkSession
    target, staged = f"{path}/version={version}", f"{path}/_staging/{version}-{uuid.uuid4().hex}"
    fs, at = store_of(spark, path)
    if fs.exists(at(target)):
        raise FileExistsError(target)
    parent = max(snapshots(spark, path), key=lambda x: x["sequence"], default=None)
    seen = Observation()
    df.observe(seen, F.count("*").alias("rows")).write.option("compression", "zstd").parquet(staged)
    try:
        back = spark.read.schema(df.schema).parquet(staged)
        aggs = [F.count("*").alias("rows"), F.count(key).alias("keys"), F.count_distinct(key).alias("distinct_keys")] + ([F.max(ts).cast("string").alias("max_ts")] if ts else [])
        facts = back.agg(*aggs).first().asDict()
        for wrong, what in ((facts["rows"] - facts["keys"], "null keys"), (facts["keys"] - facts["distinct_keys"], "repeated keys"), (seen.get["rows"] - facts["rows"], "rows lost")):
            if wrong:
                raise ValueError(f"{wrong} {what} in version {version} of {path}")
        content = content_hash(back).first()["content_hash"]
        made = {"version": version, "sequence": parent["sequence"] + 1 if parent else 1, "parent_id": parent["snapshot_id"] if parent else None, "content_hash": content, "schema": df.schema.jsonValue(), **facts}
        made = {"snapshot_id": hashlib.sha256(json.dumps(made, sort_keys=True).encode()).hexdigest()[:16], "committed_at": datetime.now(UTC).isoformat(), **made}
        out = fs.create(at(f"{staged}/_snapshot.json"), True)
        out.write(bytearray(json.dumps(made).encode()))
        out.close()
        if not fs.rename(at(staged), at(target)):
            raise OSError(f"{staged} could not be moved to {target}")
    finally:
        fs.delete(at(staged), True)
    return {"location": target, **made}


def snapshots(spark: SparkSession, path: str) -> list[dict]:
    """The facts of every published version of path, one small file each, in order."""
    fs, at = store_of(spark, path)
    found = fs.globStatus(at(f"{path}/version=*/_snapshot.json")) or []
    read = spark._jvm.org.apache.commons.io.IOUtils.toString
    return sorted((json.loads(read(fs.open(x.getPath()), "UTF-8")) for x in found), key=lambda x: x["sequence"])


def store_of(spark: SparkSession, path: str):
    """The file system of a path, and what makes its paths."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark._jsc.hadoopConfiguration()), at


def publish_iceberg(df: DataFrame, name: str) -> None:
    """The same through a catalog, where Iceberg's jar is on the class path."""
    df.writeTo(name).using("iceberg").createOrReplace()


def reconstruct_unlisted(queue_events: DataFrame, mapping_events: DataFrame, price_events: DataFrame, stored: DataFrame) -> DataFrame:
    """Missing 'unlisted' observations, from three logs: each deleted listing's deletion, the VIN it was
    mapped to last, and its page; those already stored are left out."""
    gone = price_events.filter(F.col("event_type") == "deleted").groupBy("listing_id").agg(F.max(F.struct("event_at", "event_id", "artifact_id", "make", "model")).alias("d"))
    vin = mapping_events.groupBy("listing_id").agg(F.max(F.struct("event_at", "event_id", "vin")).alias("m"))
    page = queue_events.filter(F.col("fetched_at").isNotNull()).groupBy("artifact_id").agg(F.max(F.struct("event_at", "event_id", "fetched_at")).alias("q"))
    rows = gone.select("listing_id", F.col("d.artifact_id").alias("artifact_id"), F.col("d.make").alias("make"), F.col("d.model").alias("model")).join(vin, "listing_id").join(page, "artifact_id")
    rows = rows.select("artifact_id", "listing_id", F.col("m.vin").alias("vin"), F.lit("detail").alias("source"), F.lit("unlisted").alias("listing_state"), F.col("q.fetched_at").alias("fetched_at"), "make", "model")
    return rows.join(stored.filter(F.col("listing_state") == "unlisted").select("artifact_id", "listing_id"), ["artifact_id", "listing_id"], "left_anti")


def replace_by_key(spark: SparkSession, path: str, batch: DataFrame, key: str, buckets: int = 64) -> None:
    """Replace the batch's keys in a Parquet table laid out by hash bucket of the key: only buckets that
    the batch touches are read and written again (dynamic partition overwrite). A table keeps its number
    of buckets: take one for each few GB that it will hold; a bucket itself is split over tasks."""
    rows = batch.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    try:
        there = spark.read.parquet(path)
    except Exception as e:  # the first write
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        there = None
    if there is not None:
        ensure_checkpoint_dir(spark)
        touched = rows.select("bucket").distinct()
        keys = rows.select(F.col(key).alias("__k")).distinct()
        old = there.join(F.broadcast(touched), "bucket", "left_semi").join(keys, F.col(key).eqNullSafe(F.col("__k")), "left_anti")
        rows = old.select(*rows.columns).unionByName(rows).checkpoint()  # read before its folders are replaced
    rows.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("bucket").parquet(path)


def aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in its order and types; missing ones null."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def write_pages(df: DataFrame, path: str, ts: str, kind: str, key: str, body: str) -> None:
    """One zstd file a page: html/year=/month=/artifact_type=/<key>.html.zst under path, which pyarrow's file systems must reach.

    Names come from the rows, and a file is moved to its name when it is whole: a task that runs again writes the same files.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        made = set()
        for batch in batches:
            for year, month, kind_, name, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                folder = f"{root}/html/year={year}/month={month}/artifact_type={kind_}"
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{folder}/_{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(part, compression="zstd") as out:
                    out.write((text or "").encode())
                store.move(part, f"{folder}/{name}.html.zst")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["written"])

    rows = df.select(F.year(ts), F.month(ts), F.col(kind).cast("string"), F.col(key).cast("string"), F.col(body))
    rows.mapInArrow(each, "written long").agg(F.sum("written")).first()
