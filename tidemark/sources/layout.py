"""Table layout: compaction of closed months, rewrites, audits."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL = 1 << 20
#: Bytes of a compacted file: a partition of more becomes several files, each written by a task of its own.
TARGET = 256 << 20
#: Partitions compacted side by side.
AT_ONCE = 8


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """(partition, file, bytes, rows) of a table's Parquet files."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    return df.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows")).withColumn("partition", F.regexp_extract("file", r"((?:[^/=]+=[^/]+/)*)[^/]+$", 1))


def compaction_states(spark: SparkSession, path: str, year: str, month: str, today: str, quiet_days: int = 2) -> DataFrame:
    """Per partition of a month closed since quiet_days: needs_compaction, incremental, done or empty.

    A compacted file's name is unknown to Spark's writer, so a partition of no more files than its bytes
    make up (TARGET) is done, one of a large file and small ones is incremental, any other is due.
    """
    f = files_of(spark, path)
    part = f.groupBy("partition").agg(F.count("*").alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.max("rows").alias("largest"))
    part = part.withColumn("y", F.regexp_extract("partition", f"{year}=(\\d+)", 1).cast("int")).withColumn("m", F.regexp_extract("partition", f"{month}=(\\d+)", 1).cast("int"))
    closed = F.add_months(F.make_date("y", "m", F.lit(1)), 1) <= F.date_sub(F.lit(today).cast("date"), quiet_days)
    state = F.when(F.col("rows") == 0, "empty").when(F.col("files") <= F.greatest(F.lit(1), F.ceil(F.col("bytes") / TARGET)), "done").when(F.col("largest") * 2 > F.col("rows"), "incremental").otherwise("needs_compaction")
    return part.filter((F.col("m") > 0) & closed).select("partition", "files", "rows", "bytes", state.alias("state"))


def swap(spark: SparkSession, new: str, folder: str, old: str) -> None:
    """Put the folder `new` in the place of `folder`, which waits at `old` until that is done.

    A run that died between the renames has left `old` and no `folder`; recover() puts it back.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop(old).getParent())
    there = fs.exists(hadoop(folder))
    if there and not fs.rename(hadoop(folder), hadoop(old)):
        raise OSError(f"{folder} could not be moved to {old}")
    if not fs.rename(hadoop(new), hadoop(folder)):
        if there:
            fs.rename(hadoop(old), hadoop(folder))
        raise OSError(f"{new} could not be moved to {folder}")
    fs.delete(hadoop(old), True)


def recover(spark: SparkSession, folder: str, old: str) -> None:
    """Undo or end a swap that was cut short: without `folder`, what waits at `old` goes back."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(hadoop(old)):
        if fs.exists(hadoop(folder)):
            fs.delete(hadoop(old), True)
        elif not fs.rename(hadoop(old), hadoop(folder)):
            raise OSError(f"{old} could not be moved back to {folder}")


def recover_all(spark: SparkSession, path: str, depth: int) -> None:
    """recover() for every partition folder, `depth` levels down, that waits under path/_old."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    root = hadoop(f"{path.rstrip('/')}/_old")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop(root, "/".join("*" * depth))) if fs.exists(root) else []
    for status in found or []:
        part = "/".join(status.getPath().toString().rstrip("/").split("/")[-depth:])
        recover(spark, f"{path.rstrip('/')}/{part}", f"{path.rstrip('/')}/_old/{part}")


def compact(spark: SparkSession, path: str, partition: str, sort: Sequence[str], files: int = 1) -> tuple[int, int]:
    """Rewrite one partition folder as `files` sorted files; returns rows before and after.

    The new files are written beside, counted, and swapped in by renames; a count that differs raises
    and leaves the old files. A swap that an earlier run did not end is mended first.
    """
    folder, temp, old = (f"{path.rstrip('/')}/{x}" for x in (partition.strip("/"), f"_compact/{partition.strip('/')}", f"_old/{partition.strip('/')}"))
    recover(spark, folder, old)
    df = spark.read.option("mergeSchema", "true").parquet(folder)
    before = df.count()
    keys = [c for c in sort if c in df.columns]
    rows = df.repartitionByRange(files, *keys).sortWithinPartitions(*keys) if files > 1 else df.coalesce(1).sortWithinPartitions(*keys)
    rows.write.mode("overwrite").option("compression", "zstd").parquet(temp)
    after = spark.read.parquet(temp).count()
    if after != before:
        raise ValueError(f"{folder}: {before} rows, {after} after compaction")
    swap(spark, temp, folder, old)
    return before, after


def compact_due(spark: SparkSession, path: str, year: str, month: str, today: str, sort: Sequence[str], most: int = 12) -> list[tuple[str, int, int]]:
    """Compact the oldest due partitions, at most so many, into files of about TARGET bytes, some at a time."""
    recover_all(spark, path, 2)
    due = compaction_states(spark, path, year, month, today).filter(F.col("state").isin("needs_compaction", "incremental"))
    with ThreadPoolExecutor(AT_ONCE) as pool:
        one = lambda r: (r["partition"], *compact(spark, path, r["partition"], sort, max(1, -(-r["bytes"] // TARGET))))
        return list(pool.map(one, due.orderBy("partition").limit(most).collect()))


def rewrite_months(df: DataFrame, path: str, ts: str, sort: Sequence[str], extra: Sequence[str] = (), baseline: int | None = None) -> int:
    """Write a day-partitioned table by year and month, sorted; returns its rows.

    Month columns live in the path only. A row count other than the baseline (by default the source's)
    raises before anything is replaced. A month of many rows is split over tasks by the adaptive rebalance.
    """
    recover(df.sparkSession, f"{path}/table", f"{path}/_old")
    rows = df.drop("year", "month", "day").withColumn("year", F.coalesce(F.year(ts), F.lit(0))).withColumn("month", F.coalesce(F.month(ts), F.lit(0)))
    wanted = df.count() if baseline is None else baseline
    parts = [*extra, "year", "month"]
    rows.hint("rebalance", *parts).sortWithinPartitions(*parts, *sort).write.mode("error").option("compression", "zstd").partitionBy(*parts).parquet(f"{path}/_staged")
    spark = df.sparkSession
    got = spark.read.parquet(f"{path}/_staged").count()
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if got != wanted:
        fs.delete(hadoop(f"{path}/_staged"), True)
        raise ValueError(f"{got} rows written, {wanted} wanted")
    swap(spark, f"{path}/_staged", f"{path}/table", f"{path}/_old")
    return got


def schema_fingerprint(df: DataFrame) -> str:
    """12 hex digits of the md5 of the columns' name-sorted name:type."""
    text = ",".join(sorted(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields))
    return hashlib.md5(text.encode()).hexdigest()[:12]


def audit(spark: SparkSession, path: str, ts: str | None = None, expected: str = r"^(?:[^/=]+=[^/]+/)+$") -> DataFrame:
    """Per partition: files, bytes, small files, rows, time range, and if its path is as expected."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    times = [F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")] if ts else []
    f = df.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).agg(F.count("*").alias("n"), *times)
    f = f.withColumn("partition", F.regexp_extract("file", r"((?:[^/=]+=[^/]+/)*)[^/]+$", 1))
    out = f.groupBy("partition").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.count_if(F.col("size") < SMALL).alias("small_files"), F.sum("n").alias("rows"), *([F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts")] if ts else []))
    return out.withColumn("expected_path", F.col("partition").rlike(expected))


def schema_variants(spark: SparkSession, folders: Sequence[str]) -> dict[str, str]:
    """The schema fingerprint of each partition folder."""
    return {f: schema_fingerprint(spark.read.parquet(f)) for f in folders}
