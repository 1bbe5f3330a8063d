"""Tables at rest with a key index: a batch rewrites only the files that hold its keys.

Files are laid out by ranges of the key's hash. Of each file the manifest has its least and greatest hash,
and an index table has a Bloom filter of its hashes, one 64-bit word a row, so that building and asking it
are aggregates and joins. A batch's keys name files by range, then by filter, then by a scan of their key
columns alone; those files, without the keys, and the batch become new files; all others stay as they are.

path/_log/<version> is the commit: one small file, made last, that names its manifest. Readers go by the
newest whole one, so a run that died leaves files that nothing names, and vacuum() deletes them. One writer
at a time: of two that commit the same version, the second gets an error and changes nothing.

The driver holds a row a file (name, range, sizes), as it does of any table's listing; keys and filters
stay in tasks. A key of very many rows is split over files, whose ranges then share that hash.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.scratch import written
from tidemark.sources.sinks import aligned, content_hash, store_of

#: Bytes of a file, by the size of what it is made from. One task sorts a file's rows, which take some ten times that in memory.
FILE_BYTES = 32 << 20
#: Distinct keys of a word of the filter, and bits that each sets in it.
KEYS_A_WORD, BITS = 5, 4
MANIFEST = "file string, made string, lo long, hi long, rows long, bytes long, words long"


def hashed(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def word_of(h: Column, words: Column) -> Column:
    return F.pmod(F.shiftrightunsigned(F.xxhash64(h), 24), words)


def mask_of(h: Column) -> Column:
    """The bits that a key sets in its word."""
    mixed, mask = F.xxhash64(h), F.lit(0).cast("long")
    for k in range(BITS):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(mixed, 6 * k).bitwiseAND(63).cast("int")))
    return mask


def commits(spark: SparkSession, path: str) -> list[dict]:
    """All whole commits, in order; one that a dying writer cut short does not count."""
    fs, at = store_of(spark, path)
    read = spark._jvm.org.apache.commons.io.IOUtils.toString
    out = []
    for x in fs.globStatus(at(f"{path}/_log/[0-9]*")) or []:
        try:
            out.append(json.loads(read(fs.open(x.getPath()), "UTF-8")))
        except ValueError:
            continue
    return sorted(out, key=lambda c: c["version"])


def commit_at(spark: SparkSession, path: str, version: int | None = None) -> dict:
    found = [c for c in commits(spark, path) if version in (None, c["version"])]
    if not found:
        raise FileNotFoundError(f"{path} has no version {version or ''}")
    return found[-1]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> pd.DataFrame:
    """A row a file of a version."""
    return spark.read.schema(MANIFEST).parquet(f"{path}/_manifests/{commit_at(spark, path, version)['manifest']}").toPandas()


def opened(spark: SparkSession, path: str, schema: T.StructType, files: Sequence[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in files]) if len(files) else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest by default."""
    schema = T.StructType.fromJson(commit_at(spark, path, version)["schema"])
    return opened(spark, path, schema, sorted(manifest(spark, path, version)["file"]))


def estimate(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _commit(rows: DataFrame | None, path: str, keys: Sequence[str], schema: T.StructType, kept: pd.DataFrame, size: int, version: int, file_bytes: int) -> dict:
    """Write rows as new files with their index, then the manifest of kept and new files, then the log's file."""
    spark = SparkSession.active()
    made = uuid.uuid4().hex
    parts = kept
    if rows is not None:
        plain = [f.name for f in schema if not isinstance(f.dataType, T.MapType)]
        n = max(1, -(-size // file_bytes))
        rows = rows.select(*schema.names, hashed(keys).alias("__h"), F.xxhash64(*plain).alias("__salt"))
        rows.repartitionByRange(n, "__h", "__salt").sortWithinPartitions("__h").drop("__h", "__salt").write.option("compression", "zstd").parquet(f"{path}/data/{made}")
        back = spark.read.schema(schema).parquet(f"{path}/data/{made}")
        # keys are counted under a number of their file, as its name in each group would be most of a task's memory
        number = F.xxhash64("_metadata.file_name").alias("f")
        names = written(back.select(number, F.concat(F.lit(f"data/{made}/"), F.col("_metadata.file_name")).alias("file"), F.col("_metadata.file_size").alias("bytes")).distinct(), "names")
        each = written(back.select(number, hashed(keys).alias("h")).groupBy("f", "h").agg(F.count("*").alias("n")), "hashes")
        words = F.greatest(F.lit(1).cast("long"), F.ceil(F.count("*") / KEYS_A_WORD))
        counts = each.groupBy("f").agg(F.min("h").alias("lo"), F.max("h").alias("hi"), F.sum("n").alias("rows"), words.alias("words"))
        files = written(counts.join(names, "f").withColumn("made", F.lit(made)), "files")
        index = each.join(files.select("f", "words"), "f").groupBy("f", word_of(F.col("h"), F.col("words")).alias("word")).agg(F.bit_or(mask_of(F.col("h"))).alias("bits"))
        index = index.join(names.select("f", "file"), "f").select("file", "word", "bits")
        index.write.parquet(f"{path}/_index/{made}")
        parts = pd.concat([kept, files.toPandas()], ignore_index=True) if len(kept) else files.toPandas()
    spark.createDataFrame(parts[[c.split()[0] for c in MANIFEST.split(", ")]].to_dict("records"), MANIFEST).write.parquet(f"{path}/_manifests/{made}")
    fs, at = store_of(spark, path)
    entry = {"version": version, "manifest": made, "keys": list(keys), "schema": schema.jsonValue(), "files": len(parts), "rows": int(parts["rows"].sum()) if len(parts) else 0}
    out = fs.create(at(f"{path}/_log/{version:010d}"), False)  # an error if it is there
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    return entry


def next_version(spark: SparkSession, path: str) -> int:
    """One more than any file of the log, whole or not."""
    fs, at = store_of(spark, path)
    return max((int(x.getPath().getName()) for x in fs.globStatus(at(f"{path}/_log/[0-9]*")) or []), default=0) + 1


def create(df: DataFrame, path: str, keys: Sequence[str] | str, file_bytes: int = FILE_BYTES) -> dict:
    """A new table of df's rows, found by keys. Raises FileExistsError if path has one."""
    if commits(df.sparkSession, path):
        raise FileExistsError(path)
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = written(df, "base")
    kept = pd.DataFrame(columns=[c.split()[0] for c in MANIFEST.split(", ")])
    return _commit(None if rows.isEmpty() else rows, path, keys, df.schema, kept, estimate(rows), next_version(df.sparkSession, path), file_bytes)


def holding(spark: SparkSession, path: str, keys: DataFrame, version: int | None = None) -> list[str]:
    """Files that may hold one of the key hashes `h`: by range, then by filter. No file that holds one is left out."""
    files = manifest(spark, path, version)
    if not len(files):
        return []
    groups = []
    for made, g in files.groupby("made"):  # files of one commit are disjoint but for shared ends
        g = g.sort_values(["lo", "hi"])
        groups.append((g["lo"].to_numpy(np.int64), g["hi"].to_numpy(np.int64), g["words"].to_numpy(np.int64), g["file"].to_numpy(object)))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, words, names in groups:
                first, end = np.searchsorted(hi, h, "left"), np.searchsorted(lo, h, "right")
                n = np.maximum(end - first, 0)
                which = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(h, n)), pa.array(names[which], pa.string()), pa.array(words[which])], names=["h", "file", "words"])

    pairs = keys.select("h").mapInArrow(asked, "h long, file string, words long")
    index = spark.read.schema("file string, word long, bits long").parquet(*[f"{path}/_index/{m}" for m in sorted(files["made"].unique())])
    met = pairs.select("file", word_of(F.col("h"), F.col("words")).alias("word"), mask_of(F.col("h")).alias("mask")).join(index, ["file", "word"])
    return sorted(r[0] for r in met.filter(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).select("file").distinct().collect())


def replace(batch: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> dict:
    """Put the batch's rows in the place of all rows of their keys; keys compare with nulls equal.

    Returns the commit. A batch equal to what its keys have makes none, so a run may be repeated; an empty
    batch makes none either. Columns are the table's: missing ones become null, further ones are left out.
    """
    spark = batch.sparkSession
    last = commit_at(spark, path)
    schema, keys = T.StructType.fromJson(last["schema"]), last["keys"]
    rows = written(aligned(batch, schema), "batch")
    named = [F.col(k).alias(f"__{n}") for n, k in enumerate(keys)]
    own = written(rows.select(hashed(keys).alias("h"), *named).distinct(), "keys")
    same = [F.col(k).eqNullSafe(F.col(f"__{n}")) for n, k in enumerate(keys)]
    files = holding(spark, path, own.select("h").distinct(), last["version"])
    if files:  # the filter errs at times: one scan of the key columns tells, before a file is written again
        found = opened(spark, path, schema, files).select(*keys, F.regexp_extract("_metadata.file_path", "(data/[^/]+/[^/]+)$", 1).alias("__file"))
        files = sorted(r[0] for r in found.join(own, same, "left_semi").select("__file").distinct().collect())
    old = opened(spark, path, schema, files)
    before, after = (content_hash(x).first() for x in (old.join(own, same, "left_semi"), rows))
    if before == after:
        return last
    kept = manifest(spark, path, last["version"])
    gone = kept["file"].isin(files)
    size = estimate(rows) + int(kept.loc[gone, "bytes"].sum())
    return _commit(old.join(own, same, "left_anti").unionByName(rows), path, keys, schema, kept[~gone], size, next_version(spark, path), file_bytes)


def compact(spark: SparkSession, path: str, file_bytes: int = FILE_BYTES) -> dict:
    """Files of under half of file_bytes become files of that size, in one commit; two such files at least."""
    last = commit_at(spark, path)
    kept = manifest(spark, path, last["version"])
    small = kept["bytes"] < file_bytes // 2
    if small.sum() < 2:
        return last
    schema = T.StructType.fromJson(last["schema"])
    rows = opened(spark, path, schema, sorted(kept.loc[small, "file"]))
    return _commit(rows, path, last["keys"], schema, kept[~small], int(kept.loc[small, "bytes"].sum()), next_version(spark, path), file_bytes)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete what no one of the last `keep` commits names, runs that died included; returns the number of data files.

    Not while a writer is at work, whose files no commit names yet.
    """
    fs, at = store_of(spark, path)
    last = commits(spark, path)[-keep:]
    named = [manifest(spark, path, c["version"]) for c in last]
    files = {f for m in named for f in m["file"]}
    gone = [x.getPath() for x in fs.globStatus(at(f"{path}/data/*/*.parquet")) or [] if "/".join(x.getPath().toString().split("/")[-3:]) not in files]
    for p in gone:
        fs.delete(p, False)
    for kind, names in (("data", {f.split("/")[1] for f in files}), ("_index", {x for m in named for x in m["made"]}), ("_manifests", {c["manifest"] for c in last})):
        for x in fs.globStatus(at(f"{path}/{kind}/*")) or []:
            if x.getPath().getName() not in names:
                fs.delete(x.getPath(), True)
    for x in fs.globStatus(at(f"{path}/_log/*")) or []:
        if int(x.getPath().getName()) < last[0]["version"]:
            fs.delete(x.getPath(), False)
    return len(gone)
