"""Sources: partitioned Parquet by name union, time-bounded scans that prune partitions, JDBC, raw pages."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import REGISTRY, resolve


def timestamps(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as instants, once, at the source."""
    return df.withColumns({f.name: F.col(f.name).cast("timestamp") for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)})


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """<base>/<name>.parquet with instants."""
    return timestamps(spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet"))


def parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Files of any schema version under path: columns by name, missing ones null, partitions from paths."""
    reader = spark.read.option("mergeSchema", "true")
    found = reader.parquet(path)
    if schema is None:
        return timestamps(found)
    have = {f.name: f.dataType for f in found.schema.fields}
    more = [c for c in found.columns if c not in schema.fieldNames()]
    return found.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields], *more)


def logical(spark: SparkSession, name: str, base: str) -> DataFrame:
    """A registered table under a base folder."""
    return parquet(spark, resolve(name, base), REGISTRY[name].schema)


def jdbc(spark: SparkSession, url: str, relation: str, key: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 8, **options: str) -> DataFrame:
    """A live reference table; filters and columns go to the database.

    With a whole-number key it is read in parallel, by ranges of the key; bounds (its least and greatest value)
    are asked from the database unless given. Bounds only cut the ranges: keys beyond them, and null ones, are read.
    """
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if key and not bounds:
        name = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(key)
        bounds = reader.option("query", f"SELECT min({name}) AS low, max({name}) AS high FROM {relation}").load().first()
        reader = spark.read.format("jdbc").option("url", url).options(**options)
    if key and bounds and bounds[0] is not None:
        reader = reader.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1]).option("numPartitions", partitions)
    return reader.option("dbtable", relation).load()


def months(column_year: str, column_month: str, start: str | None, end: str | None) -> Column:
    """A predicate on year and month columns that holds for every partition the time range touches."""
    n = F.col(column_year) * 12 + F.col(column_month)
    of = lambda t: F.year(F.lit(t).cast("timestamp")) * 12 + F.month(F.lit(t).cast("timestamp"))
    out = F.lit(True)
    if start is not None:
        out = out & ((n >= of(start)) | (F.col(column_year) == 0))
    return out & ((n <= of(end)) | (F.col(column_year) == 0)) if end is not None else out


def between(df: DataFrame, ts: str, start: str | None = None, end: str | None = None, parts: tuple[str, str] | None = None, closed: bool = False) -> DataFrame:
    """Rows of [start, end), either side optional; closed includes end. parts are the year and month
    columns of the path, on which a predicate is added so that other partitions aren't read."""
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        last = F.lit(end).cast("timestamp")
        df = df.filter(F.col(ts) <= last if closed else F.col(ts) < last)
    return df.filter(months(*parts, start, end)) if parts and (start or end) else df


def lookback(df: DataFrame, ts: str, end: str, interval: str) -> DataFrame:
    """Rows of [end - interval, end], both ends included."""
    last = F.lit(end).cast("timestamp")
    return df.filter((F.col(ts) >= last - F.expr(f"INTERVAL {interval}")) & (F.col(ts) <= last))


def pages(spark: SparkSession, path: str, where: Column | str | None = None, pattern: str = "*.html*") -> DataFrame:
    """Raw page files: page_id (the file's name up to its first dot), html, size, modified_at, and the folders' columns.

    Bodies ending in .zst, .gz or .bz2 are compressed. `where` is a predicate on the folders' columns: files in other
    folders are listed, not opened. A page is one row, held by one task; an unreadable body is an error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    folders = [c for c in files.columns if c not in ("path", "modificationTime", "length", "content")]
    if where is not None:
        files = files.filter(where)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [inflated(name, body) for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bodies, pa.string()), *batch.columns[2:]], names=["path", "html", *batch.schema.names[2:]])

    kinds = dict(files.dtypes)
    rows = files.select("path", "content", F.col("length").alias("size"), F.col("modificationTime").alias("modified_at"), *folders)
    out = rows.mapInArrow(each, ", ".join(["path string, html string, size long, modified_at timestamp", *[f"`{c}` {kinds[c]}" for c in folders]]))
    return out.select(F.regexp_extract("path", r"([^/.]+)[^/]*$", 1).alias("page_id"), "html", "size", "modified_at", *folders)


def inflated(name: str, body: bytes) -> str:
    """The text of a page file, by the ending of its name."""
    kind = {"zst": "zstd", "gz": "gzip", "bz2": "bz2"}.get(name.rsplit(".", 1)[-1])
    if kind:
        body = pa.input_stream(pa.BufferReader(body), compression=kind).read()
    return body.decode("utf-8", "replace")
