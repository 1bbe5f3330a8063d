"""Shared helpers: scratch tables in the cluster's checkpoint folder, words, connected components."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of these six characters separate words; everything else belongs to a word.
SPACE = "[\\x20\\x09-\\x0D]+"
NONSPACE = "[^\\x20\\x09-\\x0D]"


_OWN: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset, one of our own, in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="spark-ckpt-")
        named = _OWN[app]
    return named.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends, and sizes are known.

    The file sizes let Spark itself decide on a broadcast, within spark.sql.autoBroadcastJoinThreshold.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables made by cut() that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        root = checkpoint_dir(spark)
        for file in df.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            if root.removeprefix("file:").strip("/") in path.toString():
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words(text: Column) -> Column:
    """Words of a text as an array; null and blank texts give an empty one."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def unused(df: DataFrame, name: str) -> str:
    """name, or a longer form of it that is no column of df (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def components(nodes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """(node, component): the smallest node reachable from each node over undirected edges (a, b).

    Alternating large-star and small-star rounds on the edge table; every round is a join and a
    partially aggregated minimum, so a node with very many neighbours is spread over tasks. Each
    round is written to the checkpoint folder, and only a count of changed edges reaches the driver.
    Rounds grow with the logarithm of the longest path. Nodes without edges are their own component.
    """
    now = cut(edges.filter("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), name)
    while not now.isEmpty():
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).filter("lo <> hi")
        large = cut(large.distinct(), name)
        floor = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(floor, "hi")
        small = joined.select(F.col("m").alias("lo"), "hi").union(joined.select(F.col("m").alias("lo"), F.col("lo").alias("hi"))).filter("lo <> hi")
        then = cut(small.distinct(), name)
        same = now.count() == then.count() and then.join(now, ["lo", "hi"], "left_anti").isEmpty()
        discard(now, large)
        now = then
        if same:
            break
    root = now.groupBy("hi").agg(F.min("lo").alias("component")).withColumnRenamed("hi", "node")
    return nodes.join(root, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
