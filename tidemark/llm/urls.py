"""Allow and block lists for urls, looked up in a Bloom filter cascade.

A rule is a host and the start of a path. It fits its host and all subdomains, if the url's path starts
with the rule's; of the rules that fit, the longest (host and path together) decides. A url asks for one
key for every end of its host at a label and every path length that rules have.

Defined results: a null url, or one without "://", has empty host and path; a url that no rule fits is
allowed; an empty rule list allows everything; equal rules count once, with "block" before "allow" if
they disagree; repeated rows are judged each; an empty table gives an empty result. Extra columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bloom
from tidemark.llm.common import cut

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: Column, starts: Column) -> Column:
    """Structs (size, rule, h) of all keys that a url asks for, the longest first."""
    labels = F.split(host, "\\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    pairs = F.flatten(F.transform(ends, lambda h: F.transform(starts, lambda p: F.struct(F.length(F.concat(h, p)).alias("size"), F.concat(h, p).alias("rule"), F.xxhash64(h, p).alias("h")))))
    return F.sort_array(F.when(host == "", F.slice(pairs, 1, 0)).otherwise(pairs), asc=False)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", key: str = "page_id", max_bytes: int = bloom.MAX_BYTES) -> DataFrame:
    """key, host, path, rule (host and path, else null), verdict, for every row of pages.

    rules has host, path and verdict (allow or block). A list whose filters take more than max_bytes is asked
    in shards: a pass over the urls' keys for each, written out in between, so that one shard is in memory.
    The driver holds the distinct lengths of the rules' paths, no more numbers than the longest path has letters.
    """
    one = cut(rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict")).withColumn("h", F.xxhash64("host", "path")), "rules")
    lengths = sorted(r[0] for r in one.select(F.length("path")).distinct().collect())
    asked = pages.select(F.col(key), F.col(url).alias("__url")).select(key, host_of(F.col("__url")).alias("host"), path_of(F.col("__url")).alias("path"))
    fit = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path"))
    keyed = asked.withColumn("__keys", keys_of(F.col("host"), F.transform(fit, lambda n: F.substring("path", F.lit(1), n))))
    universe = cut(keyed.select(F.explode("__keys.h").alias("h")).distinct(), "universe")
    for verdict in ("allow", "block"):
        name, found = f"__{verdict}", F.transform("__keys", lambda _: F.lit(False))
        for levels, shard, of in bloom.shards(one.filter(F.col("verdict") == verdict), universe, max_bytes // 2):
            here = bloom.member(levels, shard, of)("__keys.h")
            keyed = keyed.withColumn(name, here if of == 1 else F.zip_with(found, here, lambda a, b: a | b))
            if of > 1:
                keyed, found = cut(keyed, "asked"), F.col(name)
    met = F.filter(F.transform("__keys", lambda k, i: F.struct(k["rule"].alias("rule"), F.get("__allow", i).alias("allow"), F.get("__block", i).alias("block"))), lambda x: x["allow"] | x["block"])
    keyed = keyed.withColumn("__first", F.get(met, F.lit(0)))
    return keyed.select(key, "host", "path", F.col("__first.rule").alias("rule"), F.when(F.col("__first.block"), "block").otherwise("allow").alias("verdict"))
