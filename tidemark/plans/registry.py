"""Named queries over the given tables, each with the SQL that should give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.readers import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

EVENTS_END = "2024-01-31 00:00:00"
ORDERS_END = "2001-08-02 00:00:00"
SHIP_END = "2001-11-05 00:00:00"


class Tables:
    """The given tables by name, with instants."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.base, name)


def plain(df: DataFrame) -> DataFrame:
    """Instants as wall-clock times, as SQL over the same files has them."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c, kind in df.dtypes if kind == "timestamp"})


def query(name: str, sql: str | None = None):
    """Register a function of Tables under a name, with its SQL."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, base: plain(f(Tables(spark, base)))
        if sql:
            ORACLES[name] = sql
        return f

    return add
