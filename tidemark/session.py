"""Session settings the models rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS; `more` has further settings, dots written as double underscores."""
    builder = SparkSession.builder.appName("tidemark")
    if master:
        builder = builder.master(master)
    for k, v in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def local(cpus: int | None = None, memory: str = "8g") -> SparkSession:
    n = cpus or os.cpu_count() or 4
    return session(f"local[{n}]", spark__driver__memory=memory, spark__sql__shuffle__partitions=str(n))
