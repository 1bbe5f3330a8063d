"""The folder for checkpoints: the cluster's own, else a new one of this session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_OWN: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset, one in the temp folder, in local mode only."""
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if context.applicationId not in _OWN:
            _OWN[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="spark-ckpt-")
        path = _OWN[context.applicationId]
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(path)
    return path


def new_table(spark: SparkSession, name: str) -> str:
    """A path in the checkpoint folder that nothing has yet."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the checkpoint folder: what several parts of a plan read is computed once."""
    spark = df.sparkSession
    path = new_table(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of Parquet that one task is to take where a plan keeps rows in memory (sorts, wide hash aggregates).
TASK_BYTES = 1 << 20


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt by keys to as many tasks as its size asks for, so that a task's rows do not grow with the table.

    The number is given, as adaptive execution would else join small compressed partitions to millions of rows.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES)), *keys)
