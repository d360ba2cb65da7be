"""The folder every executor can reach, for checkpoints and written tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; unset, no folder is known to be shared."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured
    if current is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return current


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created or removed."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder.

    For small results that several branches of a query read: they are computed
    once, survive lost executors, and their size is known to the optimizer.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
