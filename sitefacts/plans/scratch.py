"""Folders for data a job writes between its steps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The checkpoint folder of the session, which all its nodes must share.

    It is the setting ``spark.checkpoint.dir``, or what ``SparkContext.setCheckpointDir`` was given. There is no
    fallback: a folder of one machine would lose the rows other machines write.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return root.rstrip("/")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several steps read and go on from the copy.

    The steps then share one computation, and a lost executor costs a re-read of the copy instead of the
    work behind it.
    """
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
