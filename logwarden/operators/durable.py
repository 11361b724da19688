"""Cutting lineage so that a lost executor costs one stage, not the whole plan."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder only where none is named."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if context.getCheckpointDir() is None:
            if not context.master.startswith("local"):
                raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="logwarden-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def durable_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/logwarden-{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Parquet rather than ``checkpoint()``: later passes read only the columns they need.
    """
    path = durable_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
