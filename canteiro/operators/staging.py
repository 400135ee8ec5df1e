"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints: the cluster's own, else a local one (tests only)."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="canteiro-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the one that all executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and safe when executors are lost."""
    spark = frame.sparkSession
    folder = shared_folder(spark, purpose)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)
