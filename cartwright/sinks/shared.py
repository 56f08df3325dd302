"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new name below ``spark.checkpoint.dir``; a local session without one uses the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once and read it back: later plans read the columns they need from the files."""
    folder = shared_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def stored_and_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``stored``, with the number of rows that the write observed on its way."""
    observation = Observation(label)
    rows = stored(df.observe(observation, F.count(F.lit(1)).alias("rows")), label)
    return rows, observation.get["rows"]
