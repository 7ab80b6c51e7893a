"""Tables that a job writes once and reads again: they survive lost executors, and what made them isn't run twice."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; unset, a new temporary folder on one machine and an error on a cluster."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not (context.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="wickwork-"))
    return context.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions, read back from files in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
