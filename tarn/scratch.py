"""The folder that driver and executors share, for checkpoints and scratch tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names; a folder is set here only where the session runs on one machine and names none."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "checkpoints"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df, checkpointed: an iteration goes on from its rows, not from its plan."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
