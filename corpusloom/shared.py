"""The folder that all executors share, and tables that are kept there."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary one only where none is set and all runs on this machine, as in tests."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (named or os.path.join(tempfile.gettempdir(), "corpusloom")).rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame) -> DataFrame:
    """Computed once, into the shared checkpoint folder: later reads compute nothing again, lost executors cost nothing."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder(df.sparkSession))
    return df.checkpoint()
