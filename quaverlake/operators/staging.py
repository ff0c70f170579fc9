"""Cuts lineage in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a local master gets a folder of its own, a cluster is refused."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (folder or "file:///tmp/checkpoints").rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, without what made it."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
