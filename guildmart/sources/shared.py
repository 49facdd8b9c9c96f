"""Intermediates in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for written intermediates that the session names in ``spark.checkpoint.dir``.

    Only a local session without one gets a temporary folder, the same for its whole life.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="guildmart-"))
    return context.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """The frame, computed once and kept in the shared folder, where losing an executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/frame-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
