"""Cut a plan by writing it to the shared folder of the cluster."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; where none is set, a temporary one, but on a single machine only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        folder = context.getCheckpointDir()
        if not folder:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="adlens-"))
            folder = context.getCheckpointDir()
    return folder.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and read it back.

    The copy survives the loss of executors and keeps values that depend on the physical
    partitioning fixed, however often later steps read it. Parquet is used rather than a
    checkpoint so that later steps read only the columns they need.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
